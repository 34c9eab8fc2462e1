"""Heads, tips, bookmarks and the listing of references."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revstrata.functions.identity import NULL_ID
from revstrata.operators import dag


def tips(branch_heads: DataFrame, order: str = "rev") -> DataFrame:
    """Each branch's tip among (branch, rev, closed): its last open head, or its first head if all are closed."""
    closed = F.coalesce("closed", F.lit(False))
    rows = branch_heads.select("branch", F.struct(*branch_heads.columns).alias("_row"), F.struct(closed, F.when(closed, F.col(order)).otherwise(-F.col(order))).alias("_at"))
    return rows.groupBy("branch").agg(F.min_by("_row", "_at").alias("_row")).select(*[F.col("_row")[c].alias(c) for c in branch_heads.columns])


def branch_map(branch_heads: DataFrame) -> DataFrame:
    """(branch, heads): the nodes of each branch's heads, in order of rev, joined by spaces."""
    return branch_heads.groupBy("branch").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rev", "node"))), lambda h: h["node"]), " ").alias("heads"))


def listing(nodes: DataFrame, edges: DataFrame, bookmarks: DataFrame | None = None, mapping: DataFrame | None = None, style: str = "all") -> DataFrame:
    """(ref, target) of heads, tips and bookmarks; targets are mapped identifiers, or ``?`` where there is none.

    ``nodes`` has (rev, node, branch, closed). Styles: ``heads`` lists ``refs/heads/branches/B/NODE``, ``tips`` lists
    ``refs/heads/branches/B/tip``, ``bookmarks`` lists ``refs/heads/bookmarks/NAME``, ``all`` all three.
    """
    found = dag.branch_heads(nodes.select("rev", "branch"), edges).join(nodes.select("rev", "node", "closed"), "rev")
    parts = []
    # fixed values: the prefixes of these references
    if style in ("heads", "all"):
        parts.append(found.select(F.concat(F.lit("refs/heads/branches/"), "branch", F.lit("/"), "node").alias("ref"), "node"))
    if style in ("tips", "all"):
        parts.append(tips(found).select(F.concat(F.lit("refs/heads/branches/"), "branch", F.lit("/tip")).alias("ref"), "node"))
    if bookmarks is not None and style in ("bookmarks", "all"):
        parts.append(bookmarks.select(F.concat(F.lit("refs/heads/bookmarks/"), "name").alias("ref"), "node"))
    if not parts:
        raise ValueError(f"no such style: {style}")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if mapping is None:
        return out.withColumnRenamed("node", "target")
    return out.join(mapping.select(F.col("hg").alias("node"), F.col("git").alias("target")), "node", "left").select("ref", F.coalesce("target", F.lit("?")).alias("target"))


#: How references are named by which kinds of them are listed (heads, tips, bookmarks); {b} is the branch, {n} the node or name.
LAYOUTS = {
    (True, True, True): {"heads": "refs/heads/branches/{b}/{n}", "tips": "refs/heads/branches/{b}/tip", "bookmarks": "refs/heads/bookmarks/{n}"},
    (True, True, False): {"heads": "refs/heads/{b}/{n}", "tips": "refs/heads/{b}/tip"},
    (True, False, True): {"heads": "refs/heads/branches/{b}/{n}", "bookmarks": "refs/heads/bookmarks/{n}"},
    (True, False, False): {"heads": "refs/heads/{b}/{n}"},
    (False, True, True): {"tips": "refs/heads/branches/{b}", "bookmarks": "refs/heads/bookmarks/{n}"},
    (False, True, False): {"tips": "refs/heads/{b}"},
    (False, False, True): {"bookmarks": "refs/heads/{n}"},
}


def ref_name(layout: str, branch: Column, name: Column) -> Column:
    """A reference's name in a layout of LAYOUTS."""
    parts = re.split(r"(\{[bn]\})", layout)
    return F.concat(*[{"{b}": branch, "{n}": name}.get(p, F.lit(p)) for p in parts if p])


def styled_listing(nodes: DataFrame, edges: DataFrame, bookmarks: DataFrame, kinds: set[str]) -> DataFrame:
    """(ref, node) of the kinds ``heads``, ``tips`` and ``bookmarks`` that are asked for, in the layout that goes with them.

    A head that is its branch's tip is not listed again among heads where tips are.
    """
    layout = LAYOUTS[tuple(k in kinds for k in ("heads", "tips", "bookmarks"))]
    found = dag.branch_heads(nodes.select("rev", "branch"), edges).join(nodes.select("rev", "node", "closed"), "rev")
    last = tips(found)
    parts = []
    if "heads" in layout:
        listed = found.join(last.select("rev"), "rev", "left_anti") if "tips" in layout else found
        parts.append(listed.select(ref_name(layout["heads"], F.col("branch"), F.col("node")).alias("ref"), "node"))
    if "tips" in layout:
        parts.append(last.select(ref_name(layout["tips"], F.col("branch"), F.col("node")).alias("ref"), "node"))
    if "bookmarks" in layout:
        parts.append(bookmarks.select(ref_name(layout["bookmarks"], F.lit(""), F.col("name")).alias("ref"), "node"))
    return reduce(DataFrame.unionByName, parts)


def clone_source(lines: DataFrame, graft: bool | None = None, known: DataFrame | None = None) -> DataFrame:
    """(url, branch) of the first usable line (place, url, branch, graft) of a list of prepared repositories.

    With ``graft`` True only lines with grafted commits count, with False only those without; with None either, the former
    first. Lines with grafted commits that are not all in ``known`` (oid) are passed over.
    """
    is_graft = F.size("graft") > 0
    rows = lines.where(is_graft if graft else ~is_graft) if graft is not None else lines
    if known is not None:
        lost = rows.select("place", F.explode("graft").alias("oid")).join(known.select("oid"), "oid", "left_anti").select("place")
        rows = rows.join(lost, "place", "left_anti")
    return rows.orderBy(~is_graft, "place").limit(1).select("url", "branch")


def fetch_head(fetched: DataFrame, url: Column) -> DataFrame:
    """``fetched`` (oid, name, merge) with ``line``: what a fetch reports of each reference.

    A reference that is not for merging says so; branches and tags are named by kind, all others by their whole name; the
    reference ``HEAD`` has the address alone.
    """
    name = F.col("name")
    what = (
        F.when(name == "HEAD", "")
        .when(F.startswith(name, F.lit("refs/heads/")), F.concat(F.lit("branch '"), F.substring(name, F.lit(12), F.length(name)), F.lit("' of ")))
        .when(F.startswith(name, F.lit("refs/tags/")), F.concat(F.lit("tag '"), F.substring(name, F.lit(11), F.length(name)), F.lit("' of ")))
        .otherwise(F.concat(F.lit("'"), name, F.lit("' of ")))
    )
    return fetched.withColumn("line", F.concat("oid", F.lit("\t"), F.when(F.col("merge"), "").otherwise("not-for-merge"), F.lit("\t"), what, url))


def compare_and_set(refs: DataFrame, updates: DataFrame) -> DataFrame:
    """``refs`` (name, oid) after updates (name, old, new): a new NULL deletes; an update whose old value is not the present one fails."""
    held = updates.join(refs, "name", "left")
    ok = F.col("old").eqNullSafe(F.col("oid"))
    checked = held.select("name", F.when(ok, F.col("new")).otherwise(F.raise_error(F.concat(F.lit("lost race on "), "name"))).alias("oid"))
    return refs.join(updates.select("name"), "name", "left_anti").unionByName(checked.where(F.col("oid").isNotNull()))


def heads_digest(heads: DataFrame, keys: list[str], node: str = "node") -> DataFrame:
    """(keys, digest): sha1 of each group's distinct heads in order, by which a push tells whether others came first."""
    found = heads.groupBy(*keys).agg(F.array_sort(F.collect_set(node)).alias("_nodes"))
    return found.select(*keys, F.sha1(F.unhex(F.array_join("_nodes", ""))).alias("digest"))


#: Fields of a format for tag lists.
TAG_FIELDS = {"%(tagname)": "tag", "%(objectname)": "git", "%(hg::objectname)": "node"}


def tag_list(tags: DataFrame, mapping: DataFrame, form: str = "%(tagname)") -> DataFrame:
    """(tag, line) of live tags (tag, node) in a format of fields between single spaces; zeroes stand for unmapped identifiers."""
    items = form.split(" ")
    if not set(items) <= set(TAG_FIELDS):
        raise ValueError(f"invalid format: {form}")
    found = tags.where(F.col("node") != "").join(mapping.select(F.col("hg").alias("node"), "git"), "node", "left")
    found = found.withColumn("git", F.coalesce("git", F.lit(NULL_ID)))
    return found.select("tag", F.concat_ws(" ", *[F.col(TAG_FIELDS[i]) for i in items]).alias("line"))


def retained(pushed: DataFrame, drafts: DataFrame, policy: str) -> DataFrame:
    """Pushed changesets (rev) whose metadata is kept: ``never`` none, ``always`` or ``force`` all, ``phase`` those that are no drafts."""
    if policy not in ("never", "phase", "always", "force"):
        raise ValueError(f"no such policy: {policy}")
    if policy == "phase":
        return pushed.join(drafts.select("rev"), "rev", "left_anti")
    return pushed.limit(0) if policy == "never" else pushed
