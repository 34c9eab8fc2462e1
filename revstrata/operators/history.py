"""Listing, selecting and changing history: revision lists, heads, changes of commits, and manifests made from tree differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revstrata.functions.identity import node_hash
from revstrata.operators import dag
from revstrata.operators.dag import _cut
from revstrata.operators.objects import EMPTY_FILE, copied_file_id
from revstrata.operators.ordering import numbered

#: Fixed value: the identifier of an empty blob.
EMPTY_BLOB = "e69de29bb2d1d6434b8b29ae775ad8c2e48c5391"


def symmetric_difference(nodes: DataFrame, edges: DataFrame, a: DataFrame, b: DataFrame) -> DataFrame:
    """(rev) of the ancestors of either side that are not ancestors of both."""
    up = [dag.ancestors(nodes, edges, x.select("rev")) for x in (a, b)]
    return up[0].join(up[1], "rev", "left_anti").unionAll(up[1].join(up[0], "rev", "left_anti"))


def below(edges: DataFrame, revs: DataFrame) -> DataFrame:
    """(rev): the parents of ``revs``, as in "without what comes before these"."""
    return edges.join(revs.select(F.col("rev").alias("child")), "child", "left_semi").select(F.col("parent").alias("rev")).distinct()


def rev_list(
    nodes: DataFrame, edges: DataFrame, include: DataFrame, exclude: DataFrame | None = None, *,
    ancestry_path: bool = False, roots: bool = False, boundary: bool = False, reverse: bool = False, max_count: int | None = None,
) -> DataFrame:
    """(rev, place, kind) of a range in topological order: no parent stands before any of its children, later revs first.

    ``ancestry_path`` keeps descendants of ``exclude``; ``roots`` keeps nodes without parents; ``max_count`` keeps the first so
    many of the order (before ``reverse`` turns it); ``boundary`` adds the parents just outside, of kind ``boundary``, behind
    the others.
    """
    none = nodes.select("rev").limit(0)
    out = exclude if exclude is not None else none
    chosen = dag.ancestry_path(nodes, edges, include, out) if ancestry_path else dag.rev_range(nodes, edges, include, out)
    if roots:
        chosen = chosen.join(edges.select(F.col("child").alias("rev")), "rev", "left_anti")
    depths = dag.generation(nodes.select("rev"), edges)
    listed = chosen.withColumn("kind", F.lit("in"))
    if boundary:
        listed = listed.unionByName(dag.boundary(edges, chosen).withColumn("kind", F.lit("boundary")))
    listed = listed.join(depths, "rev").select("rev", "kind", (F.col("kind") == "boundary").alias("_late"), (-F.col("depth")).alias("_up"), (-F.col("rev")).alias("_back"))
    if max_count is not None:
        first = listed.where("NOT _late").orderBy("_up", "_back").limit(max_count)
        listed = first.unionByName(listed.where("_late"))
    placed = numbered(listed, ["_late", "_up", "_back"], "place")
    if reverse:
        last = placed.agg(F.count("*").alias("_n"))
        placed = placed.crossJoin(F.broadcast(last)).withColumn("place", F.col("_n") - 1 - F.col("place"))  # one row
    return placed.select("rev", "place", "kind")


def in_branches(heads: DataFrame, branches: DataFrame | None) -> DataFrame:
    """``heads`` (branch, ...) of the named branches; all, if none is named."""
    if branches is None or branches.isEmpty():
        return heads
    return heads.join(branches.select("branch").distinct(), "branch", "left_semi")


def partitioned(rows: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """The rows that meet a condition, and the others; unknown counts as not met."""
    met = F.coalesce(condition, F.lit(False))
    return rows.where(met), rows.where(~met)


def united_heads(first: DataFrame, second: DataFrame, node: str = "node", order: str = "place") -> DataFrame:
    """(node, side, order) of both tables' nodes, each once: where the first has it, with its place there, else with the second's."""
    rows = first.select(node, F.lit(0).alias("side"), order).unionByName(second.select(node, F.lit(1).alias("side"), order))
    return rows.groupBy(node).agg(F.min(F.struct("side", order)).alias("_at")).select(node, "_at.side", f"_at.{order}")


def with_new_heads(heads: DataFrame, new: DataFrame) -> DataFrame:
    """(node): heads after the new nodes (node, parents) came: the new ones are heads, their parents are none any more."""
    gone = new.select(F.explode("parents").alias("node"))
    return heads.select("node").unionAll(new.select("node")).distinct().join(gone, "node", "left_anti")


def previous_in_order(rows: DataFrame, order: list[str], value: str) -> DataFrame:
    """``rows`` with ``previous``: the value of the row before in the given order, NULL for the first; no task sees all rows."""
    placed = numbered(rows, order, "_at")
    before = placed.select((F.col("_at") + 1).alias("_at"), F.col(value).alias("previous"))
    return placed.join(before, "_at", "left").drop("_at")


def wanted_refs(wanted: DataFrame, remote: DataFrame) -> DataFrame:
    """``wanted`` (name) with the remote's node (name, node); a name that the remote lacks is an error."""
    met = wanted.join(remote.select("name", "node"), "name", "left")
    return met.withColumn("node", F.coalesce("node", F.raise_error(F.concat(F.lit("no such ref: "), "name")).cast("string")))


def mapped_tags(tags: DataFrame, mapping: DataFrame) -> DataFrame:
    """(tag, git) of those tags (tag, node) whose node is mapped (hg, git)."""
    return tags.join(mapping.select(F.col("hg").alias("node"), "git"), "node").select("tag", "git")


def files_of_interest(files: DataFrame, node: str = "node") -> DataFrame:
    """Each file node once that is neither none nor the empty file."""
    return files.select(node).where(F.col(node).isNotNull() & (F.col(node) != EMPTY_FILE)).distinct()


def update_order(updates: DataFrame) -> DataFrame:
    """``updates`` (ref, worktree, current) with ``place``: refs by name, then heads of worktrees by path, the current head last."""
    kind = F.when(F.col("ref").isNotNull(), 0).when(F.col("worktree").isNotNull(), 1).otherwise(2)
    placed = updates.withColumn("_kind", kind).withColumn("_key", F.coalesce("ref", "worktree", F.lit("")))
    return numbered(placed, ["_kind", "_key"], "place").drop("_kind", "_key")


def bundle_names(blobs: DataFrame, order: str = "n") -> DataFrame:
    """``blobs`` (n from 1) with their ``name`` in a tree and ``place`` there: numbers in the order of their text, the first one unnumbered."""
    text = F.col(order).cast("string")
    named = blobs.withColumn("name", F.concat(F.lit("bundle"), F.when(text != "1", text).otherwise("")))
    return numbered(named.withColumn("_text", text), ["_text"], "place").drop("_text")


def changes_of(trees: DataFrame, commits: DataFrame, one_sided: bool = False) -> DataFrame:
    """(commit, path, file_node, parents): what each commit (commit, p1, p2) changes, from trees (commit, path, file_node), whose nodes are texts or bytes.

    Without parents all files, with one the difference (NULL for a removed file), with two the paths that differ from both, or
    with ``one_sided`` from either; ``parents`` holds the parents' file nodes, NULL where they have none.
    """
    kind = dict(trees.dtypes)["file_node"]
    # a tree is dealt once, to all commits that it is a side of: 0 the commit's own, 1 and 2 its parents'
    seat = lambda side, tree: F.struct(F.lit(side).cast("byte").alias("side"), F.col(tree).alias("tree"))
    seats = F.when(F.col("p1").isNull(), F.array(seat(0, "commit"))).when(F.col("p2").isNull(), F.array(seat(0, "commit"), seat(1, "p1"))).otherwise(F.array(seat(0, "commit"), seat(1, "p1"), seat(2, "p2")))
    links = commits.select("commit", seats.alias("_s")).select("commit", (F.size("_s") - 1).cast("byte").alias("n"), F.explode("_s").alias("_s")).select("commit", "n", "_s.*")
    met = trees.select(F.col("commit").alias("tree"), "path", "file_node").join(links, "tree")
    node = lambda k: F.max(F.when(F.col("side") == k, F.col("file_node")))
    rows = met.groupBy("commit", "path").agg(F.max("n").alias("n"), node(0).alias("file_node"), node(1).alias("first"), node(2).alias("second"))
    differs = [~F.col("file_node").eqNullSafe(F.col(c)) for c in ("first", "second")]
    merged = differs[0] | differs[1] if one_sided else differs[0] & differs[1]
    parents = F.when(F.col("n") == 0, F.array().cast(f"array<{kind}>")).when(F.col("n") == 1, F.array("first")).otherwise(F.array("first", "second"))
    return rows.where(F.when(F.col("n") == 0, True).when(F.col("n") == 1, differs[0]).otherwise(merged)).select("commit", "path", "file_node", parents.alias("parents"))


def manifest_of_diff(parent: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, path, file_node, attr, listed): a manifest from its parent's (keys, path, file_node, attr) and a commit's tree difference.

    A change (keys, path, status, source, old_oid, oid, attr, content) is added (``A``), modified (``M``: a new node where the
    content is another), deleted (``D``), renamed (``R``) or copied (``C``) from ``source``; a rename deletes its source, and one
    to an empty blob counts as added. ``listed`` are the paths that the changeset names; removed ones have a NULL node. A
    change that does not fit the parent is an error.
    """
    moved = F.col("status").isin("R", "C") & (F.col("oid") != EMPTY_BLOB)
    source_keys = [F.col(k) for k in keys]
    gone = changes.where("status = 'R'").select(*source_keys, F.col("source").alias("path"), F.lit(True).alias("_gone"))
    came = changes.select(*keys, "path", F.when(moved, "C").when(F.col("status").isin("R", "C"), "A").otherwise(F.col("status")).alias("status"), "source", "old_oid", "oid", F.col("attr").alias("_attr"), "content")
    sources = parent.select(*keys, F.col("path").alias("source"), F.col("file_node").alias("_source_node"))
    came = came.join(sources, [*keys, "source"], "left")
    met = parent.select(*keys, "path", "file_node", "attr").join(came, [*keys, "path"], "full_outer").join(gone, [*keys, "path"], "left")
    none = F.lit(None).cast("string")
    misfit = F.raise_error(F.concat(F.lit("a change does not fit the parent at "), F.col("path"))).cast("string")
    fresh = node_hash(none, none, F.col("content"))
    node = (
        F.when(F.col("status").isNull(), F.when(F.col("_gone"), none).otherwise(F.col("file_node")))
        .when(F.col("status") == "D", F.when(F.col("file_node").isNull(), misfit))
        .when(F.col("status") == "A", fresh)
        .when(F.col("status") == "C", F.when(F.col("_source_node").isNull(), misfit).otherwise(copied_file_id(F.col("content"), F.col("source"), F.col("_source_node"))))
        .when(F.col("file_node").isNull(), misfit)
        .when(F.col("old_oid") == F.col("oid"), F.col("file_node"))
        .otherwise(node_hash(F.col("file_node"), none, F.col("content")))
    )
    return met.select(
        *keys, "path", node.alias("file_node"), F.when(F.col("status").isNull(), F.col("attr")).otherwise(F.col("_attr")).alias("attr"), (F.col("status").isNotNull() | F.col("_gone").isNotNull()).alias("listed")
    )


def heads_of_files(revisions: DataFrame) -> DataFrame:
    """(path, node): of each path's revisions (path, node, p1, p2) those that are no parent of another."""
    inner = revisions.select("path", F.explode(F.array_compact(F.array("p1", "p2"))).alias("node"))
    return revisions.select("path", "node").distinct().join(inner, ["path", "node"], "left_anti")


def file_ancestry(first: DataFrame, second: DataFrame, revisions: DataFrame, keys: list[str], order: str) -> DataFrame:
    """(keys, a, b): where two manifests (keys, file_node) differ and one's file node is an ancestor (a) of the other's (b).

    ``revisions`` are (keys, node, p1, p2) with ``order``, in which parents come first. Nodes without a revision have no ancestors.
    """
    placed = _cut(numbered(revisions.select(*keys, "node", "p1", "p2", order), [order], "rev").select(*keys, "node", "p1", "p2", "rev"))
    at = lambda c: placed.select(*keys, F.col("node").alias(c), F.col("rev").alias(f"{c}_rev"))
    links = placed.select(*keys, F.col("rev").alias("child"), F.explode(F.array_compact(F.array("p1", "p2"))).alias("p"))
    edges = _cut(links.join(at("p"), [*keys, "p"]).select("child", F.col("p_rev").alias("parent")).distinct())
    met = first.select(*keys, F.col("file_node").alias("a")).join(second.select(*keys, F.col("file_node").alias("b")), keys).where("a <> b")
    met = _cut(met.join(at("a"), [*keys, "a"]).join(at("b"), [*keys, "b"]))
    turned = met.select(*keys, F.col("b").alias("a"), F.col("a").alias("b"), F.col("b_rev").alias("a_rev"), F.col("a_rev").alias("b_rev"))
    both = met.select(*turned.columns).unionByName(turned).where("a_rev < b_rev")
    told = dag.is_ancestor(placed.select("rev"), edges, both.select(F.col("a_rev").alias("a"), F.col("b_rev").alias("b")).distinct())
    return both.join(told.where("is_ancestor").select(F.col("a").alias("a_rev"), F.col("b").alias("b_rev")), ["a_rev", "b_rev"]).select(*keys, "a", "b")


def depth_of_manifests(changesets: DataFrame, edges: DataFrame) -> DataFrame:
    """(manifest, depth): the greatest depth of the changesets (rev, manifest) that have it."""
    depths = dag.generation(changesets.select("rev"), edges)
    return changesets.select("rev", "manifest").join(depths, "rev").groupBy("manifest").agg(F.max("depth").alias("depth"))
