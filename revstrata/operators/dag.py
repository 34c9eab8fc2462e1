"""Operators over commit graphs: (rev, parent) edges, where a parent's rev is less than its child's.

Traversals are sweeps over blocks of revs (see :mod:`sweep`), so their jobs follow the number of blocks, whatever the graph's
shape. Chains whose identifiers have no order are walked by pointer doubling. A closed cycle is an error everywhere.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revstrata.operators import labels
from revstrata.operators.scratch import cut as _cut
from revstrata.operators.sweep import Laid, derived, near, sweep


#: Nodes that discovery picks by sorting; of more it takes a share by their hashes.
SAMPLED = 10_000
#: One node in so many is the end of a run when chains are walked.
SPLIT = 16


def edges_of(nodes: DataFrame) -> DataFrame:
    """(child, parent) of (rev, p1, p2); parents that are not nodes are dropped."""
    pairs = nodes.select(F.col("rev").alias("child"), F.explode(F.array_compact(F.array("p1", "p2"))).alias("parent")).distinct()
    return pairs.join(nodes.select(F.col("rev").alias("parent")), "parent", "left_semi").select("child", "parent")


def assert_unique(nodes: DataFrame) -> DataFrame:
    """``nodes``, failing when a rev occurs twice."""
    counts = nodes.groupBy("rev").count()
    once = F.when(F.col("count") > 1, F.raise_error(F.lit("a node occurs twice")).cast("boolean")).otherwise(True)
    return nodes.join(counts, "rev").where(once).drop("count")


def heads(nodes: DataFrame, edges: DataFrame, matches: Column | None = None) -> DataFrame:
    """Matching nodes without a matching child."""
    chosen = nodes if matches is None else nodes.where(matches)
    inner = edges.join(chosen.select(F.col("rev").alias("child")), "child", "left_semi").select(F.col("parent").alias("rev"))
    return chosen.join(inner, "rev", "left_anti")


def roots(nodes: DataFrame, edges: DataFrame, matches: Column | None = None) -> DataFrame:
    """Matching nodes without a matching parent."""
    chosen = nodes if matches is None else nodes.where(matches)
    inner = edges.join(chosen.select(F.col("rev").alias("parent")), "parent", "left_semi").select(F.col("child").alias("rev"))
    return chosen.join(inner, "rev", "left_anti")


def branch_heads(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes without a child of the same branch; ``nodes`` has (rev, branch)."""
    child = nodes.select(F.col("rev").alias("child"), "branch")
    covered = edges.join(child, "child").select(F.col("parent").alias("rev"), "branch")
    return nodes.join(covered, ["rev", "branch"], "left_anti")


def topological_heads(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Branch heads without any child."""
    return branch_heads(nodes, edges).join(edges.select(F.col("parent").alias("rev")), "rev", "left_anti")


def _runs(edges: DataFrame, here: str, there: str, split: int) -> tuple[DataFrame, DataFrame]:
    """Runs along edges (here, there): (rev, run, pos) of all nodes but the runs' ends, and the edges (run, next) between runs.

    An edge lies inside a run if it is the only one from ``here`` and the only one to ``there``, and not one of those, about one in
    ``split`` by their hashes, at which runs are cut: so runs stay short, and so do the rounds over all nodes. A run is named after its
    end, from which ``pos`` counts; a node that is not in the first table is the end of its own run. Edges between runs go
    from an end to the first node of the next.
    """
    sole_from = edges.groupBy(here).agg(F.count("*").alias("_n")).where("_n = 1").select(here)
    sole_to = edges.groupBy(there).agg(F.count("*").alias("_n")).where("_n = 1").select(there)
    inner = edges.where(F.pmod(F.xxhash64(here, F.lit(5)), F.lit(split)) > 0).join(sole_from, here, "left_semi").join(sole_to, there, "left_semi")
    jumps = _cut(inner.select(F.col(here).alias("rev"), F.col(there).alias("run"), F.lit(1).cast("long").alias("pos")))
    links = jumps.select(F.col("rev").alias(here), F.col("run").alias(there))
    # a run that is longer than all edges goes round in a circle
    for _ in range(jumps.count().bit_length() + 2):
        far = jumps.select(F.col("rev").alias("run"), F.col("run").alias("_run"), F.col("pos").alias("_pos"))
        doubled = jumps.join(far, "run", "left").select("rev", F.coalesce("_run", "run").alias("run"), (F.col("pos") + F.coalesce("_pos", F.lit(0))).alias("pos"), F.col("_run").isNotNull().alias("_moved"))
        doubled = _cut(doubled)
        jumps = doubled.drop("_moved")
        if doubled.where("_moved").isEmpty():
            break
    else:
        raise ValueError("a chain goes round in a circle")
    between = edges.join(links, [here, there], "left_anti")
    return jumps, _cut(between.join(jumps.select(F.col("rev").alias(there), "run"), there, "left").select(F.col(here).alias("run"), F.coalesce("run", there).alias("next")).distinct())


def _placed(rows: DataFrame, runs: DataFrame, key: str = "rev") -> DataFrame:
    """``rows`` with the run and the place of their node."""
    at = runs.select(F.col("rev").alias(key), "run", "pos")
    return rows.join(at, key, "left").withColumn("run", F.coalesce("run", key)).withColumn("pos", F.coalesce("pos", F.lit(0)))


def _closure(edges: DataFrame, starts: DataFrame, down: bool, follow: DataFrame | None = None) -> DataFrame:
    """(rev) of the starts and all that is reached from them."""
    if follow is not None:
        here = "parent" if down else "child"
        edges = edges.join(follow.select(F.col("rev").alias(here)).distinct(), here, "left_semi")
    seen = F.lit(0).alias("seen")
    return sweep(edges.select("child", "parent", seen), starts.select("rev", seen), {"seen": "any"}, down).select("rev")


def ancestors(nodes: DataFrame, edges: DataFrame, starts: DataFrame, follow: DataFrame | None = None) -> DataFrame:
    """(rev) of the known starts and all their ancestors; only nodes in ``follow``, if given, are expanded."""
    return _closure(edges, starts.join(nodes, "rev", "left_semi"), False, follow)


def descendants(nodes: DataFrame, edges: DataFrame, starts: DataFrame, follow: DataFrame | None = None, known: bool = False) -> DataFrame:
    """(rev) of the starts and all their descendants; nothing, if any start is unknown. ``known`` says that none is: then the starts are worked out once."""
    known = known or starts.join(nodes.select("rev"), "rev", "left_anti").isEmpty()
    return _closure(edges, starts if known else starts.limit(0), True, follow)


def _sides(nodes: DataFrame, edges: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """(rev, sides) of the ancestors of either: 1 those of ``first``, 2 of ``second``, 3 of both, by one sweep."""
    asked = first.select("rev", F.lit(1).alias("sides")).unionAll(second.select("rev", F.lit(2)))
    return sweep(edges.select("child", "parent", F.lit(0).alias("sides")), asked.join(nodes, "rev", "left_semi"), {"sides": "or"}, False)


def rev_range(nodes: DataFrame, edges: DataFrame, include: DataFrame, exclude: DataFrame) -> DataFrame:
    """Ancestors of ``include`` less ancestors of ``exclude``."""
    return _sides(nodes, edges, include, exclude).where("sides = 1").select("rev")


def boundary(edges: DataFrame, inside: DataFrame) -> DataFrame:
    """Parents of nodes inside that are not inside themselves."""
    out = edges.join(inside.select(F.col("rev").alias("child")), "child", "left_semi").select(F.col("parent").alias("rev")).distinct()
    return out.join(inside, "rev", "left_anti")


def ancestry_path(nodes: DataFrame, edges: DataFrame, include: DataFrame, exclude: DataFrame) -> DataFrame:
    """The part of a range that descends from what it excludes."""
    return rev_range(nodes, edges, include, exclude).join(descendants(nodes, edges, exclude), "rev", "left_semi")


def generation(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(rev, depth): the longest way from a root."""
    depths = sweep(edges.select("child", "parent", F.lit(1).alias("depth")), nodes.select("rev", F.lit(0).alias("depth")), {"depth": "max"}, True)
    return depths.select("rev", F.col("depth").cast("int").alias("depth"))


def is_ancestor(nodes: DataFrame, edges: DataFrame, pairs: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """``pairs`` (a, b) with ``is_ancestor``: a is b or an ancestor of b; ``index`` are the graph's labels, if they are kept."""
    return labels.is_ancestor(nodes, edges, pairs, index)


def fast_forward(nodes: DataFrame, edges: DataFrame, updates: DataFrame, index: DataFrame | None = None) -> DataFrame:
    """``updates`` (ref, old, new) with ``kind``: ``new``, ``gone``, ``same``, ``forward`` (the old node is an ancestor of the new one) or ``forced``."""
    pairs = updates.where("old IS NOT NULL AND new IS NOT NULL").select(F.col("old").alias("a"), F.col("new").alias("b")).distinct()
    told = is_ancestor(nodes, edges, pairs, index).withColumnsRenamed({"a": "old", "b": "new"})
    kind = (
        F.when(F.col("old").isNull() & F.col("new").isNull(), F.lit(None))
        .when(F.col("old").isNull(), "new")
        .when(F.col("new").isNull(), "gone")
        .when(F.col("old") == F.col("new"), "same")
        .when(F.col("is_ancestor"), "forward")
        .otherwise("forced")
    )
    return updates.join(told, ["old", "new"], "left").withColumn("kind", kind).drop("is_ancestor").select(*updates.columns, "kind")


def reachable(nodes: DataFrame, edges: DataFrame, targets: DataFrame, sources: DataFrame) -> DataFrame:
    """Those targets that are sources or their ancestors."""
    return targets.join(ancestors(nodes, edges, sources), "rev", "left_semi")


def common_heads(nodes: DataFrame, edges: DataFrame, local_heads: DataFrame, remote: DataFrame) -> DataFrame:
    """Heads of what local history and the remote's known nodes have in common; what is known has known ancestors."""
    return heads(_sides(nodes, edges, local_heads, remote).where("sides = 3").select("rev"), edges)


def strip(nodes: DataFrame, edges: DataFrame, starts: DataFrame) -> DataFrame:
    """``nodes`` less the starts and their descendants."""
    return nodes.join(descendants(nodes, edges, starts), "rev", "left_anti")


def _told_apart(links: DataFrame, start: DataFrame) -> DataFrame | None:
    """(number, id): a number for each identifier by its hash, written; None where two identifiers have one hash."""
    every = links.select("id").unionAll(links.select(F.col("prev").alias("id"))).unionAll(start.select("id"))
    names = _cut(every.groupBy(F.xxhash64("id").alias("number")).agg(F.min("id").alias("id"), (F.min("id") < F.max("id")).alias("_same")))
    return names.select("number", "id") if names.where("_same").isEmpty() else None


def linear_walk(links: DataFrame, start: DataFrame) -> DataFrame:
    """(id, step) along (id, prev) from ``start`` back to the chain's begin: over runs of links, and by doubling over the chain of runs.

    The walk goes over numbers, which are the identifiers' hashes where these are all different. A circle is an error.
    """
    links = links.where("prev is not null").select("id", "prev")
    known = start.where("id IS NOT NULL")
    names = _told_apart(links, known)
    if names is None:
        return _walk(links, start)
    of = lambda c: F.xxhash64(c).alias(c)
    steps = _walk(links.select(of("id"), of("prev")), known.select(of("id"))).withColumnRenamed("id", "number")
    return steps.join(names, "number").select("id", "step")


def _walk(links: DataFrame, start: DataFrame) -> DataFrame:
    runs, between = _runs(links, "id", "prev", SPLIT)
    lengths = runs.groupBy("run").agg(F.max("pos").alias("top"))
    entered = _cut(_placed(start.select(F.col("id").alias("rev")), runs).select("run", F.col("pos").alias("top"), F.lit(0).cast("long").alias("step")))
    weighed = between.join(lengths.select(F.col("run").alias("next"), "top"), "next", "left").select("run", "next", F.coalesce("top", F.lit(0)).cast("long").alias("top"))
    # a jump's step counts from a run's end to the first node of the run it leads to
    jumps, reached = _cut(weighed.select("run", "next", "top", F.lit(1).cast("long").alias("step"))), entered
    for _ in range(jumps.count().bit_length() + 2):
        new = _cut(reached.join(jumps.withColumnsRenamed({"top": "_top", "step": "_step"}), "run").select(F.col("next").alias("run"), F.col("_top").alias("top"), (F.col("step") + F.col("top") + F.col("_step")).alias("step")))
        if new.isEmpty():
            break
        reached = _cut(reached.unionAll(new))
        there = jumps.select(F.col("run").alias("next"), F.col("next").alias("_next"), F.col("top").alias("_top"), F.col("step").alias("_step"))
        jumps = _cut(jumps.join(there, "next").select("run", F.col("_next").alias("next"), F.col("_top").alias("top"), (F.col("step") + F.col("top") + F.col("_step")).alias("step")))
    else:
        raise ValueError("a chain goes round in a circle")
    inside = runs.join(reached, "run").where(F.col("pos") <= F.col("top"))
    ends = reached.select(F.col("run").alias("id"), (F.col("step") + F.col("top")).cast("int").alias("step"))
    return ends.unionAll(inside.select(F.col("rev").alias("id"), (F.col("step") + F.col("top") - F.col("pos")).cast("int").alias("step")))


def infer_branches(nodes: DataFrame, edges: DataFrame, pushes: DataFrame) -> DataFrame:
    """(rev, branch, kind) of ``nodes`` (rev, p1, branch, known): ``known``, ``set`` by a push, or ``inferred``.

    A push (rev, branch, order) names the branch of its node and of all ancestors that are reached through
    unknown nodes only; of several pushes the first counts. What is left takes the branch of its nearest known
    first parent, found by doubling; NULL, if there is none.
    """
    unknown = _cut(nodes.where(~F.col("known")).select("rev", "p1"))
    inner = edges.join(unknown.select(F.col("rev").alias("parent")), "parent", "left_semi")
    first = _cut(pushes.join(unknown, "rev", "left_semi").groupBy("rev").agg(F.min("order").alias("order")))
    inner = inner.join(unknown.select(F.col("rev").alias("child")), "child", "left_semi")
    named = sweep(inner.select("child", "parent", F.lit(0).alias("order")), first, {"order": "min"}, False)
    known = nodes.where("known").select("rev", "branch")
    jump = unknown.join(known.select(F.col("rev").alias("p1"), F.lit(True).alias("done")), "p1", "left").select(
        "rev", F.col("p1").alias("at"), (F.col("p1").isNull() | F.coalesce("done", F.lit(False))).alias("done")
    )
    jump = _cut(jump)
    for _ in range(jump.count().bit_length() + 2):
        if jump.where("NOT done").isEmpty():
            break
        to = jump.select(F.col("rev").alias("at"), F.col("at").alias("next"), F.col("done").alias("next_done"))
        further = jump.join(to, "at", "left").select(
            "rev",
            F.when(F.col("done"), F.col("at")).otherwise(F.col("next")).alias("at"),
            (F.col("done") | F.coalesce("next_done", F.lit(True))).alias("done"),
        )
        jump = _cut(further)
    else:
        raise ValueError("first parents go round in a circle")
    inferred = jump.join(known.withColumnRenamed("rev", "at"), "at", "left").select("rev", F.col("branch").alias("near"))
    pushed = pushes.groupBy("order").agg(F.first("branch").alias("pushed"))
    left = inferred.join(named, "rev", "left").join(pushed, "order", "left")
    chosen = left.select(
        "rev", F.when(F.col("order").isNotNull(), F.col("pushed")).otherwise(F.col("near")).alias("branch"), F.when(F.col("order").isNotNull(), "set").otherwise("inferred").alias("kind")
    )
    return known.withColumn("kind", F.lit("known")).unionByName(chosen)


def rewrite(nodes: DataFrame, inside: DataFrame, new_id: Callable[[str | None, str | None, bytes | None], str]) -> DataFrame:
    """(rev, new_node) for the nodes of ``nodes`` (rev, node, p1, p2, content) that ``inside`` names.

    ``new_id`` makes an identifier of the parents' identifiers (new ones for parents inside) and the content; it runs in
    topological order, block by block.
    """
    part = nodes.join(inside.select("rev").distinct(), "rev", "left_semi")
    for k in ("p1", "p2"):
        part = part.join(nodes.select(F.col("rev").alias(k), F.col("node").alias(f"{k}_id")), k, "left")
    return derived(part.select("rev", "p1", "p2", "p1_id", "p2_id", "content"), new_id)


def _chosen(rows: DataFrame, order: Column, size: int) -> DataFrame:
    """``size`` revs of ``rows`` (rev, kind), kinds in order and the last by the hash ``order``; if they are many, about as many, and no task sees all."""
    if size <= SAMPLED:
        return _cut(rows.orderBy("kind", order).limit(size).select("rev"))
    rows = _cut(rows)
    keep = F.lit(False)
    for kind, n in sorted(rows.groupBy("kind").count().collect()):  # three numbers
        own = F.col("kind") == kind
        keep = keep | (own if n <= size else own & (order < F.lit(-(1 << 63) + (size << 64) // n)))
        size = max(0, size - n)
    return _cut(rows.where(keep).select("rev"))


def _kinds(open_: DataFrame, ways: DataFrame) -> DataFrame:
    """(rev, kind) of ``open_``: 0 of nodes without a child along ``ways``, 1 of others without a parent, 2 of the rest."""
    zero, one = F.lit(0), F.lit(1)
    ends = [open_.select("rev", one, zero, zero), ways.select("parent", zero, one, zero), ways.select("child", zero, zero, one)]
    met = ends[0].unionAll(ends[1]).unionAll(ends[2]).toDF("rev", "here", "above", "below")
    marks = met.groupBy("rev").agg(*[F.max(c).alias(c) for c in ("here", "above", "below")]).where("here = 1")
    return marks.select("rev", F.when(F.col("above") == 0, 0).when(F.col("below") == 0, 1).otherwise(2).alias("kind"))


def discover(nodes: DataFrame, edges: DataFrame, remote: DataFrame, sample: int = 100, seed: int = 7) -> DataFrame:
    """(rev): heads of what ``remote`` knows of ``nodes``, found by asking about samples.

    A known node's ancestors are known, an unknown one's descendants are unknown; each round asks about heads, roots
    and seeded others of what is open: ``sample`` nodes in the first, twice as many in each of the next two and four times as many in each that
    follows, so rounds grow with the logarithm of the nodes, however many heads there are. The result is that of :func:`common_heads`.

    All ways between open nodes go by open nodes, so a round keeps only the edges between these; they are laid out anew when three
    quarters of the nodes are settled.
    """
    open_, edges = _cut(nodes.select("rev")), _cut(edges.select("child", "parent"))
    ways, known = edges, nodes.select(F.col("rev").cast("long").alias("rev")).limit(0)
    laid, held = None, 0
    turn = 0
    while left := open_.count():
        if laid is None or 4 * left < held:
            if laid is not None:
                laid.drop()
            laid, held = Laid(open_, ways), left
        order = F.xxhash64("rev", F.lit(seed + turn))
        asked = _chosen(_kinds(open_, ways), order, sample << (turn if turn < 3 else 2 * turn - 2))
        has = _cut(remote.select("rev").join(near(asked), "rev", "left_semi").distinct())
        yes, no = laid.reached(has, False), laid.reached(asked.join(near(has), "rev", "left_anti"), True)
        known = known.unionAll(yes.join(near(open_, left), "rev", "left_semi"))
        closed = yes.unionAll(no)
        closed, n = closed.distinct(), closed.count()
        open_ = _cut(open_.join(near(closed, n), "rev", "left_anti"))
        for end in ("child", "parent"):
            ways = ways.join(near(closed.withColumnRenamed("rev", end), n), end, "left_anti")
        ways = _cut(ways.select("child", "parent"))
        turn += 1
    return heads(_cut(known).hint("merge"), edges)
