"""What must hold where tables are large: few questions to the driver, no large table sent through it, work that is spread."""

from __future__ import annotations

from pyspark.sql import functions as F

from revstrata.operators import dag, delta, history, scratch, sweep


def plans(spark, since: int = -1) -> dict[int, str]:
    """The final plans of the session's queries with a number above ``since``."""
    listed = spark._jsparkSession.sharedState().statusStore().executionsList()
    every = [listed.apply(i) for i in range(listed.size())]
    return {e.executionId(): e.physicalPlanDescription().partition("== Initial Plan ==")[0] for e in every if e.executionId() > since}


def test_discovery_sends_no_large_table_through_the_driver(spark, monkeypatch):
    monkeypatch.setattr(sweep, "FEW", -1)  # as if every table were large
    nodes = spark.range(600).select(F.col("id").alias("rev"), F.when(F.col("id") > 0, F.expr("(id - 1) div 2")).alias("p1"), F.when(F.col("id") % 10 == 9, F.col("id") - 3).alias("p2"))
    nodes, remote = scratch.cut(nodes), scratch.cut(spark.range(200).select(F.col("id").alias("rev")))
    edges = scratch.cut(dag.edges_of(nodes))
    want = {r.rev for r in dag.common_heads(nodes, edges, nodes.select("rev"), remote).collect()}
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    since = max(plans(spark))
    got = dag.discover(nodes, edges, remote, sample=20)
    assert {r.rev for r in got.collect()} == want
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    met = [p for p in plans(spark, since).values() if "Join" in p]
    assert met and not [p for p in met if "BroadcastHashJoin" in p]


def test_what_is_reached_is_solved_block_by_block_from_edges_laid_out_once(spark):
    nodes = spark.range(90).select((F.col("id") * 7).alias("rev"), F.when(F.col("id") > 0, F.expr("((id - 1) div 2) * 7")).alias("p1"), F.when(F.col("id") % 5 == 4, (F.col("id") - 3) * 7).alias("p2"))
    edges = dag.edges_of(nodes)
    for size in (8, 1000):
        laid = sweep.Laid(nodes, edges, size)
        for starts, down in (("rev IN (623, 350)", False), ("rev IN (7, 21)", True)):
            own = nodes.where(starts).select("rev")
            want = dag.descendants(nodes, edges, own) if down else dag.ancestors(nodes, edges, own)
            assert {r.rev for r in laid.reached(own, down).collect()} == {r.rev for r in want.collect()}


def test_ranks_of_many_revs_are_not_sent_to_every_task(spark, monkeypatch):
    revs = scratch.cut(spark.range(50).select((F.col("id") * 1000).alias("rev")))
    blocks = sweep.Blocks(revs, 10)
    plan = lambda: blocks.place(revs, "rev")._jdf.queryExecution().executedPlan().toString()
    assert blocks.n == 5 and "BroadcastHashJoin" in plan()
    monkeypatch.setattr(sweep, "FEW", 49)
    assert "BroadcastHashJoin" not in plan()


def test_trees_are_dealt_once_to_all_their_sides(spark):
    commits = spark.range(1, 400).select(F.col("id").alias("commit"), F.when(F.col("id") % 4 > 0, F.expr("id div 4")).alias("p1"), F.when(F.col("id") % 4 > 1, F.expr("id div 3")).alias("p2"))
    files = spark.range(1, 400).select(F.col("id").alias("commit"), F.explode(F.sequence(F.lit(1), F.lit(4))).alias("k"))
    trees = scratch.cut(files.where("(commit + k) % 3 > 0").select("commit", F.concat(F.lit("f"), "k").alias("path"), F.concat(F.lit("n"), (F.col("commit") % F.col("k")).cast("string")).alias("file_node")))
    held = {(r.commit, r.path): r.file_node for r in trees.collect()}
    for one_sided in (False, True):
        want = set()
        for c, p1, p2 in commits.collect():
            for path in ("f1", "f2", "f3", "f4"):
                new, a, b = (held.get((x, path)) for x in (c, p1, p2))
                if p1 is None and new is not None:
                    want.add((c, path, new, ()))
                elif p1 is not None and p2 is None and new != a:
                    want.add((c, path, new, (a,)))
                elif p1 is not None and p2 is not None and ((new != a or new != b) if one_sided else (new != a and new != b)):
                    want.add((c, path, new, (a, b)))
        got = history.changes_of(trees, commits, one_sided)
        assert {(r.commit, r.path, r.file_node, tuple(r.parents)) for r in got.collect()} == want
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1


def test_lines_in_step_are_kept_without_a_search(monkeypatch):
    def searched(*a, **k):
        raise AssertionError("lines were searched")

    monkeypatch.setattr(delta.difflib, "SequenceMatcher", searched)
    assert delta.line_hunks(b"m1\na1\n60 0\nb7\n\norder 1", b"m2\na2\n120 0\nb7\n\norder 2") == [(0, 11, b"m2\na2\n120 0\n"), (15, 22, b"order 2")]
    assert delta.line_hunks(b"x\nk\nl\ny\n", b"k\nz\nl\n") == [(0, 2, b""), (4, 4, b"z\n"), (6, 8, b"")]
