"""How much is shuffled and written a row: figures that grow with the input and were many times as large once."""

import pytest
from pyspark.sql import functions as F
from revstrata.functions import identity
from revstrata.operators import dag, paths, peer, sweep, transfer
from revstrata.operators import history as history_of
from revstrata.plans import registry, transfers
from test_transfer import ROWS, history

SF = "/root/testdata/sf0.001"


def moved(spark):
    """Bytes shuffled and written so far."""
    gateway = spark.sparkContext._gateway
    stages = spark._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(gateway.jvm.double, 0), gateway.jvm.java.util.ArrayList())
    return {(s.stageId(), s.attemptId()): s.shuffleWriteBytes() + s.outputBytes() for s in (stages.apply(k) for k in range(stages.size()))}


def moved_by(spark, work):
    before = moved(spark)
    work()
    return sum(n for stage, n in moved(spark).items() if stage not in before)


def run(spark, name):
    return lambda: registry.queries()[name](spark, SF).write.format("noop").mode("overwrite").save()


def test_deltas_move_rows_once(spark):
    rows = transfers.history(spark, SF)
    n = rows.count()
    assert moved_by(spark, lambda: transfer.delta_revisions(rows, "bundle").write.format("noop").mode("overwrite").save()) < 700 * n


@pytest.mark.parametrize("size", [1, 1 << 24])
@pytest.mark.parametrize("version", [1, 2])
def test_deltas_with_and_without_texts_at_hand(spark, monkeypatch, size, version):
    df = spark.createDataFrame([(r[0], version, *r[1:]) for r in history(60)], ROWS)
    want = {tuple(r) for r in transfer.delta_revisions(df, "bundle").collect()}
    monkeypatch.setattr(transfer, "RECENT", size)
    got = transfer.delta_revisions(df, "bundle")
    assert {tuple(r) for r in got.collect()} == want and len(want) == 240
    places = got.groupBy("bundle", "section", "path").agg(F.count("*").alias("n"), F.max("seq").alias("top"), F.count_distinct("seq").alias("d"))
    assert places.where("top <> n - 1 OR d <> n").isEmpty()
    whole = {(r.path, r.node): bytes(r.content) for r in transfer.texts(got).collect()}
    assert whole == {(r[3] or "", r[4]): r[8] or b"" for r in history(60)}


def test_imports_move_rows_a_few_times(spark):
    n = transfers.history(spark, SF).count()
    assert moved_by(spark, run(spark, "bundle_import")) < 1500 * n


def test_discovery_takes_few_rounds_for_many_heads(spark, monkeypatch):
    turns = []
    chosen = dag._chosen
    monkeypatch.setattr(dag, "_chosen", lambda rows, order, size: turns.append(size) or chosen(rows, order, size))
    monkeypatch.setattr(dag, "SAMPLED", 50)
    nodes = spark.range(800).select(F.col("id").alias("rev"), F.when(F.col("id") > 0, F.lit(0)).alias("p1"), F.lit(None).cast("long").alias("p2"))  # a root with 799 heads
    remote = nodes.where("rev % 2 = 0").select("rev")
    got = dag.discover(nodes, dag.edges_of(nodes), remote, sample=5)
    assert {r.rev for r in got.collect()} == set(range(2, 800, 2))
    assert len(turns) < 12 and turns[:3] == [5, 10, 20]


@pytest.mark.parametrize("same", [False, True])
def test_chains_are_walked_in_short_runs(spark, monkeypatch, same):
    n = 20_000
    of = lambda k: F.sha1(k.cast("string"))
    links = spark.range(n).select(of(F.col("id")).alias("id"), F.when(F.col("id") > 0, of(F.col("id") - 1)).alias("prev"))
    start = spark.range(1).select(of(F.lit(n - 1)).alias("id"))
    want = spark.range(n).select(of(F.col("id")).alias("id"), (n - 1 - F.col("id")).cast("int").alias("step"))
    if same:  # as if two identifiers had one hash
        monkeypatch.setattr(dag, "_told_apart", lambda links, start: None)
    got = []
    size = moved_by(spark, lambda: got.append({tuple(r) for r in dag.linear_walk(links, start).collect()}))
    assert got[0] == {tuple(r) for r in want.collect()}
    assert same or size < 1000 * n


def test_a_circle_of_split_runs_is_an_error(spark):
    circle = spark.range(400).select("id", F.pmod(F.col("id") + 1, F.lit(400)).alias("prev"))
    with pytest.raises(ValueError, match="circle"):
        dag.linear_walk(circle, spark.range(1)).collect()


def test_overlays_move_rows_a_few_times(spark):
    n = spark.read.parquet(f"{SF}/orders.parquet").count()
    assert moved_by(spark, run(spark, "bundle_overlay")) < 2500 * n


def test_what_both_have_is_one_sweep(spark, monkeypatch):
    turns = []
    swept = dag.sweep
    monkeypatch.setattr(dag, "sweep", lambda *a, **k: turns.append(1) or swept(*a, **k))
    nodes = spark.range(40).select(F.col("id").alias("rev"), F.when(F.col("id") > 0, F.expr("(id - 1) div 2")).alias("p1"), F.lit(None).cast("long").alias("p2"))
    got = dag.common_heads(nodes, dag.edges_of(nodes), nodes.where("rev IN (17, 20)"), nodes.where("rev IN (18, 39)"))
    assert {r.rev for r in got.collect()} == {8, 9} and len(turns) == 1


def test_blocks_are_few(spark):
    assert sweep.Blocks(spark.range(1 << 20).withColumnRenamed("id", "rev")).n == 1


def test_identifiers_are_derived_in_few_stages(spark):
    rows = spark.range(70_000).select(F.col("id").alias("rev"), F.when(F.col("id") > 0, F.col("id") - 1).alias("p1"), F.lit(None).cast("long").alias("p2"), F.lit(None).cast("string").alias("p1_id"), F.lit(None).cast("string").alias("p2_id"), F.lit(b"x").alias("content"))
    before = set(moved(spark))
    made = sweep.derived(rows, lambda a, b, content: str(int(a or 0) + 1))
    assert made.where(F.col("new_node").cast("long") != F.col("rev") + 1).isEmpty() and made.count() == 70_000
    assert len(set(moved(spark)) - before) < 15


def test_small_batches_bound_deltas_of_texts(spark):
    registry.queries()["byte_deltas"](spark, SF)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 200


def test_changes_of_nodes_that_are_bytes(spark):
    trees = spark.createDataFrame([(0, "a", b"\xff"), (1, "a", b"\xfe"), (1, "b", b"\x01")], "commit long, path string, file_node binary")
    commits = spark.createDataFrame([(0, None, None), (1, 0, None)], "commit long, p1 long, p2 long")
    got = {(r.commit, r.path, bytes(r.file_node), tuple(p and bytes(p) for p in r.parents)) for r in history_of.changes_of(trees, commits).collect()}
    assert got == {(0, "a", b"\xff", ()), (1, "a", b"\xfe", (b"\xff",)), (1, "b", b"\x01", (None,))}


def test_trees_of_what_is_no_identifier(spark):
    rows = spark.createDataFrame([(1, "d/a", "100644", "no hex")], "k long, path string, mode string, oid string")
    with pytest.raises(Exception, match="no identifier is no hex"):
        paths.tree_objects(rows, ["k"]).collect()


@pytest.fixture
def joined(spark):
    """As where tables are large: no side of a join is sent to all tasks."""
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)


def rows_of(spark, table):
    return spark.read.parquet(f"{SF}/{table}.parquet").count()


@pytest.mark.parametrize(("name", "table", "most"), [
    ("reclone", "orders", 2800), ("bundle_overlay", "orders", 2200), ("getbundle", "orders", 2100),
    ("changeset_rebuild", "orders", 750), ("merge_manifest_ancestry", "lineitem", 206), ("stored_path_diff", "lineitem", 309),
    ("similar_renames", "documents", 3000), ("phases_read", "orders", 250),
])
def test_joins_move_rows_a_few_times(joined, name, table, most):
    got = moved_by(joined, run(joined, name)) / rows_of(joined, table)
    assert got < most


def test_packed_identifiers_and_other_texts(spark):
    texts = ["0" * 40, "ab" * 20, "AB" * 20, "", "x", "a" * 19, "é" * 20, "a" * 41, "00" * 20 + "\n", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", identity.packed(F.col("t")).alias("p"))
    got = df.select("t", "p", identity.unpacked(F.col("p")).alias("u")).collect()
    assert all(r.t == r.u for r in got) and len({bytes(r.p) for r in got if r.p is not None}) == 9 and len(got[0].p) == 20


def test_what_goes_along_with_derived_identifiers(spark):
    rows = spark.range(50).select(F.col("id").alias("rev"), F.when(F.col("id") > 0, F.col("id") - 1).alias("p1"), F.lit(None).cast("long").alias("p2"), F.lit(None).cast("string").alias("p1_id"), F.lit(None).cast("string").alias("p2_id"), F.lit(b"x").alias("content"), F.col("id").cast("string").cast("binary").alias("name"))
    for size in (7, 1 << 20):
        made = sweep.derived(rows, lambda a, b, content: str(int(a or 0) + 1), size=size, kept="name", revs=spark.range(50).withColumnRenamed("id", "rev"))
        assert {(r.rev, bytes(r.name), r.new_node) for r in made.collect()} == {(k, str(k).encode(), str(k + 1)) for k in range(50)}


def test_phases_of_odd_nodes(spark):
    ids = ["ab" * 20, "cd" * 20, "no hex", None, "", "0" * 40]
    nodes = spark.createDataFrame([(k, ids[k]) for k in range(6)], "rev long, node string")
    edges = spark.createDataFrame([(1, 0), (2, 1), (4, 2), (3, -1), (5, 3)], "child long, parent long")
    drafts = spark.createDataFrame([(1,), (2,), (3,), (-1,), (None,), (1,)], "rev long")  # -1 is no node, so 3 is a root
    keys = peer.phase_keys(nodes, edges, drafts)
    assert sorted(map(tuple, keys.collect()), key=str) == [("cd" * 20, "1"), ("publishing", "True"), (None, "1")]
    assert {r.rev for r in peer.drafts_of(keys, nodes, edges).collect()} == {1, 2, 4}
    assert {r.rev for r in peer.drafts_of(peer.phase_keys(nodes, edges, drafts.where("rev = 2"), False), nodes, edges).collect()} == {2, 4}
