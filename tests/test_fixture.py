"""The shared repository of six changesets: every identifier from the identity functions alone."""

from pyspark.sql import functions as F

from revstrata.functions import identity, text
from revstrata.operators import dag, integrity, refs

#: The identifiers of a small repository of the tests' model.
ROWS = [
    (0, "a", None, None, "f92470d7f6966a39dfbced6a525fe81ebf5c37b9", "a0c8bcbbb45c63b90b70ad007bf38961f64f2af0", "b789fdd96dc2f3bd229c1dd8eedf0fc60e2b68e3"),
    (1, "b", 0, None, "636e60525868096cbdc961870493510558f41d2f", "a539ce0c1a22b0ecf34498f9f5ce8ea56df9ecb7", "1e88685f5ddec574a34c70af492f95b6debc8741"),
    (2, "c", 0, None, "ae078ae353a9b004afbd6fd6e5e7a5a0a48a4307", "91567922f69baa34a6ec16863dc23baaece895fa", "149da44f2a4e14f488b7bd4157945a9837408c00"),
    (3, "d", 2, None, "7937e1a594596ae25c637d317503d775767671b5", "32bd5e9be1d71a286864883652cc5e691619d31e", "a9092a3d84a37b9993b5c73576f6de29b7ea50f6"),
    (4, "e", 2, "foo", "872d4a0c72d8c2b915a4d85b4f31ca4a12c882eb", "add340bb21de71d269d1331001c362530241bc48", "6b67ccefd5ce6de77e7ead4f5292843a0255329f"),
    (5, "f", 4, "foo", "312a5a9c675e3ce302a33bd4605205a6be36d561", "37e75aa92da67a75f34dbb6cdd74fa35172f207a", "9c53acf3962808001711385edf68bef7b047de95"),
]
SCHEMA = "rev int, x string, p1 int, branch string, node string, manifest string, file_node string"


def _frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_identifiers(spark):
    rows = _frame(spark)
    parent = rows.select(F.col("rev").alias("p1"), F.col("node").alias("pnode"), F.col("manifest").alias("pmanifest"))
    lines = {0: "a", 1: "ab", 2: "ac", 3: "acd", 4: "ace", 5: "acef"}
    entries = spark.createDataFrame([(r, p) for r, ps in lines.items() for p in ps], "manifest int, path string").join(
        rows.select(F.col("x").alias("path"), "file_node"), "path"
    ).withColumn("attr", F.lit(""))
    content = integrity.manifest_contents(entries).select(F.col("manifest").alias("rev"), "content")
    none = F.lit(None).cast("string")
    extra = F.when(F.col("branch").isNotNull(), F.concat(F.lit(" branch:"), "branch")).otherwise("")
    raw = F.concat("manifest", F.lit("\nnobody\n"), F.col("rev").cast("string"), F.lit(" 0"), extra, F.lit("\n"), "x", F.lit("\n\n"), "x")
    out = rows.join(parent, "p1", "left").join(content, "rev").select(
        "x",
        (identity.node_hash(none, none, F.concat("x", F.lit("\n"))) == F.col("file_node")).alias("file"),
        (identity.node_hash(F.col("pmanifest"), none, F.col("content")) == F.col("manifest")).alias("manifest"),
        (identity.node_hash(F.col("pnode"), none, raw) == F.col("node")).alias("changeset"),
        text.split_changeset(raw).alias("parsed"),
    ).collect()
    assert len(out) == 6
    for r in out:
        assert r["file"] and r["manifest"] and r["changeset"], r["x"]
        assert r.parsed.files == [r.x] and r.parsed.body == r.x and r.parsed.author == "nobody"


def test_heads_and_tips(spark):
    rows = _frame(spark).select("rev", "node", F.coalesce("branch", F.lit("default")).alias("branch"), F.lit(False).alias("closed"), "p1", F.lit(None).cast("int").alias("p2"), "x")
    edges = dag.edges_of(rows)
    names = dict((r.rev, r.x) for r in rows.collect())
    found = dag.branch_heads(rows.select("rev", "branch"), edges)
    assert {names[r.rev] for r in found.collect()} == {"b", "d", "f"}
    assert {names[r.rev] for r in dag.topological_heads(rows.select("rev", "branch"), edges).collect()} == {"b", "d", "f"}
    tips = {r.branch: names[r.rev] for r in refs.tips(found.join(rows.select("rev", "closed"), "rev")).collect()}
    assert tips == {"default": "d", "foo": "f"}
    listed = {r.ref for r in refs.listing(rows, edges).collect()}
    assert "refs/heads/branches/foo/tip" in listed and f"refs/heads/branches/default/{ROWS[1][4]}" in listed and len(listed) == 5


def test_empty_blob_and_file_parents(spark):
    r = spark.range(1).select(identity.object_id(F.lit("blob"), F.lit("")).alias("blob")).first()
    assert r.blob == "e69de29bb2d1d6434b8b29ae775ad8c2e48c5391"
    a, b = F.lit("1" * 40), F.lit("2" * 40)
    data = F.lit("x")
    none = F.lit(None).cast("string")
    row = spark.range(1).select(
        identity.file_parents(identity.node_hash(a, b, data), a, b, data).alias("both"),
        identity.file_parents(identity.node_hash(a, none, data), a, b, data).alias("one"),
        identity.file_parents(identity.node_hash(b, b, data), a, b, data).alias("twice"),
        identity.file_parents(identity.node_hash(none, none, data), a, b, data).alias("none"),
        identity.file_parents(F.lit("0" * 40), a, b, data).alias("bad"),
    ).first()
    assert row.both == ["1" * 40, "2" * 40] and row.one == ["1" * 40] and row.twice == ["2" * 40] * 2 and row["none"] == [] and row.bad is None
