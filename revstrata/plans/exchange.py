"""Queries over what goes between repositories: ranges as bundles, merges with their files' history, fetched references, edits of notes."""

from __future__ import annotations

from pyspark.sql import functions as F

from revstrata.functions import text
from revstrata.functions.identity import packed, unpacked
from revstrata.operators import dag, delta, history, integrity, live, paths, refs, tags, transfer
from revstrata.plans import transfers, views
from revstrata.plans.authoring import SIDES_SQL, _three
from revstrata.plans.catalog import query
from revstrata.plans.transfers import HISTORY_SQL, LINE
from revstrata.plans.views import TAGS_SQL
from revstrata.sources import bundle
from revstrata.tables import load

ONE_SIDED_SQL = """
WITH e AS (SELECT l_orderkey % 3 AS k, l_suppkey, 'd' || l_linenumber AS path, min(sha1(CAST(l_partkey AS VARCHAR))) AS f FROM lineitem GROUP BY ALL),
a AS (SELECT l_suppkey, path, m.f AS n, x.f AS o FROM (FROM e WHERE k = 0) m FULL JOIN (FROM e WHERE k = 1) x USING (l_suppkey, path) WHERE m.f IS DISTINCT FROM x.f),
b AS (SELECT l_suppkey, path, m.f AS n, y.f AS o FROM (FROM e WHERE k = 0) m FULL JOIN (FROM e WHERE k = 2) y USING (l_suppkey, path) WHERE m.f IS DISTINCT FROM y.f)
SELECT l_suppkey, path, CASE WHEN a.l_suppkey IS NOT NULL THEN a.n ELSE b.n END AS new, CASE WHEN a.l_suppkey IS NOT NULL THEN a.o ELSE b.n END AS first,
  CASE WHEN b.l_suppkey IS NOT NULL THEN b.o ELSE a.n END AS second FROM a FULL JOIN b USING (l_suppkey, path)"""


@query(f"""WITH {HISTORY_SQL}, k AS (SELECT rev, block, row_number() OVER (PARTITION BY block ORDER BY rev) AS n, count(*) OVER (PARTITION BY block) AS size FROM history)
  SELECT rev FROM k WHERE size >= 6 AND n BETWEEN 4 AND 6""")
def getbundle(spark, d):
    """What a peer that has the third changeset of every line lacks of the sixth, as bundles, and read from these."""
    rows = transfers.history(spark, d)
    rows = dag._cut(rows.withColumn("version", F.lit(2)))
    sets = rows.where("section = 'changeset'").select(F.col("place").alias("rev"), "node", "p1", "p2")
    revs = sets.select(packed(F.col("node")).alias("node"), "rev")
    nodes = live.with_parents(sets.select("rev", "node"), sets, None)
    nodes = dag._cut(nodes.select("rev", "node", F.col("p1_rev").alias("p1"), F.col("p2_rev").alias("p2")))
    edges = dag.edges_of(nodes)
    heads, common = nodes.where(f"rev % {LINE} = 5").select("rev"), nodes.where(f"rev % {LINE} = 2").select("rev")
    sent = dag._cut(transfer.range_revisions(rows, nodes, edges, heads, common))  # it is read more than once
    encoded = bundle.encode_revisions(transfer.delta_revisions(sent, "bundle").withColumn("spec", F.lit("zstd-v2")), "bundle", "spec")
    got = bundle.decode_revisions(encoded, "bundle").where("section = 'changeset'")
    return got.select(packed(F.col("node")).alias("node")).join(revs, "node").select("rev")


@query(ONE_SIDED_SQL)
def manifest_diff3_one_sided(spark, d):
    path = F.concat(F.lit("d"), F.col("l_linenumber").cast("string")).alias("path")
    rows = load(spark, d, "lineitem").select("l_orderkey", "l_suppkey", path, F.sha1(F.col("l_partkey").cast("string")).alias("f"))
    m, x, y = (rows.where(f"l_orderkey % 3 = {k}").groupBy("l_suppkey", "path").agg(F.min("f").alias("f")) for k in range(3))
    return paths.three_way(m, x, y, ["l_suppkey", "path"], "f", one_sided=True)


@query(f"""WITH {SIDES_SQL}, f AS (SELECT * FROM side WHERE k = 0), a AS (SELECT * FROM side WHERE k = 1), b AS (SELECT * FROM side WHERE k = 2),
  m AS (SELECT l_suppkey, path, f.oid, f.attr, a.oid AS o1, b.oid AS o2, a.attr AS attr1 FROM f FULL JOIN a USING (l_suppkey, path) FULL JOIN b USING (l_suppkey, path)),
  q AS (SELECT *, CASE WHEN o1 IS NULL OR o2 IS NULL OR o1 = o2 THEN coalesce(o1, o2) WHEN l_suppkey % 3 = 0 THEN o2 WHEN l_suppkey % 3 = 1 THEN o1 END AS sole FROM m),
  p AS (SELECT *, CASE WHEN oid IS NULL THEN NULL WHEN o1 IS NULL AND o2 IS NULL THEN '' WHEN sole IS NOT NULL THEN sha1('f' || sole) ELSE concat_ws(' ', sha1('f' || o1), sha1('f' || o2)) END AS parents,
    coalesce(oid IS NOT NULL AND sole = oid, false) AS same FROM q)
  SELECT l_suppkey, path, parents, CASE WHEN same THEN sha1('f' || oid) END AS file_node,
    CASE WHEN oid IS NULL THEN true ELSE NOT same OR coalesce(attr1 <> attr, false) END AS listed FROM p WHERE oid IS NOT NULL OR o1 IS NOT NULL""")
def merge_manifest_ancestry(spark, d):
    """Merged manifests where one parent's file may be an ancestor of the other's: over a file between, for two of three suppliers."""
    keys = ["l_suppkey", "path"]
    as_bytes = {c: packed(F.col(c)) for c in ("oid", "file_node")}
    files, first, second = (side.withColumns(as_bytes) for side in _three(spark, d))
    both = first.select(*keys, F.col("file_node").alias("x")).join(second.select(*keys, F.col("file_node").alias("y")), keys).where("x <> y")
    none, between = F.lit(None).cast("binary"), packed(F.sha1(F.concat(unpacked(F.col("x")), F.lit("between"), unpacked(F.col("y")))))
    back = F.col("l_suppkey") % 3 == 1
    old, new = F.when(back, F.col("y")).otherwise(F.col("x")), F.when(back, F.col("x")).otherwise(F.col("y"))
    linked = F.col("l_suppkey") % 3 < 2
    three = F.array(
        F.struct(old.alias("node"), none.alias("p1"), F.lit(0).alias("order")),
        F.struct(between.alias("node"), old.alias("p1"), F.lit(1).alias("order")),
        F.struct(new.alias("node"), F.when(linked, between).alias("p1"), F.lit(2).alias("order")),
    )
    revisions = both.select(*keys, F.explode(three).alias("r")).select(*keys, "r.*").withColumn("p2", none)
    ancestry = history.file_ancestry(first, second, revisions, keys, "order")
    merged = paths.merged_manifest(files, first, second, keys, ancestry)
    return merged.withColumns({"parents": F.array_join(F.transform("parents", unpacked), " "), "file_node": unpacked(F.col("file_node"))})


@query("SELECT doc_id, sha1(encode(replace(coalesce(text, ''), 'e', 'EE') || 'end')) AS digest FROM documents")
def byte_deltas(spark, d):
    """Every document edited in all its lines, as a delta of bytes that is packed and applied again."""
    delta.small_batches(spark)
    old = F.coalesce("text", F.lit(""))
    new = F.concat(F.replace(old, F.lit("e"), F.lit("EE")), F.lit("end")).cast("binary")
    rows = load(spark, d, "documents").select("doc_id", old.cast("binary").alias("old"), new.alias("new"))
    packed = rows.withColumn("delta", delta.byte_delta(F.col("old"), F.col("new")))
    return packed.select("doc_id", F.sha1(delta.patched(F.col("old"), F.col("delta"))).alias("digest"))


@query("SELECT sha1(CAST(s_suppkey AS VARCHAR)) AS original, sha1(CAST(s_suppkey AS VARCHAR)) AS replacement FROM supplier WHERE s_suppkey = s_nationkey")
def self_replacements(spark, d):
    of = lambda c: F.sha1(F.col(c).cast("string"))
    return integrity.self_replacements(load(spark, d, "supplier").select(of("s_suppkey").alias("original"), of("s_nationkey").alias("replacement")))


@query(f"WITH {TAGS_SQL}, live AS (SELECT file, count(*) AS n FROM tags WHERE node <> '' GROUP BY file) SELECT true AS same, sum(n) = 0 AS same_as_none, sum(n)::BIGINT AS live FROM live")
def tags_compared(spark, d):
    """Tags of all files against themselves with their history forgotten and dead tags left out, and against none."""
    found = tags.tags_in_file(views.tag_lines(spark, d)).select(F.concat("tag", F.lit("@"), F.col("file").cast("string")).alias("tag"), "node", "hist")
    found = dag._cut(found)
    bare = tags.live(found).withColumn("hist", F.array().cast("array<string>"))
    return tags.live(found).agg(F.count("*").alias("live")).select(F.lit(tags.same_tags(found, bare)).alias("same"), F.lit(tags.same_tags(found, found.limit(0))).alias("same_as_none"), "live")


@query("""SELECT o_orderkey, sha1(CAST(o_orderkey AS VARCHAR)) || chr(9) || CASE WHEN o_orderstatus = 'F' THEN '' ELSE 'not-for-merge' END || chr(9) ||
  CASE o_orderkey % 4 WHEN 0 THEN 'branch ''' || o_orderpriority || ''' of ' WHEN 1 THEN 'tag ''v' || o_custkey || ''' of ' WHEN 2 THEN '''refs/notes/x'' of ' ELSE '' END || 'https://host/' || o_custkey AS line FROM orders""")
def fetch_head(spark, d):
    k = F.col("o_orderkey")
    name = F.when(k % 4 == 0, F.concat(F.lit("refs/heads/"), "o_orderpriority")).when(k % 4 == 1, F.concat(F.lit("refs/tags/v"), F.col("o_custkey").cast("string"))).when(k % 4 == 2, "refs/notes/x").otherwise("HEAD")
    rows = load(spark, d, "orders").select("o_orderkey", "o_custkey", F.sha1(k.cast("string")).alias("oid"), name.alias("name"), (F.col("o_orderstatus") == "F").alias("merge"))
    return refs.fetch_head(rows, F.concat(F.lit("https://host/"), F.col("o_custkey").cast("string"))).select("o_orderkey", "line")


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'branch:' || c_mktsegment || chr(0) END || 'close:1' || CASE WHEN c_custkey % 5 = 0 THEN '' ELSE chr(0) || 'source:' || c_nationkey END AS extra FROM customer""")
def extra_edits(spark, d):
    """A changeset's extra fields with one set, one set again or taken away, and one taken away."""
    k = F.col("c_custkey")
    begun = F.create_map(F.lit("branch"), F.lit("old"), F.lit("source"), F.col("c_nationkey").cast("string"))
    held = text.extra_set(F.when(k > -1, begun), "close", F.lit("1"))
    held = text.extra_set(held, "branch", F.when(k % 3 != 0, F.col("c_mktsegment")))
    held = text.extra_set(held, "source", F.when(k % 5 != 0, F.col("c_nationkey").cast("string")))
    return load(spark, d, "customer").select("c_custkey", text.extra_text(held).alias("extra"))
