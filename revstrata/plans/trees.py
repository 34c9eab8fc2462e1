"""Queries over renames by likeness and trees compared by stored digests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revstrata.functions.identity import packed, unpacked
from revstrata.operators import digests, similarity
from revstrata.plans import views
from revstrata.plans.catalog import query
from revstrata.plans.views import EVEN_ODD
from revstrata.tables import load

THRESHOLDS = (50, 90, 100)

LIKENESS_SQL = """
WITH files AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
o AS (SELECT sha1(text) AS blob, min('old/' || doc_id) AS path, any_value(text) AS text FROM files GROUP BY 1),
n AS (SELECT 'new/' || doc_id AS path, CASE doc_id % 3 WHEN 0 THEN text ELSE left(text, (length(text) * CASE doc_id % 3 WHEN 1 THEN 4 ELSE 3 END // 5)::INT) END AS text FROM files),
nb AS (SELECT DISTINCT sha1(text) AS blob, text FROM n),
lines AS (SELECT side, blob, size, line, count(*) AS times, octet_length(encode(line)) AS weight FROM (
  SELECT side, blob, octet_length(encode(text)) AS size, unnest(list_concat(list_transform(p[1 : len(p) - 1], lambda x: x || chr(10)), p[len(p) :])) AS line
  FROM (SELECT 'o' AS side, blob, text, string_split(text, chr(10)) AS p FROM o UNION ALL SELECT 'n', blob, text, string_split(text, chr(10)) FROM nb)) WHERE line <> '' GROUP BY ALL),
scores AS MATERIALIZED (SELECT a.blob AS ob, b.blob AS nb, 100 * sum(least(a.times, b.times) * a.weight) // greatest(max(a.size), max(b.size)) AS score
  FROM lines a JOIN lines b ON a.line = b.line AND a.side = 'o' AND b.side = 'n' AND a.blob <> b.blob GROUP BY 1, 2
  UNION ALL SELECT o.blob, nb.blob, 100 FROM o JOIN nb USING (blob)),
best AS (SELECT t.threshold, n.path AS target, min((-score, o.path)) AS m FROM (VALUES (50), (90), (100)) t(threshold), n JOIN scores ON sha1(n.text) = scores.nb JOIN o ON o.blob = scores.ob
  WHERE score >= t.threshold GROUP BY 1, 2)
SELECT threshold, m[2] AS source, target, (-m[1])::INT AS score, CASE WHEN row_number() OVER (PARTITION BY threshold, m[2] ORDER BY m[1], target) = 1 THEN 'R' ELSE 'C' END AS status FROM best"""


@query(LIKENESS_SQL)
def similar_renames(spark, d) -> DataFrame:
    """All documents moved to another folder, one third as they are, the others cut to four and three fifths: renames at 50, 90 and 100 per cent."""
    text, k = F.coalesce("text", F.lit("")), F.col("doc_id")
    docs = load(spark, d, "documents").select("doc_id", text.alias("text"))
    part = F.when(k % 3 == 1, 4).otherwise(3)
    cut_text = F.when(k % 3 == 0, F.col("text")).otherwise(F.substring("text", F.lit(1), F.floor(F.length("text") * part / 5).cast("int")))
    blob = lambda content: F.unhex(F.sha1(content)).alias("blob")
    old = docs.select(F.concat(F.lit("old/"), k.cast("string")).alias("path"), blob("text"), F.col("text").alias("content"))
    new = docs.select(F.concat(F.lit("new/"), k.cast("string")).alias("path"), blob(cut_text), cut_text.alias("content"))
    contents = old.select("blob", "content").unionByName(new.select("blob", "content"))
    found = similarity.renames_and_copies(old.drop("content"), new.drop("content"), contents, min(THRESHOLDS))
    # a path's source, and a source's best target, are the same at each threshold that their score reaches
    reached = F.filter(F.array(*[F.lit(t) for t in THRESHOLDS]), lambda t: t <= F.col("score"))
    return found.withColumn("threshold", F.explode(reached))


@query(f"{EVEN_ODD} SELECT c, path, l.file_node AS \"left\", r.file_node AS \"right\" FROM l FULL JOIN r USING (c, path) WHERE l.file_node IS DISTINCT FROM r.file_node")
def stored_path_diff(spark, d) -> DataFrame:
    """The difference of :func:`path_diff`, from stored digests of all directories."""
    left, right = (digests.store(side.withColumn("file_node", packed(F.col("file_node"))), ["c"], "file_node") for side in views.sides(spark, d))
    return digests.compare(left, right).select("c", "path", *[unpacked(F.col(c)).alias(c) for c in ("left", "right")])
