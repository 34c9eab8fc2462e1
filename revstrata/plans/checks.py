"""Queries over full checks of stored history."""

from __future__ import annotations

from pyspark.sql import functions as F

from revstrata.functions.identity import node_hash
from revstrata.operators import integrity
from revstrata.plans.catalog import query
from revstrata.tables import load

CHECK_SQL = """
found AS (
  SELECT 'changeset' AS kind, sha1('bad' || s_suppkey) AS id, 'corrupt' AS action FROM supplier WHERE s_suppkey % 11 = 3
  UNION ALL SELECT 'file', sha1('bad' || c_custkey), 'corrupt' FROM customer WHERE c_custkey % 11 = 3
  UNION ALL SELECT 'manifest', sha1('badm' || p_partkey), 'corrupt' FROM part WHERE p_partkey % 13 = 0 AND p_partkey % 17 <> 1
  UNION ALL SELECT 'missing', sha1('badm' || p_partkey), 'corrupt' FROM part WHERE p_partkey % 17 = 1
  UNION ALL SELECT 'head', sha1(n_name), 'drop' FROM nation WHERE n_nationkey % 5 <> 0 AND n_nationkey % 3 = 0
  UNION ALL SELECT 'head', sha1(n_name), 'add' FROM nation WHERE n_nationkey % 5 = 0 AND n_nationkey % 3 <> 0
  UNION ALL SELECT 'dangling', sha1('gone' || s_suppkey), 'drop' FROM supplier WHERE s_suppkey % 7 = 0)"""


def _found(spark, d):
    none = F.lit(None).cast("string")
    mark = lambda word, key: F.sha1(F.concat(F.lit(word), F.col(key).cast("string")))

    def hashed(bad, name, content):
        return F.when(bad, name).otherwise(node_hash(none, none, content)).alias("node")

    s, c, p = (load(spark, d, t) for t in ("supplier", "customer", "part"))
    parents = [none.alias("p1"), none.alias("p2")]
    nodes = s.select(hashed(F.col("s_suppkey") % 11 == 3, mark("bad", "s_suppkey"), F.col("s_name")), *parents, F.col("s_name").alias("content"))
    files = c.select(hashed(F.col("c_custkey") % 11 == 3, mark("bad", "c_custkey"), F.col("c_name")), *parents, F.col("c_name").alias("content"))
    key = F.col("p_partkey")
    line = F.concat(F.lit("p\x00"), mark("", "p_partkey"), F.lit("\n"))
    manifests = p.select(key.alias("manifest"), hashed((key % 13 == 0) | (key % 17 == 1), mark("badm", "p_partkey"), line), *parents)
    entries = p.where(key % 17 != 1).select(key.alias("manifest"), F.lit("p").alias("path"), mark("", "p_partkey").alias("file_node"), F.lit("").alias("attr"))
    mapping = s.where("s_suppkey % 7 = 0").select(mark("gone", "s_suppkey").alias("hg")).unionByName(files.select(F.col("node").alias("hg")))
    heads = load(spark, d, "nation").select(F.sha1("n_name").alias("node"), F.col("n_name").alias("branch"), "n_nationkey")
    return integrity.fsck_full(nodes, manifests, entries, files, mapping, heads.where("n_nationkey % 5 <> 0"), heads.where("n_nationkey % 3 <> 0"))


@query(f"WITH {CHECK_SQL} SELECT * FROM found")
def fsck_full(spark, d):
    """All violations of a repository with what is to be done."""
    return _found(spark, d)


@query(f"WITH {CHECK_SQL} SELECT CASE WHEN count(*) FILTER (action = 'corrupt') > 0 THEN 1 WHEN count(*) > 0 THEN 2 ELSE 0 END AS status FROM found")
def fsck_status(spark, d):
    return integrity.check_status(_found(spark, d))
