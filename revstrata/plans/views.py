"""Version-history views over the driver's tables, in Spark and as DuckDB SQL of the same meaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revstrata.operators import dag
from revstrata.tables import load

DAG_SQL = """
nodes AS (
  SELECT o_orderkey AS rev, sha1(CAST(o_orderkey AS VARCHAR)) AS node, o_orderpriority AS branch, o_orderstatus = 'F' AS closed,
         CASE WHEN o_orderkey > 0 THEN (o_orderkey - 1) // 2 END AS p1,
         CASE WHEN o_orderkey >= 10 AND o_orderkey % 10 = 0 THEN o_orderkey - 3 END AS p2
  FROM orders
), edges AS (
  SELECT DISTINCT rev AS child, p AS parent FROM (SELECT rev, p1 AS p FROM nodes UNION ALL SELECT rev, p2 FROM nodes)
  WHERE p IN (SELECT rev FROM nodes)
)"""

ENTRIES_SQL = """
entries AS (
  SELECT l_orderkey AS commit_id, 'd' || l_linenumber || '/p' || l_partkey AS path, min(sha1(CAST(l_suppkey AS VARCHAR))) AS file_node
  FROM lineitem GROUP BY 1, 2
)"""

EVEN_ODD = f"""WITH {ENTRIES_SQL}, l AS (SELECT commit_id // 2 AS c, path, file_node FROM entries WHERE commit_id % 2 = 0),
  r AS (SELECT commit_id // 2 AS c, path, file_node FROM entries WHERE commit_id % 2 = 1)"""

MAPPING_SQL = "mapping AS (SELECT sha1('h' || c_custkey) AS hg, sha1('g' || c_custkey) AS git, c_custkey FROM customer)"


def nodes(spark: SparkSession, d: str) -> DataFrame:
    """(rev, node, branch, closed, p1, p2) from orders: a binary tree with a second parent for each tenth node."""
    k = F.col("o_orderkey")
    return load(spark, d, "orders").select(
        k.alias("rev"),
        F.sha1(k.cast("string")).alias("node"),
        F.col("o_orderpriority").alias("branch"),
        (F.col("o_orderstatus") == "F").alias("closed"),
        F.when(k > 0, F.expr("(o_orderkey - 1) div 2")).alias("p1"),
        F.when((k >= 10) & (k % 10 == 0), k - 3).alias("p2"),
    )


def graph(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    n = nodes(spark, d)
    return n, dag.edges_of(n)


def entries(spark: SparkSession, d: str) -> DataFrame:
    """(commit_id, path, file_node): manifests from lineitem, one file a path."""
    return (
        load(spark, d, "lineitem")
        .select(
            F.col("l_orderkey").alias("commit_id"),
            F.concat(F.lit("d"), F.col("l_linenumber").cast("string"), F.lit("/p"), F.col("l_partkey").cast("string")).alias("path"),
            F.unhex(F.sha1(F.col("l_suppkey").cast("string"))).alias("file_node"),
        )
        .groupBy("commit_id", "path")
        .agg(F.lower(F.hex(F.min("file_node"))).alias("file_node"))
    )


def sides(spark: SparkSession, d: str, n: int = 2) -> list[DataFrame]:
    """Manifests (c, path, file_node) of ``n`` neighbours each: every n-th commit is a side of its own."""
    e = entries(spark, d)
    return [e.where(f"commit_id % {n} = {k}").select(F.expr(f"commit_id div {n}").alias("c"), "path", "file_node") for k in range(n)]


def mapping(spark: SparkSession, d: str) -> DataFrame:
    c = F.col("c_custkey").cast("string")
    return load(spark, d, "customer").select(F.sha1(F.concat(F.lit("h"), c)).alias("hg"), F.sha1(F.concat(F.lit("g"), c)).alias("git"), "c_custkey")


def tag_lines(spark: SparkSession, d: str) -> DataFrame:
    """(file, tag, line, node) from events: a user's events are a file, an event type a tag."""
    value = F.col("event_id") % 7
    return load(spark, d, "events").select(
        F.col("user_id").alias("file"),
        F.col("event_type").alias("tag"),
        F.col("event_id").alias("line"),
        F.when(F.col("event_type") != "error", F.sha1(value.cast("string"))).alias("node"),
    )


TAGS_SQL = """
lines AS (
  SELECT user_id AS file, event_type AS tag, event_id AS line,
         CASE WHEN event_type <> 'error' THEN sha1(CAST(event_id % 7 AS VARCHAR)) ELSE '' END AS node FROM events
), tags AS (
  SELECT file, tag, arg_max(node, line) AS node,
         list_sort(list_distinct(list(node ORDER BY line)[1 : count(*) - 1])) AS hist FROM lines GROUP BY file, tag
)"""
