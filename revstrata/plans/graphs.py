"""Queries over a merge-rich history: all orders as a chain of diamonds, where every third changeset merges the two before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revstrata.functions import identity
from revstrata.operators import dag, labels
from revstrata.plans import views
from revstrata.plans.catalog import query
from revstrata.tables import load

#: ``r`` is below ``s`` if its diamond is an earlier one, or if it is the top of the same.
BELOW = "({r} = {s} OR {r} // 3 < {s} // 3 OR ({r} % 3 = 0 AND {r} // 3 = {s} // 3))"
TOPS = "(SELECT o_orderkey AS s FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'P')"
OLD = "(SELECT o_orderkey AS s FROM orders WHERE o_orderkey < (SELECT max(o_orderkey) // 2 FROM orders) AND o_orderpriority = '2-HIGH')"


def diamonds(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(rev, p1, p2, status, priority) of the chain, and its edges: 3i has 3i - 2 and 3i - 1 as parents, 3i + 1 and 3i + 2 have 3i."""
    k = F.col("o_orderkey")
    n = load(spark, d, "orders").select(
        k.alias("rev"),
        F.when(k % 3 != 0, k - k % 3).when(k > 0, k - 2).alias("p1"),
        F.when((k % 3 == 0) & (k > 0), k - 1).alias("p2"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
        "o_custkey",
    )
    return n, dag.edges_of(n)


@query("SELECT o_orderkey AS rev, (2 * (o_orderkey // 3) + CASE WHEN o_orderkey % 3 > 0 THEN 1 ELSE 0 END)::INT AS depth FROM orders")
def diamond_generation(spark, d):
    n, e = diamonds(spark, d)
    return dag.generation(n, e)


@query(f"SELECT o_orderkey AS rev FROM orders WHERE EXISTS (SELECT 1 FROM {TOPS} WHERE {BELOW.format(r='o_orderkey', s='s')})")
def diamond_ancestors(spark, d):
    n, e = diamonds(spark, d)
    return dag.ancestors(n, e, n.where("priority = '1-URGENT' AND status = 'P'"))


@query(f"""SELECT o_orderkey AS rev FROM orders WHERE EXISTS (SELECT 1 FROM {TOPS} WHERE {BELOW.format(r='o_orderkey', s='s')})
  AND NOT EXISTS (SELECT 1 FROM {OLD} WHERE {BELOW.format(r='o_orderkey', s='s')})""")
def diamond_range(spark, d):
    n, e = diamonds(spark, d)
    half = n.agg((F.max("rev") / 2).cast("long").alias("half"))
    old = n.where("priority = '2-HIGH'").crossJoin(F.broadcast(half)).where("rev < half")  # one row
    return dag.rev_range(n, e, n.where("priority = '1-URGENT' AND status = 'P'"), old)


@query(f"""SELECT o_orderkey AS rev FROM orders WHERE EXISTS (SELECT 1 FROM {OLD} o WHERE {BELOW.format(r='o.s', s='o_orderkey')})""")
def diamond_descendants(spark, d):
    n, e = diamonds(spark, d)
    half = n.agg((F.max("rev") / 2).cast("long").alias("half"))
    return dag.descendants(n, e, n.where("priority = '2-HIGH'").crossJoin(F.broadcast(half)).where("rev < half"))  # one row


@query(f"""SELECT o_custkey AS a, o_orderkey AS b, {BELOW.format(r='o_custkey', s='o_orderkey')} AND (o_custkey = o_orderkey OR EXISTS (SELECT 1 FROM orders x WHERE x.o_orderkey = o.o_custkey)) AS is_ancestor FROM orders o""")
def diamond_is_ancestor(spark, d):
    """For every order whether its customer's number is an ancestor of it, by the labels of the graph."""
    n, e = diamonds(spark, d)
    return dag.is_ancestor(n, e, n.select(F.col("o_custkey").alias("a"), F.col("rev").alias("b")), labels.index(n, e))


@query(f"""WITH x AS (SELECT o_orderkey AS ref, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_custkey END AS old, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS new FROM orders)
  SELECT ref, old, new, CASE WHEN old IS NULL AND new IS NULL THEN NULL WHEN old IS NULL THEN 'new' WHEN new IS NULL THEN 'gone' WHEN old = new THEN 'same'
    WHEN {BELOW.format(r='old', s='new')} AND old IN (SELECT o_orderkey FROM orders) THEN 'forward' ELSE 'forced' END AS kind FROM x""")
def ref_updates(spark, d):
    """Every order as a reference that moves from its customer's number to its own: forward where that is an ancestor, else forced."""
    n, e = diamonds(spark, d)
    old, new = F.when(F.col("priority") != "1-URGENT", F.col("o_custkey")), F.when(F.col("priority") != "5-LOW", F.col("rev"))
    return dag.fast_forward(n, e, n.select(F.col("rev").alias("ref"), old.alias("old"), new.alias("new")))


@query(f"""WITH k AS (SELECT o_orderkey AS r FROM orders WHERE EXISTS (SELECT 1 FROM {TOPS} WHERE {BELOW.format(r='o_orderkey', s='s')}))
  SELECT r AS rev FROM k WHERE NOT EXISTS (SELECT 1 FROM k x WHERE x.r <> k.r AND {BELOW.format(r='k.r', s='x.r')})""")
def diamond_discovery(spark, d):
    """Heads of what is known of the chain, by questions about 100 nodes a round."""
    n, e = diamonds(spark, d)
    return dag.discover(n, e, dag.ancestors(n, e, n.where("priority = '1-URGENT' AND status = 'P'")), sample=100)


@query(f"""WITH RECURSIVE {views.DAG_SQL}, inside AS (SELECT rev, p1, p2, branch FROM nodes WHERE rev >= 6),
  made(rev, new_node) USING KEY (rev) AS (
    SELECT rev, sha1(CAST(rev AS VARCHAR)) FROM nodes WHERE rev < 6
    UNION SELECT i.rev, sha1(unhex(least(coalesce(a.new_node, repeat('0', 40)), coalesce(b.new_node, repeat('0', 40)))) || unhex(greatest(coalesce(a.new_node, repeat('0', 40)), coalesce(b.new_node, repeat('0', 40)))) || encode(i.branch))
    FROM inside i LEFT JOIN recurring.made a ON a.rev = i.p1 LEFT JOIN recurring.made b ON b.rev = i.p2
    WHERE i.rev NOT IN (SELECT rev FROM recurring.made) AND (i.p1 IS NULL OR a.rev IS NOT NULL) AND (i.p2 IS NULL OR b.rev IS NOT NULL))
  SELECT rev, new_node FROM made WHERE rev >= 6""")
def history_rewrite(spark, d):
    """All changesets from rev 6 on made anew over both their parents, whose identifiers change with them."""
    n = views.nodes(spark, d).select("rev", "node", "p1", "p2", F.col("branch").alias("content"))
    return dag.rewrite(n, n.where("rev >= 6"), identity.node_of)
