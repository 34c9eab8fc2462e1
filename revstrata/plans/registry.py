"""Names of the queries over the version-history operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revstrata.functions import authorship, identity, text
from revstrata.operators import dag, delta, integrity, mapping, paths, refs, snapshots, tags
from revstrata.plans import authoring, checks, exchange, graphs, live, peers, stores, transfers, trees, views  # noqa: F401  these register their queries
from revstrata.plans.catalog import QUERIES, SQL, query
from revstrata.plans.views import DAG_SQL, ENTRIES_SQL, EVEN_ODD, MAPPING_SQL, TAGS_SQL
from revstrata.sources import bundle
from revstrata.tables import load


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)


# Commit graphs ---------------------------------------------------------------------------------


@query(f"WITH {DAG_SQL} SELECT rev, node FROM nodes WHERE rev NOT IN (SELECT parent FROM edges)")
def dag_heads(spark, d):
    n, e = views.graph(spark, d)
    return dag.heads(n, e).select("rev", "node")


@query(f"WITH {DAG_SQL} SELECT rev, node FROM nodes WHERE closed AND rev NOT IN (SELECT child FROM edges WHERE parent IN (SELECT rev FROM nodes WHERE closed))")
def dag_roots(spark, d):
    n, e = views.graph(spark, d)
    return dag.roots(n, e, F.col("closed")).select("rev", "node")


@query(f"""WITH {DAG_SQL} SELECT rev, branch FROM nodes n WHERE NOT EXISTS (
  SELECT 1 FROM edges e JOIN nodes c ON c.rev = e.child WHERE e.parent = n.rev AND c.branch = n.branch)""")
def branch_heads(spark, d):
    n, e = views.graph(spark, d)
    return dag.branch_heads(n.select("rev", "branch"), e)


@query(f"WITH {DAG_SQL} SELECT rev, branch FROM nodes WHERE rev NOT IN (SELECT parent FROM edges)")
def topo_heads(spark, d):
    n, e = views.graph(spark, d)
    return dag.topological_heads(n.select("rev", "branch"), e).select("rev", "branch")


ANC = f"WITH RECURSIVE {DAG_SQL}, a AS (SELECT rev FROM nodes WHERE closed UNION SELECT e.parent FROM a JOIN edges e ON e.child = a.rev)"


@query(f"{ANC} SELECT rev FROM a")
def ancestors(spark, d):
    n, e = views.graph(spark, d)
    return dag.ancestors(n, e, n.where("closed"))


@query(f"WITH RECURSIVE {DAG_SQL}, a AS (SELECT rev FROM nodes WHERE rev IN (20, 57) UNION SELECT e.child FROM a JOIN edges e ON e.parent = a.rev) SELECT rev FROM a")
def descendants(spark, d):
    n, e = views.graph(spark, d)
    return dag.descendants(n, e, n.where(F.col("rev").isin(20, 57)))


RANGE = f"""{ANC}, b AS (SELECT rev FROM nodes WHERE branch = '1-URGENT' UNION SELECT e.parent FROM b JOIN edges e ON e.child = b.rev),
  r AS (SELECT rev FROM a WHERE rev NOT IN (SELECT rev FROM b))"""


@query(f"{RANGE} SELECT rev FROM r")
def rev_range(spark, d):
    n, e = views.graph(spark, d)
    return dag.rev_range(n, e, n.where("closed"), n.where("branch = '1-URGENT'"))


@query(f"{RANGE} SELECT DISTINCT parent AS rev FROM edges WHERE child IN (SELECT rev FROM r) AND parent NOT IN (SELECT rev FROM r)")
def range_boundary(spark, d):
    n, e = views.graph(spark, d)
    return dag.boundary(e, dag.rev_range(n, e, n.where("closed"), n.where("branch = '1-URGENT'")))


@query(f"""WITH RECURSIVE {DAG_SQL}, x AS (SELECT rev FROM nodes WHERE closed UNION SELECT e.parent FROM x JOIN edges e ON e.child = x.rev),
  b AS (SELECT rev FROM nodes WHERE rev = 2 UNION SELECT e.parent FROM b JOIN edges e ON e.child = b.rev),
  c AS (SELECT rev FROM nodes WHERE rev = 2 UNION SELECT e.child FROM c JOIN edges e ON e.parent = c.rev)
  SELECT rev FROM x WHERE rev NOT IN (SELECT rev FROM b) AND rev IN (SELECT rev FROM c)""")
def ancestry_path(spark, d):
    n, e = views.graph(spark, d)
    return dag.ancestry_path(n, e, n.where("closed"), n.where("rev = 2"))


@query(f"""WITH RECURSIVE {DAG_SQL}, w AS (SELECT rev, 0 AS depth FROM nodes WHERE rev NOT IN (SELECT child FROM edges)
  UNION SELECT e.child, w.depth + 1 FROM w JOIN edges e ON e.parent = w.rev) SELECT rev, max(depth)::INT AS depth FROM w GROUP BY rev""")
def generation(spark, d):
    n, e = views.graph(spark, d)
    return dag.generation(n, e)


@query(f"""WITH RECURSIVE {DAG_SQL}, pairs AS (SELECT rev // 9 AS a, rev AS b FROM nodes),
  s AS (SELECT b, b AS rev FROM pairs UNION SELECT s.b, e.parent FROM s JOIN edges e ON e.child = s.rev)
  SELECT a, b, EXISTS (SELECT 1 FROM s WHERE s.b = pairs.b AND s.rev = pairs.a) AS is_ancestor FROM pairs""")
def is_ancestor(spark, d):
    n, e = views.graph(spark, d)
    return dag.is_ancestor(n, e, n.select(F.expr("rev div 9").alias("a"), F.col("rev").alias("b")))


@query(f"{ANC} SELECT rev FROM a WHERE rev IN (SELECT rev FROM nodes WHERE branch = '1-URGENT')")
def reachable_subset(spark, d):
    n, e = views.graph(spark, d)
    return dag.reachable(n, e, n.where("branch = '1-URGENT'").select("rev"), n.where("closed"))


@query(f"""{ANC}, b AS (SELECT rev FROM nodes WHERE branch = '1-URGENT' UNION SELECT e.parent FROM b JOIN edges e ON e.child = b.rev),
  k AS (SELECT rev FROM a WHERE rev IN (SELECT rev FROM b)) SELECT rev FROM k WHERE rev NOT IN (SELECT parent FROM edges WHERE child IN (SELECT rev FROM k))""")
def common_set(spark, d):
    n, e = views.graph(spark, d)
    return dag.common_heads(n, e, n.where("closed"), n.where("branch = '1-URGENT'"))


@query(f"""WITH RECURSIVE {DAG_SQL}, a AS (SELECT rev FROM nodes WHERE rev = 5 UNION SELECT e.child FROM a JOIN edges e ON e.parent = a.rev)
  SELECT rev, branch FROM nodes WHERE rev NOT IN (SELECT rev FROM a)""")
def strip(spark, d):
    n, e = views.graph(spark, d)
    return dag.strip(n, e, n.where("rev = 5")).select("rev", "branch")


# Heads, tips and references --------------------------------------------------------------------

HEADS_SQL = f"""WITH {DAG_SQL}, bh AS (SELECT rev, node, branch, closed FROM nodes n WHERE NOT EXISTS (
  SELECT 1 FROM edges e JOIN nodes c ON c.rev = e.child WHERE e.parent = n.rev AND c.branch = n.branch)),
  tip AS (SELECT * FROM bh QUALIFY row_number() OVER (PARTITION BY branch ORDER BY closed, CASE WHEN closed THEN rev ELSE -rev END) = 1)"""


@query(f"{HEADS_SQL} SELECT branch, rev, node FROM tip")
def tip_per_branch(spark, d):
    n, e = views.graph(spark, d)
    return refs.tips(dag.branch_heads(n.select("rev", "branch"), e).join(n.select("rev", "node", "closed"), "rev")).select("branch", "rev", "node")


@query(f"{HEADS_SQL} SELECT branch, string_agg(node, ' ' ORDER BY rev) AS heads FROM bh GROUP BY branch")
def branch_map(spark, d):
    n, e = views.graph(spark, d)
    return refs.branch_map(dag.branch_heads(n.select("rev", "branch"), e).join(n.select("rev", "node"), "rev"))


@query(f"""{HEADS_SQL}, {MAPPING_SQL}, refs AS (
  SELECT 'refs/heads/branches/' || branch || '/' || node AS ref, node FROM bh UNION ALL SELECT 'refs/heads/branches/' || branch || '/tip', node FROM tip
  UNION ALL SELECT 'refs/heads/bookmarks/' || n_name, sha1(CAST(n_nationkey AS VARCHAR)) FROM nation)
  SELECT ref, coalesce(o.git, '?') AS target FROM refs LEFT JOIN (SELECT sha1(CAST(c_custkey AS VARCHAR)) AS hg, git FROM mapping) o ON o.hg = refs.node""")
def ref_listing(spark, d):
    n, e = views.graph(spark, d)
    marks = load(spark, d, "nation").select(F.col("n_name").alias("name"), F.sha1(F.col("n_nationkey").cast("string")).alias("node"))
    known = views.mapping(spark, d).select(F.sha1(F.col("c_custkey").cast("string")).alias("hg"), "git")
    return refs.listing(n, e, marks, known)


@query("""WITH r AS (SELECT n_name AS name, sha1(n_name) AS oid, n_nationkey AS k FROM nation)
  SELECT name, CASE WHEN k % 3 = 0 THEN sha1('new' || name) ELSE oid END AS oid FROM r WHERE k % 3 <> 1""")
def ref_transaction(spark, d):
    nation = load(spark, d, "nation").select(F.col("n_name").alias("name"), F.sha1("n_name").alias("oid"), (F.col("n_nationkey") % 3).alias("k"))
    updates = nation.where("k < 2").select("name", F.col("oid").alias("old"), F.when(F.col("k") == 0, F.sha1(F.concat(F.lit("new"), "name"))).alias("new"))
    return refs.compare_and_set(nation.select("name", "oid"), updates)


# Paths and manifests ---------------------------------------------------------------------------

@query(f"{EVEN_ODD} SELECT c, path, l.file_node AS \"left\", r.file_node AS \"right\" FROM l FULL JOIN r USING (c, path)")
def path_merge_join(spark, d):
    left, right = views.sides(spark, d)
    return paths.merge_join(left, right, ["c", "path"], "file_node")


@query(f"{EVEN_ODD} SELECT c, path, l.file_node AS \"left\", r.file_node AS \"right\" FROM l FULL JOIN r USING (c, path) WHERE l.file_node IS DISTINCT FROM r.file_node")
def path_diff(spark, d):
    left, right = views.sides(spark, d)
    return paths.diff_by_directory(left, right, ["c", "path"], "path", "file_node")


THREE = f"""WITH {ENTRIES_SQL}, m AS (SELECT l_suppkey, 'd' || l_linenumber AS path, min(sha1(CAST(l_partkey AS VARCHAR))) AS f FROM lineitem WHERE l_orderkey % 3 = 0 GROUP BY 1, 2),
  x AS (SELECT l_suppkey, 'd' || l_linenumber AS path, min(sha1(CAST(l_partkey AS VARCHAR))) AS f FROM lineitem WHERE l_orderkey % 3 = 1 GROUP BY 1, 2),
  y AS (SELECT l_suppkey, 'd' || l_linenumber AS path, min(sha1(CAST(l_partkey AS VARCHAR))) AS f FROM lineitem WHERE l_orderkey % 3 = 2 GROUP BY 1, 2),
  a AS (SELECT l_suppkey, path, m.f AS n, x.f AS o FROM m FULL JOIN x USING (l_suppkey, path) WHERE m.f IS DISTINCT FROM x.f),
  b AS (SELECT l_suppkey, path, m.f AS n, y.f AS o FROM m FULL JOIN y USING (l_suppkey, path) WHERE m.f IS DISTINCT FROM y.f)"""


@query(f"{THREE} SELECT l_suppkey, path, a.n AS new, a.o AS first, b.o AS second FROM a JOIN b USING (l_suppkey, path)")
def manifest_diff3(spark, d):
    rows = load(spark, d, "lineitem").select("l_orderkey", "l_suppkey", F.concat(F.lit("d"), F.col("l_linenumber").cast("string")).alias("path"), F.sha1(F.col("l_partkey").cast("string")).alias("f"))
    m, x, y = (rows.where(f"l_orderkey % 3 = {k}").groupBy("l_suppkey", "path").agg(F.min("f").alias("f")) for k in range(3))
    return paths.three_way(m, x, y, ["l_suppkey", "path"], "f")


@query(f"{EVEN_ODD}, ch AS (SELECT c, path, CASE WHEN substr(file_node, 1, 1) >= '8' THEN file_node END AS file_node FROM r) SELECT * FROM l ANTI JOIN ch USING (c, path) UNION ALL SELECT * FROM ch WHERE file_node IS NOT NULL")
def manifest_rebuild(spark, d):
    left, right = views.sides(spark, d)
    changes = right.withColumn("file_node", F.when(F.substring("file_node", 1, 1) >= "8", F.col("file_node")))
    return paths.rebuild(left, changes, ["c", "path"], "file_node")


@query(f"""WITH {ENTRIES_SQL}, o AS (SELECT path, min(file_node) AS f FROM entries WHERE commit_id % 2 = 0 GROUP BY path), n AS (SELECT path, min(file_node) AS f FROM entries WHERE commit_id % 2 = 1 GROUP BY path),
  gone AS (SELECT f, min(path) AS source FROM o WHERE path NOT IN (SELECT path FROM n) GROUP BY f), came AS (SELECT f, path AS target FROM n WHERE path NOT IN (SELECT path FROM o))
  SELECT f AS file_node, source, target FROM gone JOIN came USING (f)""")
def exact_renames(spark, d):
    left, right = (s.groupBy("path").agg(F.min("file_node").alias("file_node")) for s in views.sides(spark, d))
    return paths.renames(left, right, "path", "file_node")


@query(f"WITH {ENTRIES_SQL} SELECT commit_id AS manifest, sha1(string_agg(path || chr(0) || file_node || chr(10), '' ORDER BY path)) AS digest FROM entries GROUP BY commit_id")
def manifest_text(spark, d):
    e = views.entries(spark, d).select(F.col("commit_id").alias("manifest"), "path", "file_node", F.lit("").alias("attr"))
    return integrity.manifest_contents(e).select("manifest", F.sha1("content").alias("digest"))


# Identifier maps -------------------------------------------------------------------------------


@query(f"WITH {MAPPING_SQL} SELECT o_orderkey, m.git FROM orders LEFT JOIN mapping m ON m.hg = sha1('h' || (o_custkey * 2))")
def hg2git_lookup(spark, d):
    w = load(spark, d, "orders").select("o_orderkey", F.sha1(F.concat(F.lit("h"), (F.col("o_custkey") * 2).cast("string"))).alias("hg"))
    return mapping.lookup(w, views.mapping(spark, d), "hg", "git").select("o_orderkey", "git")


@query(f"WITH {MAPPING_SQL} SELECT o_orderkey, substr(coalesce(m.hg, repeat('0', 40)), 1, 12) AS hg FROM orders LEFT JOIN mapping m ON m.git = sha1('g' || (o_custkey * 2))")
def git2hg_lookup(spark, d):
    w = load(spark, d, "orders").select("o_orderkey", F.sha1(F.concat(F.lit("g"), (F.col("o_custkey") * 2).cast("string"))).alias("git"))
    return mapping.convert(w, views.mapping(spark, d), "git", "hg", 12).select("o_orderkey", "hg")


@query(f"""WITH {MAPPING_SQL}, p AS (SELECT upper(substr(sha1('h' || c_custkey), 1, (2 + c_custkey % 4)::INT)) AS prefix, c_custkey FROM customer)
  SELECT p.c_custkey, CASE WHEN count(m.hg) = 1 THEN min(m.hg) END AS hg, CASE WHEN count(m.hg) = 1 THEN min(m.git) END AS git
  FROM p LEFT JOIN mapping m ON starts_with(m.hg, lower(p.prefix)) GROUP BY p.c_custkey""")
def abbrev_lookup(spark, d):
    m = views.mapping(spark, d)
    p = m.select(F.upper(F.substring(F.col("hg"), F.lit(1), (2 + F.col("c_custkey") % 4).cast("int"))).alias("prefix"), "c_custkey")
    return mapping.resolve_abbreviations(p, m.select("hg", "git"), "prefix", "hg", "git").select("c_custkey", "hg", "git")


@query(f"""WITH {MAPPING_SQL}, k AS (SELECT hg, lag(hg) OVER (ORDER BY hg) AS a, lead(hg) OVER (ORDER BY hg) AS b FROM mapping)
  SELECT hg, greatest(4, 1 + greatest(coalesce(list_count(list_transform(range(1, 41), lambda i: CASE WHEN substr(hg, 1, i) = substr(a, 1, i) THEN 1 END)), 0),
    coalesce(list_count(list_transform(range(1, 41), lambda i: CASE WHEN substr(hg, 1, i) = substr(b, 1, i) THEN 1 END)), 0)))::INT AS length FROM k""")
def unique_abbrev(spark, d):
    return mapping.shortest_abbreviations(views.mapping(spark, d), "hg")


@query("""WITH b AS (SELECT c_custkey AS k, c_name AS v FROM customer WHERE c_custkey % 3 <> 0), n AS (SELECT c_custkey AS k, 'new' || c_name AS v FROM customer WHERE c_custkey % 2 = 0)
  SELECT * FROM b UNION ALL SELECT * FROM n WHERE k NOT IN (SELECT k FROM b)""")
def put_if_absent(spark, d):
    c = load(spark, d, "customer")
    base = c.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v"))
    return mapping.put_if_absent(base, c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.concat(F.lit("new"), "c_name").alias("v")), "k")


@query("""SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'new' || c_name ELSE c_name END AS v FROM customer
  WHERE (c_custkey % 2 = 0 AND c_custkey % 4 <> 0) OR (c_custkey % 2 = 1 AND c_custkey % 3 <> 0)""")
def overlay_get(spark, d):
    c = load(spark, d, "customer")
    base = c.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v"))
    changes = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 4 != 0, F.concat(F.lit("new"), "c_name")).alias("v"))
    return mapping.overlay(base, changes, "k", "v")


@query(f"WITH {MAPPING_SQL} SELECT hg FROM mapping WHERE hg NOT IN (SELECT sha1('h' || o_custkey) FROM orders WHERE o_orderpriority = '1-URGENT') AND hg NOT IN (SELECT sha1('h' || s_suppkey) FROM supplier)")
def dangling_keys(spark, d):
    o = load(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select(F.sha1(F.concat(F.lit("h"), F.col("o_custkey").cast("string"))).alias("hg"))
    s = load(spark, d, "supplier").select(F.sha1(F.concat(F.lit("h"), F.col("s_suppkey").cast("string"))).alias("hg"))
    return mapping.dangling(views.mapping(spark, d), [o, s], "hg")


# Tags ------------------------------------------------------------------------------------------


@query(f"WITH {TAGS_SQL} SELECT file, tag, node, array_to_string(hist, ' ') AS hist FROM tags")
def tags_in_file(spark, d):
    return tags.tags_in_file(views.tag_lines(spark, d)).withColumn("hist", F.array_join("hist", " "))


@query(f"""WITH RECURSIVE {TAGS_SQL}, ranked AS (SELECT *, row_number() OVER (PARTITION BY tag ORDER BY file) AS r FROM tags),
  fold AS (SELECT tag, r, node, hist FROM ranked WHERE r = 1
    UNION ALL SELECT f.tag, n.r, CASE WHEN n.node <> f.node AND list_contains(f.hist, n.node) AND (NOT list_contains(n.hist, f.node) OR len(f.hist) > len(n.hist)) THEN f.node ELSE n.node END,
      list_sort(list_distinct(list_concat(f.hist, n.hist))) FROM fold f JOIN ranked n ON n.tag = f.tag AND n.r = f.r + 1)
  SELECT tag, node, array_to_string(hist, ' ') AS hist FROM fold QUALIFY row_number() OVER (PARTITION BY tag ORDER BY r DESC) = 1""")
def tags_merged(spark, d):
    per_file = tags.tags_in_file(views.tag_lines(spark, d)).withColumn("rank", F.col("file"))
    return tags.merged(per_file).withColumn("hist", F.array_join("hist", " "))


# Functions -------------------------------------------------------------------------------------


@query("SELECT doc_id, sha1(encode('blob ' || octet_length(encode(text)) || chr(0) || text)) AS oid FROM documents")
def blob_ids(spark, d):
    return load(spark, d, "documents").select("doc_id", identity.object_id(F.lit("blob"), F.col("text")).alias("oid"))


@query("""WITH p AS (SELECT o_orderkey AS rev, sha1('a' || o_custkey) AS p1, CASE WHEN o_orderkey % 2 = 0 THEN sha1('b' || o_orderkey) ELSE repeat('0', 40) END AS p2, o_orderpriority AS c FROM orders)
  SELECT rev, sha1(unhex(least(p1, p2)) || unhex(greatest(p1, p2)) || encode(c)) AS node FROM p""")
def node_hash(spark, d):
    k = F.col("o_orderkey")
    p1 = F.sha1(F.concat(F.lit("a"), F.col("o_custkey").cast("string")))
    p2 = F.when(k % 2 == 0, F.sha1(F.concat(F.lit("b"), k.cast("string"))))
    return load(spark, d, "orders").select(k.alias("rev"), identity.node_hash(p1, p2, F.col("o_orderpriority")).alias("node"))


@query("""WITH a AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_name || ' <' || c_custkey || '@x.org>' WHEN 1 THEN c_custkey || '@x.org' WHEN 2 THEN c_name ELSE '<' || c_name || '@y>' END AS s FROM customer)
  SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN regexp_extract(s, '^(.*) <', 1) WHEN 2 THEN s ELSE '' END AS name,
         CASE c_custkey % 4 WHEN 1 THEN s WHEN 2 THEN '' ELSE regexp_extract(s, '<(.*)>', 1) END AS email FROM a""")
def author_split(spark, d):
    k = F.col("c_custkey")
    at = F.concat(k.cast("string"), F.lit("@x.org"))
    s = (
        F.when(k % 4 == 0, F.concat("c_name", F.lit(" <"), at, F.lit(">")))
        .when(k % 4 == 1, at)
        .when(k % 4 == 2, F.col("c_name"))
        .otherwise(F.concat(F.lit("<"), "c_name", F.lit("@y>")))
    )
    return load(spark, d, "customer").select(k, authorship.name_and_email(s).alias("a")).select("c_custkey", "a.name", "a.email")


@query("""SELECT o_orderkey, w AS west, printf('%s%02d%02d', CASE WHEN w > 0 THEN '-' ELSE '+' END, abs(w) // 3600, abs(w) // 60 % 60) AS hhmm
  FROM (SELECT o_orderkey, ((o_orderkey % 53 - 26) * 1800)::INT AS w FROM orders)""")
def utc_offsets(spark, d):
    west = ((F.col("o_orderkey") % 53 - 26) * 1800).cast("int")
    rows = load(spark, d, "orders").select("o_orderkey", authorship.east_hhmm(west).alias("hhmm"))
    return rows.select("o_orderkey", authorship.west_seconds(F.col("hhmm")).cast("int").alias("west"), "hhmm")


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'default' ELSE o_orderpriority END AS branch, o_orderkey % 5 = 0 AS closed,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'branch:' || o_orderpriority || chr(0) END || CASE WHEN o_orderkey % 5 = 0 THEN 'close:1' || chr(0) ELSE '' END || 'source:' || o_custkey AS extra FROM orders""")
def extra_parse(spark, d):
    k = F.col("o_orderkey")
    raw = F.concat(
        F.lit("source:"),
        F.col("o_custkey").cast("string"),
        F.when(k % 5 == 0, F.lit("\x00close:1")).otherwise(""),
        F.when(k % 3 != 0, F.concat(F.lit("\x00branch:"), "o_orderpriority")).otherwise(""),
    )
    rows = load(spark, d, "orders").select("o_orderkey", text.extra_map(raw).alias("m"))
    return rows.select("o_orderkey", text.branch_of(F.col("m")).alias("branch"), text.is_closed(F.col("m")).alias("closed"), text.extra_text(F.col("m")).alias("extra"))


@query("SELECT page_id, regexp_replace(p, '(^|/)', '\\1_', 'g') AS tree_path, p AS path FROM (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS p FROM pages)")
def path_encoding(spark, d):
    rows = load(spark, d, "pages").select("page_id", F.regexp_replace("url", "^[a-z]+://", "").alias("p"))
    coded = rows.select("page_id", text.tree_path(F.col("p")).alias("tree_path"))
    return coded.withColumn("path", text.manifest_path(F.col("tree_path")))


@query("SELECT page_id, replace(replace(replace(replace(url, ':', ':c'), ',', ':o'), ';', ':s'), '=', ':e') AS escaped, url AS plain, url AS decoded FROM pages")
def wire_escapes(spark, d):
    rows = load(spark, d, "pages").select("page_id", text.batch_escape(F.col("url")).alias("escaped"), text.percent_encode(F.col("url")).alias("_p"))
    return rows.select("page_id", "escaped", text.batch_unescape(F.col("escaped")).alias("plain"), text.percent_decode(F.col("_p")).alias("decoded"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 1 THEN 'x' WHEN p_size % 3 = 2 THEN 'l' ELSE '' END AS attr, CASE p_size % 3 WHEN 1 THEN 33261 WHEN 2 THEN 40960 ELSE 33188 END AS mode FROM part""")
def file_modes(spark, d):
    attr = F.when(F.col("p_size") % 3 == 1, "x").when(F.col("p_size") % 3 == 2, "l").otherwise("")
    rows = load(spark, d, "part").select("p_partkey", text.attr_mode(attr).cast("int").alias("mode"))
    return rows.select("p_partkey", text.mode_attr(F.col("mode")).alias("attr"), "mode")


# Deltas and order-dependent choices ------------------------------------------------------------


@query("SELECT conv_id, turn, coalesce(lag(sha1(text)) OVER (PARTITION BY conv_id ORDER BY turn), sha1(role)) AS base FROM conversations")
def delta_base(spark, d):
    c = load(spark, d, "conversations").select("conv_id", "turn", F.sha1("text").alias("node"), F.sha1("role").alias("p1"))
    return delta.implicit_bases(c, "conv_id", "turn", "node", "p1").select("conv_id", "turn", "base")


@query("SELECT l_orderkey, arg_min(l_partkey, l_quantity * 1000000000 + l_partkey) AS base FROM lineitem GROUP BY l_orderkey")
def smallest_delta(spark, d):
    rows = load(spark, d, "lineitem").select("l_orderkey", "l_quantity", F.col("l_partkey").alias("order"), F.col("l_partkey").alias("base"))
    return delta.smallest(rows, "l_orderkey", "l_quantity", "order", "base")


@query("SELECT user_id, event_type, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1")
def first_occurrence(spark, d):
    return delta.first_occurrence(load(spark, d, "events").select("user_id", "event_type", "event_id"), ["user_id", "event_type"], ["event_id"])


PAIRS = "SELECT conv_id, turn, text, coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '') AS old FROM conversations"


@query(f"SELECT conv_id, turn, sha1(coalesce(text, '')) AS restored FROM ({PAIRS})")
def delta_round_trip(spark, d):
    rows = load(spark, d, "conversations").selectExpr("conv_id", "turn", "cast(text as binary) as new").withColumn(
        "old", F.expr("lag(new) over (partition by conv_id order by turn)")
    )
    made = rows.withColumn("delta", delta.delta(F.col("old"), F.col("new")))
    return made.select("conv_id", "turn", F.sha1(delta.patched(F.col("old"), F.col("delta"))).alias("restored"))


@query("SELECT conv_id, turn, sha1(coalesce(text, '')) AS restored FROM conversations")
def delta_chains(spark, d):
    rows = load(spark, d, "conversations").selectExpr("conv_id as chain", "turn as seq", "cast(text as binary) as new").withColumn(
        "old", F.expr("lag(new) over (partition by chain order by seq)")
    )
    made = rows.select("chain", "seq", delta.delta(F.col("old"), F.col("new")).alias("delta"))
    return delta.replay_chains(made).select(F.col("chain").alias("conv_id"), F.col("seq").alias("turn"), F.sha1("content").alias("restored"))


# Snapshots and checks --------------------------------------------------------------------------


@query("SELECT sha1(CAST(o_orderkey AS VARCHAR)) AS snapshot_id, ((SELECT max(o_orderkey) FROM orders) - o_orderkey)::INT AS step FROM orders")
def snapshot_walk(spark, d):
    o = load(spark, d, "orders").select("o_orderkey")
    last = o.agg(F.max("o_orderkey").alias("o_orderkey"))
    of = lambda k: F.sha1(k.cast("string"))
    chain = o.select(of(F.col("o_orderkey")).alias("snapshot_id"), F.when(F.col("o_orderkey") > 0, of(F.col("o_orderkey") - 1)).alias("prev_id"))
    return snapshots.walk(chain, last.select(of(F.col("o_orderkey")).alias("snapshot_id")))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 7 = 3")
def hash_violations(spark, d):
    k = F.col("o_orderkey")
    none = F.lit(None).cast("string")
    rows = load(spark, d, "orders").select(k, none.alias("p1"), none.alias("p2"), F.col("o_orderpriority").alias("content"))
    stored = rows.withColumn("node", identity.node_hash(F.col("p1"), F.col("p2"), F.when(k % 7 == 3, F.lit("changed")).otherwise(F.col("content"))))
    return integrity.changed_content(stored).select("o_orderkey")


@query(f"WITH {DAG_SQL} SELECT rev, p AS parent FROM (SELECT rev, p1 AS p FROM nodes WHERE rev % 11 <> 4 UNION SELECT rev, p2 FROM nodes WHERE rev % 11 <> 4) WHERE p % 11 = 4")
def missing_parents(spark, d):
    return integrity.missing_parents(views.nodes(spark, d).where("rev % 11 <> 4"))


# Bundles ---------------------------------------------------------------------------------------


@query("SELECT conv_id, turn, sha1(coalesce(text, '')) AS content FROM conversations")
def bundle_round_trip(spark, d):
    """Conversations written as revision chunks of bundle parts (one a conversation), and read again."""
    rows = load(spark, d, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).cast("binary").alias("content"))
    back = bundle.decode(bundle.encode(rows, "conv_id", "turn", "content"))
    return back.select("conv_id", F.col("seq").alias("turn"), F.sha1("content").alias("content"))
