"""Queries over objects, stores, revision lists and the texts of settings, addresses and authors."""

from __future__ import annotations

from pyspark.sql import functions as F

from revstrata.functions import authorship, identity, text
from revstrata.operators import changesets, dag, history, integrity, objects, refs, snapshots, store, tags
from revstrata.plans import views
from revstrata.plans.catalog import query
from revstrata.plans.views import DAG_SQL, ENTRIES_SQL, MAPPING_SQL
from revstrata.tables import load

UP = """a AS (SELECT rev FROM nodes WHERE closed UNION SELECT e.parent FROM a JOIN edges e ON e.child = a.rev),
  b AS (SELECT rev FROM nodes WHERE branch = '1-URGENT' UNION SELECT e.parent FROM b JOIN edges e ON e.child = b.rev)"""
DEPTHS = """w AS (SELECT rev, 0 AS depth FROM nodes WHERE rev NOT IN (SELECT child FROM edges)
    UNION SELECT e.child, w.depth + 1 FROM w JOIN edges e ON e.parent = w.rev), depths AS (SELECT rev, max(depth) AS depth FROM w GROUP BY rev)"""
text_of = lambda c: F.col(c).cast("string")

# Revision lists and heads ----------------------------------------------------------------------


@query("SELECT o_orderkey AS rev FROM orders WHERE o_orderkey <= (SELECT max(o_orderkey) - 5 FROM orders)")
def linear_ancestors(spark, d):
    """Ancestors on one line through all orders."""
    k = F.col("o_orderkey")
    n = load(spark, d, "orders").select(k.alias("rev"), F.when(k > 0, k - 1).alias("p1"), F.lit(None).cast("long").alias("p2"))
    return dag.ancestors(n, dag.edges_of(n), n.agg((F.max("rev") - 5).alias("rev")))


@query("SELECT o_orderkey AS rev, o_orderkey::INT AS depth FROM orders")
def linear_generation(spark, d):
    k = F.col("o_orderkey")
    n = load(spark, d, "orders").select(k.alias("rev"), F.when(k > 0, k - 1).alias("p1"), F.lit(None).cast("long").alias("p2"))
    return dag.generation(n, dag.edges_of(n))


@query(f"WITH RECURSIVE {DAG_SQL}, {UP} (SELECT rev FROM a EXCEPT SELECT rev FROM b) UNION ALL (SELECT rev FROM b EXCEPT SELECT rev FROM a)")
def symmetric_range(spark, d):
    n, e = views.graph(spark, d)
    return history.symmetric_difference(n, e, n.where("closed"), n.where("branch = '1-URGENT'"))


@query(f"""WITH RECURSIVE {DAG_SQL}, {UP}, {DEPTHS}, r AS (SELECT rev FROM a EXCEPT SELECT rev FROM b),
  o AS (SELECT DISTINCT parent AS rev FROM edges WHERE child IN (SELECT rev FROM r) AND parent NOT IN (SELECT rev FROM r)),
  l AS (SELECT rev, 'in' AS kind FROM r UNION ALL SELECT rev, 'boundary' FROM o)
  SELECT rev, kind, row_number() OVER (ORDER BY kind = 'boundary', depth DESC, rev DESC) - 1 AS place FROM l JOIN depths USING (rev)""")
def rev_list(spark, d):
    n, e = views.graph(spark, d)
    return history.rev_list(n, e, n.where("closed"), n.where("branch = '1-URGENT'"), boundary=True)


@query(f"""WITH RECURSIVE {DAG_SQL}, {UP}, {DEPTHS}, f AS (SELECT rev, row_number() OVER (ORDER BY depth DESC, rev DESC) AS k FROM a JOIN depths USING (rev) WHERE rev NOT IN (SELECT p.parent FROM edges p WHERE p.child = 9))
  SELECT rev, 'in' AS kind, least(100, (SELECT count(*) FROM f)) - k AS place FROM f WHERE k <= 100
    AND rev NOT IN (SELECT rev FROM (WITH RECURSIVE z AS (SELECT parent AS rev FROM edges WHERE child = 9 UNION SELECT e.parent FROM z JOIN edges e ON e.child = z.rev) SELECT rev FROM z))""")
def rev_list_last(spark, d):
    """The last hundred of a range in reverse, without what comes before rev 9."""
    n, e = views.graph(spark, d)
    return history.rev_list(n, e, n.where("closed"), history.below(e, n.where("rev = 9")), reverse=True, max_count=100)


@query(f"""WITH {DAG_SQL} SELECT rev, branch FROM nodes n WHERE branch IN ('1-URGENT', '5-LOW') AND NOT EXISTS (
  SELECT 1 FROM edges e JOIN nodes c ON c.rev = e.child WHERE e.parent = n.rev AND c.branch = n.branch)""")
def heads_in_branches(spark, d):
    n, e = views.graph(spark, d)
    return history.in_branches(dag.branch_heads(n.select("rev", "branch"), e), spark.createDataFrame([("1-URGENT",), ("5-LOW",)], "branch string"))


@query("""WITH x AS (SELECT o_custkey AS node, 0 AS side, o_orderkey AS place FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_custkey, 1, o_orderkey FROM orders WHERE o_orderstatus <> 'F')
  SELECT node, side, place FROM x QUALIFY row_number() OVER (PARTITION BY node ORDER BY side, place) = 1""")
def united_heads(spark, d):
    o = load(spark, d, "orders").select(F.col("o_custkey").alias("node"), F.col("o_orderkey").alias("place"), "o_orderstatus")
    return history.united_heads(*(x.select("node", "place") for x in history.partitioned(o, F.col("o_orderstatus") == "F")))


@query(f"""WITH {DAG_SQL}, h AS (SELECT rev AS node FROM nodes WHERE rev < 500 AND rev NOT IN (SELECT parent FROM edges WHERE child < 500)), new AS (SELECT rev AS node FROM nodes WHERE rev >= 500)
  SELECT node FROM (SELECT node FROM h UNION SELECT node FROM new) WHERE node NOT IN (SELECT parent FROM edges WHERE child >= 500)""")
def manifest_heads(spark, d):
    n, e = views.graph(spark, d)
    held = dag.heads(n.where("rev < 500").select("rev"), e.where("child < 500")).select(F.col("rev").alias("node"))
    new = n.where("rev >= 500").select(F.col("rev").alias("node"), F.array_compact(F.array("p1", "p2")).alias("parents"))
    return history.with_new_heads(held, new)


@query("SELECT event_id, lag(event_type) OVER (ORDER BY ts, event_id) AS previous FROM events")
def previous_manifest(spark, d):
    return history.previous_in_order(load(spark, d, "events").select("event_id", "ts", "event_type"), ["ts", "event_id"], "event_type").select("event_id", "previous")


@query(f"""WITH RECURSIVE {DAG_SQL}, {DEPTHS} SELECT branch AS manifest, max(depth)::INT AS depth FROM nodes JOIN depths USING (rev) GROUP BY branch""")
def manifest_depths(spark, d):
    n, e = views.graph(spark, d)
    return history.depth_of_manifests(n.select("rev", F.col("branch").alias("manifest")), e)


@query("""WITH r AS (SELECT l_suppkey AS path, l_orderkey AS node, lag(l_orderkey) OVER (PARTITION BY l_suppkey ORDER BY l_orderkey) AS p1 FROM (SELECT DISTINCT l_suppkey, l_orderkey FROM lineitem) WHERE l_orderkey % 5 <> 0)
  SELECT path, max(node) AS node FROM r GROUP BY path""")
def file_heads(spark, d):
    rows = load(spark, d, "lineitem").where("l_orderkey % 5 <> 0").select(F.col("l_suppkey").alias("path"), F.col("l_orderkey").alias("node")).distinct()
    chained = rows.selectExpr("path", "node", "lag(node) over (partition by path order by node) as p1", "cast(null as long) as p2")
    return history.heads_of_files(chained)


@query("SELECT n_name AS name, sha1(n_name) AS node FROM nation WHERE n_regionkey < 3")
def wanted_refs(spark, d):
    n = load(spark, d, "nation")
    return history.wanted_refs(n.where("n_regionkey < 3").select(F.col("n_name").alias("name")), n.select(F.col("n_name").alias("name"), F.sha1("n_name").alias("node")))


@query(f"WITH {MAPPING_SQL} SELECT o_orderkey AS tag, git FROM orders JOIN mapping ON hg = sha1('h' || (o_custkey * 2))")
def mapped_tags(spark, d):
    t = load(spark, d, "orders").select(F.col("o_orderkey").alias("tag"), F.sha1(F.concat(F.lit("h"), (F.col("o_custkey") * 2).cast("string"))).alias("node"))
    return history.mapped_tags(t, views.mapping(spark, d))


@query(f"SELECT DISTINCT sha1(CAST(l_suppkey AS VARCHAR)) AS node FROM lineitem WHERE l_suppkey % 3 <> 0 AND l_suppkey % 7 <> 0")
def files_of_interest(spark, d):
    k = F.col("l_suppkey")
    rows = load(spark, d, "lineitem").select(F.when(k % 7 == 0, F.lit(objects.EMPTY_FILE)).when(k % 3 != 0, F.sha1(k.cast("string"))).alias("node"))
    return history.files_of_interest(rows)


@query("""WITH u AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN c_name END AS ref, CASE WHEN c_custkey % 3 = 1 THEN '/w/' || c_name END AS worktree FROM customer WHERE c_custkey % 3 <> 2
    UNION ALL SELECT -1, NULL, NULL)
  SELECT k, row_number() OVER (ORDER BY CASE WHEN ref IS NOT NULL THEN 0 WHEN worktree IS NOT NULL THEN 1 ELSE 2 END, coalesce(ref, worktree)) - 1 AS place FROM u""")
def update_order(spark, d):
    k = F.col("c_custkey")
    none = F.lit(None).cast("string")
    rows = load(spark, d, "customer").where("c_custkey % 3 <> 2").select(k.alias("k"), F.when(k % 3 == 0, F.col("c_name")).alias("ref"), F.when(k % 3 == 1, F.concat(F.lit("/w/"), "c_name")).alias("worktree"))
    return history.update_order(rows.unionByName(spark.range(1).select(F.lit(-1).cast("long").alias("k"), none.alias("ref"), none.alias("worktree")))).select("k", "place")


@query("SELECT n_nationkey + 1 AS n, 'bundle' || CASE WHEN n_nationkey = 0 THEN '' ELSE CAST(n_nationkey + 1 AS VARCHAR) END AS name, row_number() OVER (ORDER BY CAST(n_nationkey + 1 AS VARCHAR)) - 1 AS place FROM nation")
def bundle_names(spark, d):
    return history.bundle_names(load(spark, d, "nation").select((F.col("n_nationkey") + 1).alias("n")))


# Manifests and changes -------------------------------------------------------------------------

TREES_SQL = f"""{ENTRIES_SQL}, t AS MATERIALIZED (SELECT commit_id AS commit, regexp_extract(path, '^[^/]*') AS path, min(file_node) AS file_node FROM entries GROUP BY 1, 2),
  c AS MATERIALIZED (SELECT o_orderkey AS commit, CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey // 4 END AS p1, CASE WHEN o_orderkey % 4 > 1 THEN o_orderkey // 3 END AS p2 FROM orders)"""


@query(f"""WITH {TREES_SQL},
  one AS (SELECT coalesce(x.commit, y.commit) AS commit, coalesce(x.path, y.path) AS path, x.file_node, y.file_node AS f1 FROM
    (SELECT t.* FROM t JOIN c USING (commit) WHERE p1 IS NOT NULL) x FULL JOIN (SELECT c.commit, t.path, t.file_node FROM c JOIN t ON t.commit = c.p1) y USING (commit, path) WHERE x.file_node IS DISTINCT FROM y.file_node),
  two AS (SELECT coalesce(x.commit, y.commit) AS commit, coalesce(x.path, y.path) AS path, x.file_node, y.file_node AS f2 FROM
    (SELECT t.* FROM t JOIN c USING (commit) WHERE p2 IS NOT NULL) x FULL JOIN (SELECT c.commit, t.path, t.file_node FROM c JOIN t ON t.commit = c.p2) y USING (commit, path) WHERE x.file_node IS DISTINCT FROM y.file_node)
  SELECT commit, path, file_node, '' AS parents FROM t JOIN c USING (commit) WHERE p1 IS NULL
  UNION ALL SELECT commit, path, file_node, coalesce(f1, '-') FROM one JOIN c USING (commit) WHERE p2 IS NULL
  UNION ALL SELECT one.commit, one.path, one.file_node, coalesce(f1, '-') || ' ' || coalesce(f2, '-') FROM one JOIN two USING (commit, path)""")
def commit_changes(spark, d):
    k = F.col("o_orderkey")
    trees = views.entries(spark, d).groupBy(F.col("commit_id").alias("commit"), F.regexp_extract("path", "^([^/]*)", 1).alias("path")).agg(F.min(F.unhex("file_node")).alias("file_node"))
    commits = load(spark, d, "orders").select(k.alias("commit"), F.when(k % 4 > 0, F.expr("o_orderkey div 4")).alias("p1"), F.when(k % 4 > 1, F.expr("o_orderkey div 3")).alias("p2"))
    digits = lambda p: F.lower(F.hex(p))
    return history.changes_of(trees, commits).withColumns({"file_node": digits(F.col("file_node")), "parents": F.array_join(F.transform("parents", lambda p: F.coalesce(digits(p), F.lit("-"))), " ")})


NULLS = "unhex(repeat('0', 40))"


@query(f"""WITH p AS (SELECT l_orderkey AS k, 'f' || l_linenumber AS path, min(sha1(CAST(l_partkey AS VARCHAR))) AS file_node, 'x' AS attr FROM lineitem GROUP BY 1, 2)
  SELECT k, path, CASE path WHEN 'f2' THEN sha1({NULLS} || unhex(file_node) || encode('new ' || k)) WHEN 'f3' THEN file_node ELSE file_node END AS file_node,
    CASE path WHEN 'f3' THEN 'l' WHEN 'f2' THEN '' ELSE attr END AS attr, path IN ('f2', 'f3') AS listed FROM p WHERE path NOT IN ('f1', 'f4')
  UNION ALL SELECT k, 'f1', NULL, NULL, true FROM p WHERE path = 'f1'
  UNION ALL SELECT k, 'f4', NULL, 'x', true FROM p WHERE path = 'f4'
  UNION ALL SELECT k, 'g4', sha1({NULLS} || {NULLS} || encode(chr(1) || chr(10) || 'copy: f4' || chr(10) || 'copyrev: ' || file_node || chr(10) || chr(1) || chr(10) || 'moved')), '', true FROM p WHERE path = 'f4'
  UNION ALL SELECT k, 'new', sha1({NULLS} || {NULLS} || encode('fresh')), '', true FROM p WHERE path = 'f1'""")
def manifest_of_diff(spark, d):
    """The first file of each order deleted, the second modified, the third made a link, the fourth renamed, and one added."""
    p = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("k"), F.concat(F.lit("f"), text_of("l_linenumber")).alias("path")).agg(F.min(F.sha1(text_of("l_partkey"))).alias("file_node")).withColumn("attr", F.lit("x"))
    none = F.lit(None).cast("string")

    def change(of, status, path, source=none, old=none, new=none, attr="", content=none):
        rows = p.where(F.col("path") == of)
        return rows.select("k", F.lit(path).alias("path"), F.lit(status).alias("status"), source.alias("source"), old.alias("old_oid"), new.alias("oid"), F.lit(attr).cast("string").alias("attr"), content.alias("content"))

    made = [
        change("f1", "D", "f1", attr=None), change("f2", "M", "f2", old=F.lit("a"), new=F.lit("b"), content=F.concat(F.lit("new "), text_of("k"))), change("f3", "M", "f3", old=F.lit("a"), new=F.lit("a"), attr="l"),
        change("f4", "R", "g4", source=F.lit("f4"), new=F.lit("c"), content=F.lit("moved")), change("f1", "A", "new", new=F.lit("d"), content=F.lit("fresh")),
    ]
    changes = made[0]
    for c in made[1:]:
        changes = changes.unionByName(c)
    return history.manifest_of_diff(p, changes, ["k"])


# Objects ---------------------------------------------------------------------------------------


@query("""SELECT o_orderkey AS rev, sha1('t' || o_custkey) AS tree, CASE WHEN o_orderkey % 3 = 0 THEN '' WHEN o_orderkey % 3 = 1 THEN sha1('p') ELSE sha1('p') || ' ' || sha1('q') END AS parents,
  o_orderstatus || ' <a@b> 5 +0000' AS author, 'body' || chr(10) || chr(10) || o_orderstatus AS body FROM orders""")
def commit_parse(spark, d):
    k = F.col("o_orderkey")
    all_parents = F.array(F.sha1(F.lit("p")), F.sha1(F.lit("q")))
    author = F.concat("o_orderstatus", F.lit(" <a@b> 5 +0000"))
    raw = changesets.commit_text(F.sha1(F.concat(F.lit("t"), text_of("o_custkey"))), F.slice(all_parents, F.lit(1), (k % 3).cast("int")), author, F.lit("c <c@d> 6 +0000"), F.concat(F.lit("body\n\n"), "o_orderstatus"))
    c = objects.parse_commit(F.col("raw"))
    return load(spark, d, "orders").select(k.alias("rev"), "o_orderstatus", raw.alias("raw")).select("rev", c.alias("c")).select("rev", "c.tree", F.array_join("c.parents", " ").alias("parents"), "c.author", "c.body")


@query("""SELECT l_orderkey AS tree, (row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) - 1)::INT AS place, CASE WHEN l_linenumber = 1 THEN '40000' ELSE '100644' END AS mode,
  'f' || l_linenumber || '-' || l_partkey AS path, sha1(CAST(l_partkey AS VARCHAR)) AS oid FROM lineitem""")
def tree_parse(spark, d):
    entry = F.concat(F.hex(F.concat(F.when(F.col("l_linenumber") == 1, "40000").otherwise("100644"), F.lit(" f"), text_of("l_linenumber"), F.lit("-"), text_of("l_partkey"))), F.lit("00"), F.upper(F.sha1(text_of("l_partkey"))))
    rows = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("tree")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", entry.alias("e")))).alias("_e"))
    return objects.tree_entries(rows.select("tree", F.unhex(F.array_join("_e.e", "")).alias("content")))


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 1 THEN NULL ELSE 'blob' END AS kind, CASE WHEN doc_id % 5 = 1 THEN NULL ELSE n_chars END AS size FROM documents""")
def object_reads(spark, d):
    docs = load(spark, d, "documents").select("doc_id", "n_chars", F.sha1(text_of("doc_id")).alias("oid"))
    held = docs.select("oid", F.when(F.col("doc_id") % 5 == 1, "tree").otherwise("blob").alias("kind"), F.col("n_chars").alias("content"))
    return objects.read_objects(docs.select("doc_id", "oid"), held, "blob").select("doc_id", "kind", F.col("content").alias("size"))


@query(f"""SELECT doc_id, sha1({NULLS} || {NULLS} || encode(CASE WHEN doc_id % 2 = 0 THEN chr(1) || chr(10) || 'copy: a/' || source || chr(10) || 'copyrev: ' || sha1(source) || chr(10) || chr(1) || chr(10) ELSE '' END || coalesce(text, ''))) AS node,
  octet_length(encode(CASE WHEN doc_id % 2 = 0 THEN chr(1) || chr(10) || 'copy: a/' || source || chr(10) || 'copyrev: ' || sha1(source) || chr(10) || chr(1) || chr(10) ELSE '' END || coalesce(text, '')))::INT AS size FROM documents""")
def full_files(spark, d):
    """Files with and without a copy header, read as a whole; identifiers of copies by their header."""
    even = F.col("doc_id") % 2 == 0
    docs = load(spark, d, "documents").select("doc_id", F.concat(F.lit("a/"), "source").alias("from"), F.sha1("source").alias("from_node"), F.coalesce("text", F.lit("")).alias("content"), text_of("doc_id").alias("node"))
    headers = docs.where(even).select("node", objects.copy_header(F.col("from"), F.col("from_node")).alias("header"))
    whole = objects.full_files(docs.select("doc_id", "node"), docs.select("node", "content"), headers).select("doc_id", F.octet_length("content").alias("size"), F.col("content").alias("whole"))
    none = F.lit(None).cast("string")
    made = docs.select("doc_id", objects.copied_file_id(F.col("content"), F.col("from"), F.col("from_node")).alias("copied"))
    return whole.join(made, "doc_id").select("doc_id", F.when(even, F.col("copied")).otherwise(objects.node_hash(none, none, F.col("whole"))).alias("node"), "size")


@query("""SELECT p_partkey, '0,1,X%2D' || p_size || '%20y' || chr(0) || '3,4,' AS patch, 'X-' || p_size || ' y' || substr(p_name, 2, 2) || substr(p_name, 5) AS patched, false AS aligned, true AS at_lines FROM part WHERE length(p_name) > 4""")
def patch_codec(spark, d):
    hunk = lambda a, b, t: F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), t.alias("data"))
    rows = load(spark, d, "part").where("length(p_name) > 4").select("p_partkey", "p_name", objects.patch_text(F.array(hunk(0, 1, F.concat(F.lit("X-"), text_of("p_size"), F.lit(" y"))), hunk(3, 4, F.lit("")))).alias("patch"))
    hunks = objects.parse_patch(F.col("patch"))
    lines = F.concat("p_name", F.lit("\n"), "p_name")
    whole = F.array(F.struct(F.lit(0).alias("start"), (F.octet_length("p_name") + 1).alias("end"), F.lit("").alias("data")))
    return rows.select("p_partkey", "patch", objects.apply_patch(F.col("p_name"), hunks).cast("string").alias("patched"), objects.line_aligned(F.col("p_name"), hunks).alias("aligned"), objects.line_aligned(lines, whole).alias("at_lines"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN 0 ELSE o_orderkey % 4 END AS fillers FROM orders")
def changeset_fillers(spark, d):
    """Texts with three NULs behind them, of which as many stay as the identifier says; none fits where it is of another text."""
    k = F.col("o_orderkey")
    none = F.lit(None).cast("string")
    body = F.concat(F.lit("x"), k.cast("string"))
    filled = lambda n: F.concat(body, F.repeat(F.lit("\x00"), n))
    node = objects.node_hash(none, none, F.when(k % 4 == 3, F.lit("another")).otherwise(filled((k % 4).cast("int"))))
    rows = load(spark, d, "orders").select(k, body.alias("body"), filled(F.lit(3)).alias("raw"), node.alias("node"))
    kept = objects.without_fillers(F.col("raw"), F.col("node"), none, none)
    return rows.select("o_orderkey", (F.length(kept) - F.length("body")).cast("long").alias("fillers"))


@query(f"WITH {ENTRIES_SQL} SELECT commit_id, path, file_node, 'x' AS attr FROM entries")
def manifest_lines(spark, d):
    line = F.concat("path", F.lit("\x00"), "file_node", F.lit("x"))
    return views.entries(spark, d).select("commit_id", text.manifest_line(line).alias("l")).select("commit_id", "l.path", "l.file_node", "l.attr")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 7 = 3")
def file_violations(spark, d):
    k = F.col("o_orderkey")
    p1, p2 = F.sha1(F.lit("a")), F.sha1(F.lit("b"))
    node = F.when(k % 7 == 3, F.sha1(F.lit("no"))).when(k % 2 == 0, objects.node_hash(p1, F.lit(None).cast("string"), F.col("content"))).otherwise(objects.node_hash(p1, p2, F.col("content")))
    rows = load(spark, d, "orders").select(k, p1.alias("p1"), p2.alias("p2"), F.col("o_orderpriority").alias("content"))
    return integrity.changed_files(rows.withColumn("node", node)).select("o_orderkey")


@query("SELECT min(user_id) AS rank, event_type AS blob FROM events GROUP BY event_type")
def first_files(spark, d):
    return tags.first_files(load(spark, d, "events").select(F.col("user_id").alias("rank"), F.col("event_type").alias("blob")))


@query("SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN o_custkey + 1000000 ELSE o_custkey END AS commit FROM orders")
def replaced_commits(spark, d):
    o = load(spark, d, "orders")
    stored = o.select(F.col("o_custkey").alias("original"), F.when(F.col("o_custkey") % 3 == 0, F.col("o_custkey") + 1000000).otherwise(F.col("o_custkey")).alias("replacement")).distinct()
    return changesets.replacement_of(o.select("o_orderkey", F.col("o_custkey").alias("commit")), store.replacements(stored), "commit")


# Stores and settings ---------------------------------------------------------------------------


@query("""SELECT 'file' AS kind, c_name AS id, sha1('b' || c_custkey) AS oid FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 <> 0
  UNION ALL SELECT 'file', c_name, sha1('b' || (c_custkey + 1)) FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 5 <> 0""")
def typed_store(spark, d):
    c = load(spark, d, "customer")
    k = F.col("c_custkey")
    oid = lambda x: F.sha1(F.concat(F.lit("b"), x.cast("string")))
    held = c.where("c_custkey % 2 = 0").select(F.lit("file").alias("kind"), F.col("c_name").alias("id"), oid(k).alias("oid"))
    changes = c.where("c_custkey % 3 = 0").select(F.lit("file").alias("kind"), F.col("c_name").alias("id"), F.when(k % 5 != 0, oid(k + 1)).alias("oid"))
    known = c.select(oid(k + 1).alias("oid"), F.lit("blob").alias("kind"))
    return store.set_typed(held, changes, known)


@query("SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'n' ELSE c_name END AS v FROM customer WHERE c_custkey % 6 <> 0")
def written_notes(spark, d):
    c = load(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v"))
    changed, _ = store.written_notes(c, c.where("k % 3 = 0").select("k", F.when(F.col("k") % 2 == 1, "n").alias("v")), "k", "v")
    same, dirty = store.written_notes(changed, changed, "k", "v")
    if dirty:
        raise ValueError("nothing changed")
    return same


@query(f"""WITH {DAG_SQL}, h AS (SELECT rev, node, branch FROM nodes n WHERE NOT EXISTS (SELECT 1 FROM edges e JOIN nodes c ON c.rev = e.child WHERE e.parent = n.rev AND c.branch = n.branch))
  SELECT rev % 7 AS part, node, branch FROM h""")
def snapshot_heads(spark, d):
    n, e = views.graph(spark, d)
    found = dag.branch_heads(n.select("rev", "branch"), e).join(n.select("rev", "node"), "rev").withColumn("part", F.col("rev") % 7)
    return store.heads_text(found, ["part"]).select("part", F.explode(store.heads_of_text(F.col("text"))).alias("h")).select("part", "h.node", "h.branch")


@query("SELECT 'refs/' || r_name || '/' || n_name AS name, sha1(n_name) AS oid FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name LIKE 'A%' AND n_nationkey % 3 > 0")
def refs_under(spark, d):
    rows = load(spark, d, "nation").join(load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    named = rows.select(F.concat(F.lit("refs/"), "r_name", F.lit("/"), "n_name").alias("name"), F.sha1("n_name").alias("oid"), F.when(F.col("n_nationkey") % 3 > 0, "commit").otherwise("tag").alias("kind"))
    return store.refs_under(named.select("name", "oid"), named.select("oid", "kind"), "refs/A")


@query("SELECT c_mktsegment AS remote, 'https://' || max(c_custkey) AS url FROM customer GROUP BY 1")
def remotes(spark, d):
    c = load(spark, d, "customer")
    mine = c.select(F.concat(F.lit("remote."), "c_mktsegment", F.lit(".url")).alias("key"), F.concat(F.lit("https://"), text_of("c_custkey")).alias("value"), F.col("c_custkey").alias("place"))
    return store.remotes(mine.unionByName(c.select(F.lit("core.url").alias("key"), F.lit("x").alias("value"), F.col("c_custkey").alias("place"))))


@query("SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'variable' WHEN 1 THEN 'remote' WHEN 2 THEN 'plain' END AS value FROM customer")
def settings(spark, d):
    c = load(spark, d, "customer").select("c_custkey", F.concat(F.lit("set-"), text_of("c_custkey")).alias("name"), F.lit("origin").alias("remote"))
    k = F.col("c_custkey") % 4
    row = lambda when, source, key, value: c.where(when).select(F.lit(source).alias("source"), key.alias("key"), F.lit(value).alias("value"))
    config = row(k == 0, "env", F.concat(F.lit("TOOL_SET_"), text_of("c_custkey")), "variable").unionByName(row(k <= 1, "file", F.concat(F.lit("remote.origin.tool-"), "name"), "remote")).unionByName(row(k <= 2, "file", F.concat(F.lit("tool."), "name"), "plain"))
    return store.setting(config, c, "tool").select("c_custkey", "value")


@query("SELECT p_partkey AS place, 'https://h/' || p_partkey AS url, CASE WHEN p_partkey % 5 = 0 THEN 'b' END AS branch, CASE WHEN p_partkey % 5 = 0 THEN 1 ELSE 0 END AS grafts FROM part WHERE p_partkey % 5 IN (0, 2)")
def clone_lines(spark, d):
    return _clone_lines(spark, d).select("place", "url", "branch", F.size("graft").alias("grafts"))


def _clone_lines(spark, d):
    k = F.col("p_partkey")
    at = F.concat(F.lit("https://h/"), k.cast("string"))
    line = F.when(k % 5 == 0, F.concat(at, F.lit("#b graft="), F.sha1(k.cast("string")))).when(k % 5 == 1, F.concat(at, F.lit(" other=1"))).when(k % 5 == 2, at).when(k % 5 == 3, "no address").otherwise("")
    return load(spark, d, "part").select(k.alias("place"), text.clone_line(line).alias("l")).where("l IS NOT NULL").select("place", "l.*")


@query("SELECT 'https://h/' || min(p_partkey) AS url, 'b' AS branch FROM part WHERE p_partkey % 5 = 0 AND p_partkey > 20")
def clone_source(spark, d):
    lines = _clone_lines(spark, d)
    known = load(spark, d, "part").where("p_partkey > 20").select(F.sha1(text_of("p_partkey")).alias("oid"))
    return refs.clone_source(lines, known=known)


@query("""SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'https://h' || page_id || '.org/x' WHEN 1 THEN 'http://h' || page_id || ':8080/x?q' WHEN 2 THEN 'https://h' || page_id || ':443' WHEN 3 THEN 'tags:' WHEN 4 THEN url END AS address FROM pages""")
def plain_urls(spark, d):
    k = F.col("page_id")
    host = F.concat(F.lit("hg://h"), k.cast("string"))
    raw = F.when(k % 6 == 0, F.concat(host, F.lit(".org/x"))).when(k % 6 == 1, F.concat(host, F.lit(":8080.http/x?q"))).when(k % 6 == 2, F.concat(host, F.lit(":443"))).when(k % 6 == 3, "hg://:tags").when(k % 6 == 4, F.concat(F.lit("hg::"), "url")).otherwise(F.col("url"))
    return load(spark, d, "pages").select("page_id", text.plain_url(raw).alias("address"))


@query("""SELECT o_orderkey, o_orderpriority AS name, 'a@b' AS email, o_custkey AS ts, ((o_orderkey % 53 - 26) * 1800)::INT AS west, o_orderpriority || ' <a@b>' AS author FROM orders""")
def author_lines(spark, d):
    k = F.col("o_orderkey")
    line = authorship.author_line(F.col("o_orderpriority"), F.lit("a@b"), F.col("o_custkey"), ((k % 53 - 26) * 1800).cast("int"))
    rows = load(spark, d, "orders").select(k, authorship.parse_author_line(line).alias("a")).select("o_orderkey", "a.*")
    return rows.withColumn("author", authorship.plain_author(F.col("name"), F.col("email"))).withColumn("west", F.col("west").cast("int"))


@query("""SELECT c_custkey, c_name AS name, '' AS email, c_custkey AS ts, CASE c_custkey % 5 WHEN 0 THEN -5400 WHEN 1 THEN 18000 WHEN 2 THEN 3600 WHEN 3 THEN 36900 ELSE -1800 END AS west FROM customer""")
def committers(spark, d):
    k = F.col("c_custkey")
    offset = F.when(k % 5 == 0, "+0130").when(k % 5 == 1, "-0500").when(k % 5 == 2, "3600").when(k % 5 == 3, "-1015").otherwise("-1800")
    parsed = authorship.parse_committer(F.concat_ws(" ", "c_name", k.cast("string"), offset))
    return load(spark, d, "customer").select(k, parsed.alias("a")).select("c_custkey", "a.name", "a.email", "a.ts", F.col("a.west").cast("int").alias("west"))


@query("""SELECT p_partkey, split_part(p_type, ' ', 1) AS first, CASE WHEN length(p_type) - length(replace(p_type, ' ', '')) >= 1 THEN substr(p_type, instr(p_type, ' ') + 1) END AS rest,
  CASE WHEN length(p_type) - length(replace(p_type, ' ', '')) >= 1 THEN split_part(p_type, ' ', -1) END AS last FROM part""")
def exact_splits(spark, d):
    two, back = text.split_exactly(F.col("p_type"), " ", 2), text.split_exactly(F.col("p_type"), " ", 2, from_end=True)
    rows = load(spark, d, "part").select("p_partkey", "p_type", two.alias("two"), back.alias("back"))
    return rows.select("p_partkey", F.coalesce(F.get("two", F.lit(0)), "p_type").alias("first"), F.get("two", F.lit(1)).alias("rest"), F.get("back", F.lit(1)).alias("last"))


STYLE_SQL = f"""WITH {DAG_SQL}, bh AS (SELECT rev, node, branch, closed FROM nodes n WHERE NOT EXISTS (
  SELECT 1 FROM edges e JOIN nodes c ON c.rev = e.child WHERE e.parent = n.rev AND c.branch = n.branch)),
  tip AS (SELECT * FROM bh QUALIFY row_number() OVER (PARTITION BY branch ORDER BY closed, CASE WHEN closed THEN rev ELSE -rev END) = 1)
  SELECT 'ht' AS style, 'refs/heads/' || branch || '/' || node AS ref, node FROM bh WHERE rev NOT IN (SELECT rev FROM tip) UNION ALL SELECT 'ht', 'refs/heads/' || branch || '/tip', node FROM tip
  UNION ALL SELECT 't', 'refs/heads/' || branch, node FROM tip UNION ALL SELECT 'b', 'refs/heads/' || n_name, sha1(n_name) FROM nation
  UNION ALL SELECT 'tb', 'refs/heads/branches/' || branch, node FROM tip UNION ALL SELECT 'tb', 'refs/heads/bookmarks/' || n_name, sha1(n_name) FROM nation
  UNION ALL SELECT 'h', 'refs/heads/' || branch || '/' || node, node FROM bh
  UNION ALL SELECT 'hb', 'refs/heads/branches/' || branch || '/' || node, node FROM bh UNION ALL SELECT 'hb', 'refs/heads/bookmarks/' || n_name, sha1(n_name) FROM nation"""


@query(STYLE_SQL)
def ref_styles(spark, d):
    n, e = views.graph(spark, d)
    marks = load(spark, d, "nation").select(F.col("n_name").alias("name"), F.sha1("n_name").alias("node"))
    out = None
    for style in ("ht", "t", "b", "tb", "h", "hb"):
        kinds = {{"h": "heads", "t": "tips", "b": "bookmarks"}[c] for c in style}
        rows = refs.styled_listing(n, e, marks, kinds).select(F.lit(style).alias("style"), "ref", "node")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 3 THEN NULL WHEN o_orderkey % 2 = 0 THEN sha1('a') ELSE sha1('a') || ' ' || sha1('b') END AS parents FROM orders")
def file_parents(spark, d):
    k = F.col("o_orderkey")
    p1, p2 = F.sha1(F.lit("a")), F.sha1(F.lit("b"))
    node = F.when(k % 7 == 3, F.sha1(F.lit("no"))).when(k % 2 == 0, objects.node_hash(p1, F.lit(None).cast("string"), F.col("content"))).otherwise(objects.node_hash(p1, p2, F.col("content")))
    rows = load(spark, d, "orders").select(k, F.col("o_orderpriority").alias("content")).withColumn("node", node)
    return rows.select("o_orderkey", F.array_join(identity.file_parents(F.col("node"), p1, p2, F.col("content")), " ").alias("parents"))


@query("SELECT n_nationkey, n_name AS name, 'a b/' || n_nationkey AS value, 'a%20b/' || n_nationkey AS quoted FROM nation")
def capabilities(spark, d):
    """Capabilities with a value each, encoded and decoded."""
    line = text.encode_capabilities(F.create_map(F.col("n_name"), F.array(F.concat(F.lit("a b/"), text_of("n_nationkey")))))
    rows = load(spark, d, "nation").select("n_nationkey", line.alias("line"))
    return rows.select("n_nationkey", F.explode(text.decode_capabilities(F.col("line"))).alias("name", "values"), F.substring_index("line", "=", -1).alias("quoted")).select(
        "n_nationkey", "name", F.get("values", F.lit(0)).alias("value"), "quoted"
    )


@query("SELECT sha1(CAST(o_orderkey AS VARCHAR)) AS snapshot_id, ((SELECT max(o_orderkey) FROM orders) - o_orderkey)::INT AS step, CASE WHEN o_orderkey % 3 = 0 THEN 'checked' ELSE '' END AS status FROM orders")
def rollback_candidates(spark, d):
    o = load(spark, d, "orders").select("o_orderkey")
    of = lambda k: F.sha1(k.cast("string"))
    k = F.col("o_orderkey")
    chain = o.select(of(k).alias("snapshot_id"), F.when(k > 0, of(k - 1)).alias("prev_id"), F.when(k % 3 == 0, "checked").otherwise("").alias("status"))
    return snapshots.candidates(chain, o.agg(F.max("o_orderkey").alias("o_orderkey")).select(of(k).alias("snapshot_id")))


@query(f"WITH {DAG_SQL} SELECT rev, branch FROM nodes")
def unique_nodes(spark, d):
    return dag.assert_unique(views.nodes(spark, d)).select("rev", "branch")


@query("""SELECT o_orderkey AS rev, o_orderkey AS graft FROM orders QUALIFY count(*) OVER (PARTITION BY o_custkey, o_orderpriority) = 1""")
def strict_grafts(spark, d):
    """Changesets grafted to commits of the same tree, time and parents; those that share all of these with others are not."""
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("rev"), F.col("o_custkey").alias("tree"), F.lit(1).alias("ts"), F.array("o_orderpriority").alias("parents"), F.lit("s").alias("subject"), F.lit("a").alias("author"))
    commits = o.withColumn("commit", F.col("rev")).withColumn("own", F.lit(True)).drop("rev")
    return changesets.graft(o, commits, strict=True).where("commit IS NOT NULL").select("rev", F.col("commit").alias("graft"))
