"""Queries over the operators that make history: changesets, notes, grafts, merges, trees, tags and pushes."""

from __future__ import annotations

from pyspark.sql import functions as F

from revstrata.functions import identity, text
from revstrata.operators import changesets, dag, integrity, ordering, paths, refs, tags
from revstrata.plans import views
from revstrata.plans.catalog import query
from revstrata.plans.views import DAG_SQL, MAPPING_SQL, TAGS_SQL
from revstrata.tables import load

# Changesets and commits ------------------------------------------------------------------------

RAW_SQL = """raw AS (SELECT o_orderkey AS rev, sha1('m' || o_custkey) || chr(10) || o_orderpriority || chr(10) || epoch(o_orderdate)::BIGINT || ' 0' || chr(10) ||
    array_to_string(list_sort(['z' || o_orderstatus, 'a' || o_custkey]), chr(10)) || chr(10) || chr(10) || 'body ' || o_orderstatus AS raw FROM orders)"""


def _raw(spark, d):
    date = F.concat(F.unix_seconds(F.col("o_orderdate").cast("timestamp")).cast("string"), F.lit(" 0"))
    customer = F.col("o_custkey").cast("string")
    files = F.array(F.concat(F.lit("z"), "o_orderstatus"), F.concat(F.lit("a"), customer))
    raw = changesets.changeset_text(F.sha1(F.concat(F.lit("m"), customer)), F.col("o_orderpriority"), date, files, F.concat(F.lit("body "), "o_orderstatus"))
    return load(spark, d, "orders").select(F.col("o_orderkey").alias("rev"), raw.alias("raw"))


@query(f"WITH {RAW_SQL} SELECT rev, sha1(raw) AS digest, string_split(raw, chr(10))[1] AS manifest, 2 AS files, 'body ' || right(raw, 1) AS body FROM raw")
def changeset_text(spark, d):
    rows = _raw(spark, d).withColumn("c", text.split_changeset(F.col("raw")))
    return rows.select("rev", F.sha1("raw").alias("digest"), "c.manifest", F.size("c.files").alias("files"), "c.body")


@query("""SELECT o_orderkey AS rev, 'changeset ' || sha1(CAST(o_orderkey AS VARCHAR)) || chr(10) || 'manifest ' || sha1('m' || o_custkey) ||
  CASE WHEN o_orderstatus <> 'F' THEN chr(10) || 'author ' || o_orderpriority ELSE '' END || chr(10) || 'files z' || o_orderstatus AS note,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS author FROM orders""")
def changeset_notes(spark, d):
    """Notes that keep an author only where the commit implies another, written and parsed."""
    implied = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).otherwise("nobody")
    note = changesets.note_text(
        {
            "changeset": F.sha1(F.col("o_orderkey").cast("string")),
            "manifest": F.sha1(F.concat(F.lit("m"), F.col("o_custkey").cast("string"))),
            "author": changesets.differing(F.col("o_orderpriority"), implied),
            "files": F.concat(F.lit("z"), "o_orderstatus"),
        }
    )
    rows = load(spark, d, "orders").select(F.col("o_orderkey").alias("rev"), note.alias("note"))
    return rows.select("rev", "note", F.try_element_at(changesets.parse_note(F.col("note")), F.lit("author")).alias("author"))


@query(f"""WITH {MAPPING_SQL} SELECT o_orderkey AS rev, sha1(encode('commit ' || length(t) || chr(0) || t)) AS oid FROM (
  SELECT o_orderkey, 'tree ' || sha1('t' || o_custkey) || chr(10) || 'parent ' || sha1('p' || o_orderkey) || chr(10) || 'author a <b> 0 +0000' || chr(10) ||
    'committer ' || o_orderstatus || ' <c> 1 +0000' || chr(10) || chr(10) || o_orderpriority AS t FROM orders)""")
def commit_ids(spark, d):
    key, customer = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    raw = changesets.commit_text(
        F.sha1(F.concat(F.lit("t"), customer)),
        F.array(F.sha1(F.concat(F.lit("p"), key))),
        F.lit("a <b> 0 +0000"),
        F.concat("o_orderstatus", F.lit(" <c> 1 +0000")),
        F.col("o_orderpriority"),
    )
    return load(spark, d, "orders").select(F.col("o_orderkey").alias("rev"), identity.object_id(F.lit("commit"), raw).alias("oid"))


@query("""WITH t AS (SELECT o_orderkey AS rev, o_custkey || o_orderstatus AS stem, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS own FROM orders),
  n AS (SELECT *, row_number() OVER (PARTITION BY stem ORDER BY own, rev) AS r FROM t)
  SELECT rev, stem || repeat(chr(10), (r + max(own - r) OVER (PARTITION BY stem ORDER BY own, rev))::INT) AS text FROM n""")
def commit_conflicts(spark, d):
    own = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    rows = load(spark, d, "orders").select(F.col("o_orderkey").alias("rev"), F.concat(F.col("o_custkey").cast("string"), "o_orderstatus", F.repeat(F.lit("\n"), own)).alias("text"))
    return changesets.spread_conflicts(rows)


@query("""WITH s AS (SELECT o_orderkey AS rev, o_custkey // 4 AS tree, date_trunc('month', o_orderdate) AS ts, o_orderpriority AS subject, o_orderstatus AS author FROM orders),
  k AS (SELECT s.rev, c.rev AS commit, c.subject = s.subject AS ss, c.subject = s.subject AND c.author = s.author AS sa, c.author = 'P' AS own
    FROM s JOIN s c ON c.tree = s.tree AND c.ts = s.ts + INTERVAL 1 MONTH),
  n AS (SELECT rev, count(*) AS n, count(*) FILTER (ss) AS ns, count(*) FILTER (sa) AS na FROM k GROUP BY rev),
  kept AS (SELECT k.rev, k.commit, k.own FROM k JOIN n USING (rev)
    WHERE CASE WHEN n > 1 AND ns = 1 THEN ss WHEN n > 1 AND ns > 1 AND na = 1 THEN sa ELSE true END),
  one AS (SELECT rev, count(*) AS candidates, CASE WHEN count(*) = 1 THEN min(commit) WHEN count(*) FILTER (NOT own) = 1 THEN min(commit) FILTER (NOT own) END AS commit FROM kept GROUP BY rev),
  won AS (SELECT commit, min(rev) AS rev FROM one WHERE commit IS NOT NULL GROUP BY commit)
  SELECT s.rev, won.commit, coalesce(one.candidates, 0)::BIGINT AS candidates FROM s LEFT JOIN one USING (rev) LEFT JOIN won USING (rev)""")
def graft_match(spark, d):
    o = load(spark, d, "orders").selectExpr(
        "o_orderkey as rev", "o_custkey div 4 as tree", "trunc(cast(o_orderdate as date), 'MM') as ts", "o_orderpriority as subject", "o_orderstatus as author"
    )
    commits = o.select(F.col("rev").alias("commit"), "tree", F.add_months("ts", -1).alias("ts"), "subject", "author", (F.col("author") == "P").alias("own"))
    return changesets.graft(o, commits)


# Graphs ----------------------------------------------------------------------------------------


@query(f"""WITH RECURSIVE {DAG_SQL}, unknown AS (SELECT rev, p1 FROM nodes WHERE NOT closed), pushes AS (SELECT rev, 'push' || rev AS branch FROM nodes WHERE rev NOT IN (SELECT parent FROM edges) AND branch = '2-HIGH'),
  s AS (SELECT rev, rev AS "order" FROM pushes WHERE rev IN (SELECT rev FROM unknown) UNION SELECT e.parent, s."order" FROM s JOIN edges e ON e.child = s.rev JOIN unknown u ON u.rev = e.parent),
  named AS (SELECT rev, min("order") AS "order" FROM s GROUP BY rev),
  w AS (SELECT rev, p1 AS at FROM unknown UNION ALL SELECT w.rev, u.p1 FROM w JOIN unknown u ON u.rev = w.at),
  near AS (SELECT w.rev, n.branch FROM w JOIN nodes n ON n.rev = w.at WHERE n.closed)
  SELECT rev, branch, 'known' AS kind FROM nodes WHERE closed
  UNION ALL SELECT u.rev, CASE WHEN m."order" IS NOT NULL THEN 'push' || m."order" ELSE near.branch END, CASE WHEN m."order" IS NOT NULL THEN 'set' ELSE 'inferred' END
  FROM unknown u LEFT JOIN named m USING (rev) LEFT JOIN near USING (rev)""")
def branch_inference(spark, d):
    n, e = views.graph(spark, d)
    pushes = dag.heads(n, e).where("branch = '2-HIGH'").select("rev", F.concat(F.lit("push"), F.col("rev").cast("string")).alias("branch"), F.col("rev").alias("order"))
    return dag.infer_branches(n.select("rev", "p1", "branch", F.col("closed").alias("known")), e, pushes)


@query(f"""WITH RECURSIVE {DAG_SQL}, b AS (SELECT rev FROM nodes WHERE branch = '1-URGENT' UNION SELECT e.parent FROM b JOIN edges e ON e.child = b.rev)
  SELECT rev FROM b WHERE rev NOT IN (SELECT parent FROM edges WHERE child IN (SELECT rev FROM b))""")
def discovery(spark, d):
    n, e = views.graph(spark, d)
    return dag.discover(n, e, dag.ancestors(n, e, n.where("branch = '1-URGENT'")), sample=4_000)


# Manifests and trees ---------------------------------------------------------------------------

SIDES_SQL = """side AS (SELECT l_orderkey % 3 AS k, l_suppkey, 'd' || l_linenumber || '/' || l_partkey % 50 AS path, min(sha1(CAST(l_suppkey AS VARCHAR) || l_returnflag)) AS oid, min(l_linestatus) AS attr
  FROM lineitem GROUP BY ALL)"""


def _three(spark, d):
    rows = load(spark, d, "lineitem").groupBy(
        (F.col("l_orderkey") % 3).alias("k"), "l_suppkey", F.concat(F.lit("d"), F.col("l_linenumber").cast("string"), F.lit("/"), (F.col("l_partkey") % 50).cast("string")).alias("path")
    )
    sides = rows.agg(F.min(F.sha1(F.concat(F.col("l_suppkey").cast("string"), "l_returnflag"))).alias("oid"), F.min("l_linestatus").alias("attr"))
    return [sides.where(f"k = {k}").drop("k").withColumn("file_node", F.sha1(F.concat(F.lit("f"), "oid"))) for k in range(3)]


@query(f"""WITH {SIDES_SQL}, f AS (SELECT * FROM side WHERE k = 0), a AS (SELECT * FROM side WHERE k = 1), b AS (SELECT * FROM side WHERE k = 2),
  m AS (SELECT l_suppkey, path, f.oid, f.attr, a.oid AS o1, b.oid AS o2, a.attr AS attr1 FROM f FULL JOIN a USING (l_suppkey, path) FULL JOIN b USING (l_suppkey, path)),
  p AS (SELECT *, CASE WHEN oid IS NULL THEN NULL WHEN o1 = o2 THEN sha1('f' || o1) ELSE concat_ws(' ', sha1('f' || o1), sha1('f' || o2)) END AS parents,
    oid IS NOT NULL AND coalesce(o1, o2) = oid AND (o1 IS NULL OR o2 IS NULL OR o1 = o2) AS same FROM m)
  SELECT l_suppkey, path, parents, CASE WHEN same THEN sha1('f' || oid) END AS file_node,
    CASE WHEN oid IS NULL THEN true ELSE NOT coalesce(same, false) OR coalesce(attr1 <> attr, false) END AS listed FROM p WHERE oid IS NOT NULL OR o1 IS NOT NULL""")
def merge_manifest(spark, d):
    files, first, second = _three(spark, d)
    return paths.merged_manifest(files, first, second, ["l_suppkey", "path"]).withColumn("parents", F.array_join("parents", " "))


@query("""WITH e AS (SELECT DISTINCT l_orderkey, 'd' || l_linenumber || CASE WHEN l_returnflag = 'R' THEN '//' ELSE '/' END || l_partkey % 10 AS path FROM lineitem)
  SELECT l_orderkey, regexp_replace(path, '/+', '/', 'g') AS path, bool_or(path NOT LIKE '%//%') AS clean FROM e GROUP BY 1, 2""")
def tree_paths(spark, d):
    slash = F.when(F.col("l_returnflag") == "R", "//").otherwise("/")
    path = F.concat(F.lit("d"), F.col("l_linenumber").cast("string"), slash, (F.col("l_partkey") % 10).cast("string"))
    rows = load(spark, d, "lineitem").select("l_orderkey", path.alias("path")).distinct().withColumn("clean", ~F.contains("path", F.lit("//")))
    return paths.clean_paths(rows, ["l_orderkey"])


@query("""WITH e AS (SELECT l_orderkey, 'd' || l_linenumber AS dir, CAST(l_partkey AS VARCHAR) AS name, min(sha1(CAST(l_suppkey AS VARCHAR))) AS oid FROM lineitem GROUP BY 1, 2, 3),
  b AS (SELECT l_orderkey, dir AS path, string_agg(hex('100644 ' || name) || '00' || upper(oid), '' ORDER BY name) AS body FROM e GROUP BY 1, 2),
  t AS (SELECT l_orderkey, path, sha1(encode('tree ' || length(body) // 2) || unhex('00') || unhex(body)) AS oid FROM b),
  r AS (SELECT l_orderkey, string_agg(hex('40000 ' || path) || '00' || upper(oid), '' ORDER BY path || '/') AS body FROM t GROUP BY 1)
  SELECT * FROM t UNION ALL SELECT l_orderkey, '', sha1(encode('tree ' || length(body) // 2) || unhex('00') || unhex(body)) FROM r""")
def tree_ids(spark, d):
    rows = load(spark, d, "lineitem").select(
        "l_orderkey", F.concat(F.lit("d"), F.col("l_linenumber").cast("string"), F.lit("/"), F.col("l_partkey").cast("string")).alias("path"), F.unhex(F.sha1(F.col("l_suppkey").cast("string"))).alias("oid")
    )
    files = rows.groupBy("l_orderkey", "path").agg(F.lower(F.hex(F.min("oid"))).alias("oid")).withColumn("mode", F.lit("100644"))
    return paths.tree_objects(files, ["l_orderkey"])


# Names, tags and pushes ------------------------------------------------------------------------


@query(r"""WITH u AS (SELECT page_id, regexp_extract(url, '^[a-z]+://(?:[^/@]*@)?([^/:?#]*)', 1) AS host, string_split(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '/') AS p FROM pages),
  f AS (SELECT page_id, list_filter(list_concat([host], p), lambda x: x <> '') AS parts FROM u)
  SELECT page_id, array_to_string(list_concat(list_transform(range(1, len(parts) + 1), lambda k: array_to_string(parts[len(parts) - k + 1 :], '/')), ['metadata']), ' ') AS branches FROM f""")
def metadata_branches(spark, d):
    return load(spark, d, "pages").select("page_id", F.array_join(text.metadata_branches(F.col("url")), " ").alias("branches"))


@query("""WITH l AS (SELECT p_partkey, CASE p_size % 6 WHEN 0 THEN 'tip' WHEN 1 THEN CAST(p_partkey AS VARCHAR) WHEN 2 THEN p_name || ' ' WHEN 3 THEN p_brand || ':' WHEN 4 THEN p_name ELSE chr(9) || p_type END AS label FROM part)
  SELECT p_partkey, label, label IN ('tip', '.', 'null', '') OR regexp_matches(label, '^[0-9]+$') OR contains(label, ':') OR label <> trim(label, ' ' || chr(9)) AS bad FROM l""")
def label_check(spark, d):
    k = F.col("p_size") % 6
    label = (
        F.when(k == 0, "tip")
        .when(k == 1, F.col("p_partkey").cast("string"))
        .when(k == 2, F.concat("p_name", F.lit(" ")))
        .when(k == 3, F.concat("p_brand", F.lit(":")))
        .when(k == 4, F.col("p_name"))
        .otherwise(F.concat(F.lit("\t"), "p_type"))
    )
    return load(spark, d, "part").select("p_partkey", label.alias("label")).withColumn("bad", text.bad_label(F.col("label")))


@query(f"""WITH {TAGS_SQL} SELECT tag || '@' || file AS tag, tag || '@' || file || ' ' || coalesce(CASE WHEN node < '8' THEN sha1('git' || node) END, repeat('0', 40)) || ' ' || node AS line FROM tags WHERE node <> ''""")
def tag_list(spark, d):
    found = tags.tags_in_file(views.tag_lines(spark, d)).select(F.concat("tag", F.lit("@"), F.col("file").cast("string")).alias("tag"), "node")
    known = found.where("node <> '' AND node < '8'").select(F.col("node").alias("hg")).distinct().withColumn("git", F.sha1(F.concat(F.lit("git"), "hg")))
    return refs.tag_list(found, known, "%(tagname) %(objectname) %(hg::objectname)")


@query(f"""WITH {TAGS_SQL}, c AS (SELECT tag || '@' || file AS tag, node AS old, CASE WHEN file % 3 = 0 THEN '' WHEN file % 3 = 1 THEN node ELSE sha1(tag) END AS new FROM tags)
  SELECT tag, 0 AS line, old AS node FROM c WHERE old <> new AND old <> '' UNION ALL SELECT tag, 1, new FROM c WHERE old <> new""")
def tag_updates(spark, d):
    found = tags.tags_in_file(views.tag_lines(spark, d))
    current = found.select(F.concat("tag", F.lit("@"), F.col("file").cast("string")).alias("tag"), "node")
    new = F.when(F.col("file") % 3 == 0, "").when(F.col("file") % 3 == 1, F.col("node")).otherwise(F.sha1("tag"))
    updates = found.select(F.concat("tag", F.lit("@"), F.col("file").cast("string")).alias("tag"), new.alias("node"))
    return tags.tag_lines_for(current, updates)


@query(f"WITH {DAG_SQL} SELECT branch, sha1(unhex(string_agg(DISTINCT node, '' ORDER BY node))) AS digest FROM nodes WHERE rev NOT IN (SELECT parent FROM edges) GROUP BY branch")
def heads_digest(spark, d):
    n, e = views.graph(spark, d)
    return refs.heads_digest(dag.heads(n, e), ["branch"])


@query(f"""WITH RECURSIVE {DAG_SQL}, pub AS (SELECT rev FROM nodes WHERE branch = '1-URGENT' UNION SELECT e.parent FROM pub JOIN edges e ON e.child = pub.rev)
  SELECT rev FROM nodes WHERE closed AND rev IN (SELECT rev FROM pub)""")
def phase_retention(spark, d):
    n, e = views.graph(spark, d)
    drafts = n.select("rev").join(dag.ancestors(n, e, n.where("branch = '1-URGENT'")), "rev", "left_anti")
    return refs.retained(n.where("closed").select("rev"), drafts, "phase")


# Checks and orders -----------------------------------------------------------------------------


@query(f"""WITH {DAG_SQL}, h AS (SELECT node, branch FROM nodes WHERE rev NOT IN (SELECT parent FROM edges)), s AS (SELECT node, branch FROM nodes WHERE closed)
  SELECT *, 'stored' AS side FROM (SELECT * FROM s EXCEPT SELECT * FROM h) UNION ALL SELECT *, 'computed' FROM (SELECT * FROM h EXCEPT SELECT * FROM s)""")
def head_mismatches(spark, d):
    n, e = views.graph(spark, d)
    return integrity.head_mismatches(n.where("closed").select("node", "branch"), dag.heads(n, e).select("node", "branch"), ["node", "branch"])


@query("""WITH c AS (SELECT o_orderkey AS k, o_orderstatus AS st, sha1(unhex(repeat('0', 80)) || encode(o_orderpriority)) AS node FROM orders),
  e AS (SELECT l_orderkey AS k, sha1(unhex(repeat('0', 80)) || encode(string_agg(path || chr(0) || f || chr(10), '' ORDER BY path))) AS node, min(st) AS st FROM (
    SELECT l_orderkey, 'p' || l_partkey AS path, min(sha1(CAST(l_suppkey AS VARCHAR))) AS f FROM lineitem GROUP BY 1, 2) JOIN c ON c.k = l_orderkey GROUP BY 1),
  f AS (SELECT DISTINCT sha1(CAST(l_suppkey AS VARCHAR)) AS node FROM lineitem),
  m AS (SELECT c.k, CASE WHEN e.node IS NULL THEN sha1('none' || c.k) WHEN c.st = 'P' THEN sha1('bad' || c.k) ELSE e.node END AS node, e.node AS made FROM c LEFT JOIN e USING (k)),
  n AS (SELECT CASE WHEN st = 'P' THEN sha1('lost' || k) ELSE node END AS node, node AS made FROM c),
  g AS (SELECT sha1(CAST(s_suppkey AS VARCHAR)) AS id FROM supplier UNION ALL SELECT sha1('q' || s_suppkey) FROM supplier)
  SELECT 'changeset' AS kind, node AS id FROM n WHERE node <> made UNION ALL SELECT 'manifest', node FROM m WHERE node <> made UNION ALL SELECT 'missing', node FROM m WHERE made IS NULL
  UNION ALL SELECT 'head', sha1('head' || k) FROM c WHERE st = 'P'
  UNION ALL SELECT 'dangling', id FROM g WHERE id NOT IN (SELECT node FROM n UNION SELECT node FROM m UNION SELECT node FROM f)""")
def fsck(spark, d):
    """Orders as changesets and manifests, of which those with status P are broken, checked against lineitem's entries."""
    key, none = F.col("o_orderkey").cast("string"), F.lit(None).cast("string")
    o = load(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    broken = F.col("o_orderstatus") == "P"
    good = identity.node_hash(none, none, F.col("o_orderpriority"))
    nodes = o.select(F.when(broken, F.sha1(F.concat(F.lit("lost"), key))).otherwise(good).alias("node"), none.alias("p1"), none.alias("p2"), F.col("o_orderpriority").alias("content"))
    rows = load(spark, d, "lineitem").select(F.col("l_orderkey").alias("manifest"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("path"), F.sha1(F.col("l_suppkey").cast("string")).alias("f"))
    entries = rows.groupBy("manifest", "path").agg(F.min("f").alias("file_node")).withColumn("attr", F.lit(""))
    own = integrity.manifest_contents(entries).select(F.col("manifest").alias("o_orderkey"), identity.node_hash(none, none, F.col("content")).alias("made"))
    named = F.when(F.col("made").isNull(), F.sha1(F.concat(F.lit("none"), key))).when(broken, F.sha1(F.concat(F.lit("bad"), key))).otherwise(F.col("made"))
    manifests = o.join(own, "o_orderkey", "left").select(F.col("o_orderkey").alias("manifest"), named.alias("node"), none.alias("p1"), none.alias("p2"))
    s = load(spark, d, "supplier").select(F.col("s_suppkey").cast("string").alias("k"))
    known = s.select(F.sha1("k").alias("hg")).unionAll(s.select(F.sha1(F.concat(F.lit("q"), "k"))))
    stored = o.select(F.sha1(F.concat(F.lit("head"), key)).alias("node"), F.col("o_orderpriority").alias("branch"), "o_orderstatus")
    return integrity.fsck(nodes, manifests, entries, known, stored.drop("o_orderstatus"), stored.where("o_orderstatus <> 'P'").drop("o_orderstatus"), rows.select(F.col("f").alias("node")))


@query("SELECT event_id, (row_number() OVER (ORDER BY ts, event_id) - 1) // 100 AS batch FROM events")
def batches(spark, d):
    return ordering.batches(load(spark, d, "events").select("ts", "event_id"), ["ts", "event_id"], 100).select("event_id", "batch")


@query("""WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents), x AS (SELECT doc_id, unnest(p) AS t, generate_subscripts(p, 1) - 1 AS line, len(p) AS n FROM l),
  y AS (SELECT doc_id, line::INT AS line, octet_length(encode(t)) + CASE WHEN line < n - 1 THEN 1 ELSE 0 END AS length FROM x)
  SELECT doc_id, line, coalesce(sum(length) OVER (PARTITION BY doc_id ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start, length::BIGINT AS length FROM y WHERE length > 0""")
def line_offsets(spark, d):
    return ordering.line_offsets(load(spark, d, "documents"), "doc_id")
