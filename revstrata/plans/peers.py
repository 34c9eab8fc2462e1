"""Queries over changesets put together from commits and notes, what repositories say to each other, and prepared snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revstrata.functions.identity import node_hash
from revstrata.operators import changesets, ordering, peer, rebuild, scratch, store
from revstrata.operators.session import Store
from revstrata.plans import views
from revstrata.plans.catalog import query
from revstrata.plans.views import DAG_SQL
from revstrata.tables import load

#: Changesets of five kinds by the rest of their number: said whole by the commit; another author and a branch; another committer; files
#: out of order and a commit whose body goes on (these need a patch); a commit with NULs behind it.
CHANGESET_SQL = """
c AS (SELECT o_orderkey AS rev, o_orderkey % 5 AS kind, o_custkey, o_orderpriority, sha1('m' || o_orderkey) AS manifest FROM orders),
n AS (SELECT *, CASE WHEN kind = 1 THEN 'odd ' || o_custkey END AS author_noted, CASE WHEN kind = 1 THEN 'branch:' || o_orderpriority END AS extra_noted,
  CASE kind WHEN 0 THEN NULL WHEN 3 THEN 'z' || chr(10) || 'a' ELSE 'a' || chr(10) || 'b' END AS files FROM c),
t AS (SELECT *, manifest || chr(10) || coalesce(author_noted, 'N' || o_custkey || ' <a@b>') || chr(10) || (1000000000 + rev) || ' -3600' || coalesce(' ' || extra_noted, '') ||
  CASE WHEN kind = 2 THEN ' committer:C <c@d> ' || (1000000005 + rev) || ' 9000' ELSE '' END || coalesce(chr(10) || files, '') || chr(10) || chr(10) || 'order ' || rev || chr(10) || o_orderpriority AS text FROM n)"""


def _changesets(spark: SparkSession, d: str) -> DataFrame:
    """(rev, oid, hg, node, text, raw, written): changesets with their commits, and these as they were when their notes were written."""
    k = F.col("o_orderkey")
    kind, none = k % 5, F.lit(None).cast("string")
    word = lambda c: c.cast("string")
    at, later = word(k + 1000000000), word(k + 1000000005)
    who = F.concat(F.lit("N"), word(F.col("o_custkey")), F.lit(" <a@b>"))
    extra = F.when(kind == 1, F.concat(F.lit(" branch:"), "o_orderpriority")).when(kind == 2, F.concat(F.lit(" committer:C <c@d> "), later, F.lit(" 9000"))).otherwise("")
    files = F.when(kind == 0, "").when(kind == 3, "\nz\na").otherwise("\na\nb")
    body = F.concat(F.lit("order "), word(k), F.lit("\n"), "o_orderpriority")
    own = F.when(kind == 1, F.concat(F.lit("odd "), word(F.col("o_custkey")))).otherwise(who)
    text = F.concat(F.sha1(F.concat(F.lit("m"), word(k))), F.lit("\n"), own, F.lit("\n"), at, F.lit(" -3600"), extra, files, F.lit("\n\n"), body)
    author = F.concat(who, F.lit(" "), at, F.lit(" +0100"))
    committer = F.when(kind == 2, F.concat(F.lit("C <c@d> "), later, F.lit(" -0230"))).otherwise(author)
    git, hg = (lambda c: F.sha1(F.concat(F.lit("g"), word(c)))), (lambda c: F.sha1(F.concat(F.lit("h"), word(c))))
    parents = F.when(k > 0, F.array(git(k - 1))).otherwise(F.array().cast("array<string>"))
    commit = lambda b: changesets.commit_text(F.sha1(word(k)), parents, author, committer, b)
    rows = load(spark, d, "orders").select(
        k.alias("rev"),
        git(k).alias("oid"),
        hg(k).alias("hg"),
        text.alias("text"),
        F.when(k > 0, hg(k - 1)).alias("p1"),
        commit(F.concat(body, F.when(kind == 3, " é").when(kind == 4, "\x00\x00").otherwise(""))).alias("raw"),
        commit(F.concat(body, F.when(kind == 3, " é").otherwise(""))).alias("written"),
    )
    return rows.withColumn("node", node_hash(F.col("p1"), none, F.col("text")))


@query(f"""WITH {CHANGESET_SQL} SELECT rev, sha1(text) AS digest, true AS fits, author_noted, extra_noted, replace(files, chr(10), ' ') AS files_noted, kind = 3 AS patched FROM t""")
def changeset_rebuild(spark, d):
    """Notes written of all changesets, and changesets put together from these and their commits."""
    rows = _changesets(spark, d)
    notes = scratch.cut(rebuild.notes_for(rows.select("oid", F.col("written").alias("raw"), "node", "text")))
    # a commit's parents need an identifier only where its text ends in NULs
    made = rebuild.rebuilt(rows.select("oid", "raw"), notes, rows.select(F.col("oid").alias("git"), "hg"))
    field = lambda k: F.try_element_at(changesets.parse_note(F.col("note")), F.lit(k))
    none = F.lit(None).cast("string")
    met = rows.select("rev", "oid", "p1", F.col("node").alias("own")).join(made, "oid").join(notes.select("oid", "note"), "oid")
    return met.select(
        "rev",
        F.sha1("text").alias("digest"),
        (node_hash(F.col("p1"), none, F.col("text")) == F.col("own")).alias("fits"),
        field("author").alias("author_noted"),
        field("extra").alias("extra_noted"),
        F.replace(field("files"), F.lit("\x00"), F.lit(" ")).alias("files_noted"),
        field("patch").isNotNull().alias("patched"),
    )


@query(f"""WITH {CHANGESET_SQL} SELECT rev, CASE WHEN rev % 7 = 0 THEN sha1('h' || rev) END AS hg, CASE WHEN rev % 7 = 0 THEN sha1(text) END AS digest FROM t WHERE rev % 7 < 2""")
def changeset_dump(spark, d):
    """Whole changesets asked for by abbreviations, half of which name none."""
    rows = _changesets(spark, d)
    notes = rebuild.notes_for(rows.select("oid", F.col("written").alias("raw"), "node", "text"))
    known = rows.select(F.col("oid").alias("git"), "hg")
    k = F.col("rev")
    wanted = rows.where(k % 7 < 2).select("rev", F.substring(F.when(k % 7 == 0, F.upper("hg")).otherwise(F.sha1(F.concat(F.lit("none"), k.cast("string")))), 1, 14).alias("abbrev"))
    return rebuild.dump(wanted, known, rows.select("oid", "raw"), notes).select("rev", "hg", F.sha1("text").alias("digest"))


@query("SELECT o_custkey, string_agg(CASE WHEN o_orderkey % 2 = 0 THEN '1' ELSE '0' END, '' ORDER BY o_orderkey) AS answer FROM orders GROUP BY o_custkey")
def known_nodes(spark, d):
    """What a repository with every other node answers to each customer's request."""
    n = views.nodes(spark, d)
    asked = load(spark, d, "orders").select("o_custkey", "o_orderkey", F.sha1(F.col("o_orderkey").cast("string")).alias("node"))
    return peer.known_answers(asked, n.where("rev % 2 = 0"), "o_custkey", "o_orderkey")


@query(f"""WITH {DAG_SQL} SELECT node AS key, '1' AS value FROM nodes WHERE closed AND rev NOT IN (SELECT child FROM edges WHERE parent IN (SELECT rev FROM nodes WHERE closed))
  UNION ALL SELECT 'publishing', 'True'""")
def phase_listing(spark, d):
    n, e = views.graph(spark, d)
    return peer.phase_keys(n, e, n.where("closed"))


@query(f"""WITH RECURSIVE {DAG_SQL}, a AS (SELECT rev FROM nodes WHERE closed UNION SELECT e.child FROM a JOIN edges e ON e.parent = a.rev) SELECT rev FROM a""")
def phases_read(spark, d):
    """The drafts that a listing of draft roots tells of."""
    n, e = views.graph(spark, d)
    e = scratch.cut(e)  # read for the roots and for the sweep
    return peer.drafts_of(peer.phase_keys(n, e, n.where("closed")), n, e)


@query("""WITH h AS (SELECT o_custkey, string_agg(sha1(CAST(o_orderkey AS VARCHAR)), ' ' ORDER BY sha1(CAST(o_orderkey AS VARCHAR))) AS listed FROM orders GROUP BY o_custkey)
  SELECT o_custkey, CASE o_custkey % 4 WHEN 0 THEN '666f726365' WHEN 1 THEN listed ELSE '686173686564 ' || sha1(unhex(replace(listed, ' ', ''))) END AS claim,
    o_custkey % 4 = 0 OR o_custkey % 8 < 5 AS accepted FROM h""")
def push_claims(spark, d):
    """Claims of pushes by force, by heads and by their digest; repositories with some of them have had another head since."""
    k = F.col("o_custkey")
    heads = load(spark, d, "orders").select(k, F.sha1(F.col("o_orderkey").cast("string")).alias("node"))
    pushes = heads.select(k).distinct().withColumn("force", k % 4 == 0).withColumn("hashed", k % 4 > 1)
    now = heads.unionByName(heads.where(k % 8 >= 5).select(k, F.sha1(F.concat(F.lit("new"), k.cast("string"))).alias("node")))
    return peer.accepted(peer.push_claims(heads, pushes, "o_custkey").select(k, "claim"), now, "o_custkey")


@query("""WITH l AS (SELECT p_size, p_partkey, p_partkey % 8 AS kind FROM part)
  SELECT p_size, arg_min(CASE kind WHEN 5 THEN 'https://h/' WHEN 6 THEN 'HTTP://h/' ELSE 'http://h/' END || p_partkey, p_partkey) AS url,
    arg_min(CASE kind WHEN 5 THEN 'zstd-v2' WHEN 6 THEN 'none-v1' ELSE 'gzip-v2' END, p_partkey) AS spec FROM l WHERE kind >= 5 GROUP BY p_size""")
def bundle_lists(spark, d):
    """The first bundle of each list that can be used: others are streams, of unknown or no kind, out of form, or not to be fetched by http."""
    k = F.col("p_partkey")
    at = k.cast("string")
    forms = ["ftp://h/{} BUNDLESPEC=none-v1", "https://h/{} BUNDLESPEC=none-v2;stream=v2", "https://h/{} BUNDLESPEC=lzma-v2", "https://h/{}", "https://h/{}  BUNDLESPEC=none-v1",
             "https://h/{} BUNDLESPEC=raw BUNDLESPEC=zstd-v2;a=b REQUIRESNI=true", "HTTP://h/{} x=50%2525 BUNDLESPEC=none%2Dv1", "http://h/{} BUNDLE%53PEC=gzip-v2"]
    line = F.coalesce(*[F.when(k % 8 == n, F.concat(F.lit(a), at, F.lit(b))) for n, (a, b) in enumerate(f.split("{}") for f in forms)])
    return peer.first_bundle(load(spark, d, "part").select("p_size", k.alias("place"), line.alias("line")), "p_size")


@query("""SELECT c_custkey, sha1('x' || c_custkey) AS oid, CASE c_custkey % 6 WHEN 0 THEN 'r' || c_custkey WHEN 1 THEN 'refs/meta/r' || c_custkey WHEN 2 THEN 'refs/heads/n' || c_nationkey || '/r' || c_custkey
    WHEN 3 THEN 'refs/meta/h.org/n' || c_nationkey || '/r' || c_custkey WHEN 4 THEN 'refs/heads/metadata' ELSE 'refs/meta/asked' END AS name, c_custkey % 7 = 3 AS invalid FROM customer WHERE c_custkey % 11 <> 5""")
def prepared_source(spark, d):
    """The reference with the metadata for each address, read from a bundle's header, where it is not the only one; and whether it is what it should be."""
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    repo, word = F.concat(F.lit("r"), k.cast("string")), F.col("c_custkey").cast("string")
    name = F.when(k % 6 == 0, repo).when(k % 6 == 1, F.concat(F.lit("refs/meta/"), repo)).when(k % 6 == 2, F.concat(F.lit("refs/heads/n"), n, F.lit("/"), repo))
    name = name.when(k % 6 == 3, F.concat(F.lit("refs/meta/h.org/n"), n, F.lit("/"), repo)).when(k % 6 == 4, "refs/heads/metadata").otherwise("refs/meta/asked")
    oid, other = F.sha1(F.concat(F.lit("x"), word)), F.sha1(F.concat(F.lit("y"), word))
    later = F.concat(other, F.lit(" refs/heads/other\n"), other, F.when(k % 6 < 4, " refs/meta/metadata\n").otherwise(" refs/heads/more\n"))
    head = F.concat(F.when(k % 11 == 5, "# another\n").otherwise("# v2 git bundle\n"), later, oid, F.lit(" "), name, F.lit("\n\nPACK"))
    rows = load(spark, d, "customer").select(k, F.concat(F.lit("https://h.org/n"), n, F.lit("/"), repo).alias("url"), F.when(k % 6 == 5, "asked").alias("branch"), oid.alias("oid"), head.alias("head"))
    refs = rows.select(k, F.explode(peer.bundle_refs(F.col("head"))).alias("r")).select("c_custkey", "r.oid", "r.name")
    found = peer.prepared_refs(rows.select(k, "url", "branch"), refs, "c_custkey", "refs/meta/")
    who = F.lit("tool <tool@git> 0 +0000")
    content = changesets.commit_text(F.sha1(word), F.array().cast("array<string>"), who, who, F.when(k % 7 == 3, "files-meta").otherwise("unified-manifests-v2\nfiles-meta\n"))
    wrong = peer.invalid_prepared(found, rows.select("oid", F.lit("commit").alias("kind"), content.alias("content")), "tool@git").select(k, F.lit(True).alias("invalid"))
    return found.join(wrong, "c_custkey", "left").withColumn("invalid", F.coalesce("invalid", F.lit(False)))


@query("""SELECT sha1('r' || s_suppkey) AS oid, CASE WHEN s_suppkey % 3 = 1 THEN 'refs/x/' || s_suppkey END AS fetched, 'refs/replace/' || sha1('o' || s_suppkey) AS ref FROM supplier WHERE s_suppkey % 3 > 0""")
def replacements_needed(spark, d):
    k = F.col("s_suppkey")
    of = lambda c: F.sha1(F.concat(F.lit(c), k.cast("string")))
    rows = load(spark, d, "supplier").select(k, of("o").alias("path"), of("r").alias("oid"), F.concat(F.lit("refs/x/"), k.cast("string")).alias("name"), F.lit("commit").alias("kind"))
    twice = rows.where(k % 3 == 1).unionByName(rows.where(k % 3 == 1).withColumn("name", F.concat(F.lit("refs/y/"), "path")))
    return peer.replacements_needed(rows.select("path", "oid"), rows.where(k % 3 == 0), twice)


@query("SELECT 'changesets' AS name, count(*) AS n, sum(o_orderkey)::BIGINT AS total FROM orders UNION ALL SELECT 'heads', count(*), sum(c_custkey)::BIGINT FROM customer")
def prepared_adopt(spark, d):
    """An empty store begun with a prepared one's snapshot, made of several segments; one that is not empty refuses."""
    o = load(spark, d, "orders").select(F.col("o_orderkey").alias("rev"))
    source, empty = Store(spark, scratch.folder(spark, "source")), Store(spark, scratch.folder(spark, "store"))
    for part in (0, 1):
        session = source.begin()
        session.append("changesets", o.where(F.col("rev") % 2 == part))
        session.replace("heads", load(spark, d, "customer").where(f"{part} = 1 OR c_custkey % 2 = 0").select(F.col("c_custkey").alias("rev")))
        session.commit()
    peer.adopt(empty, source)
    try:
        peer.adopt(empty, source)
    except ValueError:
        state = empty.current()
        tables = [state.table(n).select(F.lit(n).alias("name"), "rev") for n in ("changesets", "heads")]
        return tables[0].unionByName(tables[1]).groupBy("name").agg(F.count("*").alias("n"), F.sum("rev").alias("total"))
    raise AssertionError("a store that is not empty was begun again")


@query("""SELECT DISTINCT sha1(encode('blob ' || octet_length(encode(coalesce(text, '')))) || '\\x00'::BLOB || encode(coalesce(text, ''))) AS oid, 'blob' AS kind, octet_length(encode(coalesce(text, ''))) AS size FROM documents""")
def added_objects(spark, d):
    """Documents as objects, of which half are held already, and each is offered twice."""
    docs = load(spark, d, "documents").select("doc_id", F.lit("blob").alias("kind"), F.col("text").alias("content"))
    offered = docs.select("kind", "content")
    none = spark.createDataFrame([], "oid string, kind string, content binary")
    held = store.added_objects(none, docs.where("doc_id % 2 = 0").select("kind", "content"))
    return store.added_objects(held, offered.unionAll(offered)).select("oid", "kind", F.octet_length("content").cast("long").alias("size"))


@query("""SELECT DISTINCT rev, sha1('m' || p) AS node FROM (SELECT o_orderkey AS rev, o_custkey AS p FROM orders WHERE o_orderkey % 4 > 0 UNION ALL SELECT o_orderkey, o_orderkey % 3 FROM orders WHERE o_orderkey % 4 > 1)""")
def manifest_heads_read(spark, d):
    """Heads of manifests as the parents of a snapshot's commit, none, one, or two that may be one."""
    k = F.col("o_orderkey")
    of = lambda c: F.sha1(F.concat(F.lit("m"), c.cast("string")))
    parents = F.slice(F.array(of(F.col("o_custkey")), of(k % 3)), F.lit(1), F.least(F.lit(2), k % 4).cast("int"))
    raw = changesets.commit_text(F.sha1(k.cast("string")), parents, F.lit("a <a@b> 0 +0000"), F.lit("a <a@b> 0 +0000"), F.lit(""))
    return store.manifest_heads(load(spark, d, "orders").select(k.alias("rev"), raw.alias("raw")), "rev", "raw")


@query("""SELECT s.size, least(s.size, count(*)) AS n, least(s.size, count(*)) AS different, true AS ours FROM orders, (VALUES (100), (10000)) s(size) GROUP BY s.size""")
def discovery_sample(spark, d):
    """Nodes drawn for one round of discovery, as many as the connection takes."""
    n = views.nodes(spark, d).select("rev", "node")
    sizes = load(spark, d, "nation").where("n_nationkey < 2").select(
        peer.sample_size(F.create_map(F.lit("lookup"), F.lit("")), F.col("n_nationkey") == 1).alias("size")
    )
    parts = []
    for (size,) in sizes.collect():  # one for each kind of connection
        drawn = ordering.sample_of(n, "node", size).join(n.withColumn("ours", F.lit(True)), ["rev", "node"], "left")
        parts.append(drawn.agg(F.count("*").alias("n"), F.countDistinct("node").alias("different"), F.every(F.coalesce("ours", F.lit(False))).alias("ours")).select(F.lit(size).alias("size"), "n", "different", "ours"))
    return parts[0].unionByName(parts[1])
