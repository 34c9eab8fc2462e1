"""What repositories say to each other: known nodes, phases, claims of a push, lists of bundles, and prepared snapshots to begin with."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revstrata.functions.identity import packed, unpacked
from revstrata.functions.text import metadata_branches
from revstrata.operators import dag
from revstrata.operators.objects import parse_commit
from revstrata.operators.refs import heads_digest
from revstrata.operators.session import Store
from revstrata.sources.bundle import SPECS

#: The first line of a bundle with references, and what a metadata commit's body says, in order.
SIGNATURE = "# v2 git bundle"
METADATA_WORDS = ["files-meta", "unified-manifests-v2"]
#: How many nodes are asked for at once, and over connections that take long arguments.
SAMPLE, LONG_SAMPLE = 100, 10_000


def known(asked: DataFrame, nodes: DataFrame) -> DataFrame:
    """``asked`` (node, ...) with ``known``: whether ``nodes`` has it. A NULL node is not known."""
    held = nodes.select("node", F.lit(True).alias("known")).distinct()
    return asked.join(held, "node", "left").withColumn("known", F.coalesce("known", F.lit(False)))


def known_answers(asked: DataFrame, nodes: DataFrame, request: str, place: str) -> DataFrame:
    """(request, answer): a ``1`` or ``0`` for each node of a request (as many as one request holds), in order of ``place``."""
    sign = F.struct(F.col(place).alias("at"), F.when(F.col("known"), "1").otherwise("0").alias("sign"))
    rows = known(asked, nodes).groupBy(request).agg(F.array_sort(F.collect_list(sign)).alias("_s"))
    return rows.select(request, F.array_join("_s.sign", "").alias("answer"))


def phase_keys(nodes: DataFrame, edges: DataFrame, drafts: DataFrame, publishing: bool = True) -> DataFrame:
    """(key, value) that a repository lists for phases: its draft roots by node as ``1``, and ``publishing``, if it is.

    ``nodes`` has (rev, node), ``drafts`` (rev). A draft with a draft parent is no root. Roots are found by revs alone; identifiers travel once, as bytes.
    """
    roots = dag.roots(nodes.select("rev").join(drafts.select("rev").distinct(), "rev", "left_semi"), edges)
    named = nodes.select("rev", packed(F.col("node")).alias("node")).join(roots, "rev", "left_semi")
    keys = named.select(unpacked(F.col("node")).alias("key"), F.lit("1").alias("value"))
    if publishing:
        keys = keys.unionByName(nodes.sparkSession.range(1).select(F.lit("publishing").alias("key"), F.lit("True").alias("value")))
    return keys


def drafts_of(keys: DataFrame, nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(rev) of the drafts that :func:`phase_keys` tell of: the roots and all their descendants."""
    listed = keys.where("key <> 'publishing' AND value = '1'").select(packed(F.col("key")).alias("node"))
    roots = nodes.select("rev", packed(F.col("node")).alias("node")).join(listed, "node", "left_semi").select("rev")
    return dag.descendants(nodes, edges, roots, known=True)


def push_claims(heads: DataFrame, pushes: DataFrame, key: str) -> DataFrame:
    """``pushes`` (key, force, hashed) with ``claim``, by which a repository tells whether others came first since ``heads`` (key, node) were seen.

    A forced push claims nothing. Else it is the digest of the distinct heads in order where ``hashed`` ones are understood, or these themselves.
    """
    listed = heads.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("node")), " ").alias("_listed"))  # a repository's heads go in one argument
    met = pushes.join(heads_digest(heads, [key]), key, "left").join(listed, key, "left")
    word = lambda text: text.encode().hex()
    digest = F.concat(F.lit(word("hashed") + " "), F.coalesce("digest", F.sha1(F.lit(""))))
    claim = F.when(F.col("force"), word("force")).when(F.col("hashed"), digest).otherwise(F.coalesce("_listed", F.lit("")))
    return met.withColumn("claim", claim).drop("digest", "_listed")


def accepted(claims: DataFrame, heads: DataFrame, key: str) -> DataFrame:
    """``claims`` (key, claim, ...) with ``accepted``: whether the repository's ``heads`` (key, node) are still those claimed."""
    forms = claims.select(key).distinct().select(key, F.explode(F.array(F.lit(True), F.lit(False))).alias("hashed"), F.lit(False).alias("force"))
    now = push_claims(heads, forms, key).select(key, F.col("claim"), F.lit(True).alias("_fits"))
    met = claims.join(now, [key, "claim"], "left")
    return met.withColumn("accepted", F.coalesce("_fits", F.col("claim") == "force".encode().hex(), F.lit(False))).drop("_fits")


def sample_size(capabilities: Column, local: Column) -> Column:
    """How many nodes a discovery asks for at once: more, if the peer runs as a process or takes arguments in a request's body."""
    return F.when(local | F.coalesce(F.map_contains_key(capabilities, "httppostargs"), F.lit(False)), LONG_SAMPLE).otherwise(SAMPLE)


def bundle_line(line: Column) -> Column:
    """STRUCT(url, spec) of ``url KEY=value ...`` in a list of bundles; NULL where the bundle cannot be used.

    The address must be http or https, all else ``KEY=value`` (escaped), BUNDLESPEC a known one, its parameters ``;key=value``
    without ``stream``. Of a repeated key the last counts.
    """
    words = F.split(line, " ")
    pairs = F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0)))
    plain = lambda x: F.coalesce(F.try_url_decode(F.replace(x, F.lit("+"), F.lit("%2B"))), x)
    of = F.filter(pairs, lambda p: plain(F.substring_index(p, "=", 1)) == "BUNDLESPEC")
    last = F.try_element_at(of, F.lit(-1))
    spec = F.split(plain(F.substring(last, F.instr(last, "=") + 1, F.length(last))), ";")
    name, params = F.get(spec, F.lit(0)), F.slice(spec, F.lit(2), F.greatest(F.size(spec) - 1, F.lit(0)))
    formed = F.forall(pairs, lambda p: F.contains(p, F.lit("="))) & F.forall(params, lambda p: F.contains(p, F.lit("=")) & (F.substring_index(p, "=", 1) != "stream"))
    usable = F.get(words, F.lit(0)).rlike(r"(?i)^https?://[^/?#\s]+") & formed & name.isin(*[s for s in SPECS if s != "raw"])
    return F.when(usable, F.struct(F.get(words, F.lit(0)).alias("url"), name.alias("spec")))


def first_bundle(lines: DataFrame, key: str) -> DataFrame:
    """(key, url, spec): the first usable line of each list (key, place, line)."""
    rows = lines.select(key, "place", bundle_line(F.col("line")).alias("_b")).where("_b IS NOT NULL")
    return rows.groupBy(key).agg(F.min_by("_b", "place").alias("_b")).select(key, "_b.*")


def bundle_refs(header: Column) -> Column:
    """ARRAY(STRUCT(oid, name)) of a bundle's header: a signature, ``oid name`` lines, an empty line; NULL for another header."""
    lines = F.split(F.substring_index(header, "\n\n", 1), "\n")
    rest = F.filter(F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0))), lambda x: x != "")
    sound = (F.get(lines, F.lit(0)) == SIGNATURE) & F.forall(rest, lambda x: x.rlike("^[0-9a-f]{40} ."))
    return F.when(sound, F.transform(rest, lambda x: F.struct(F.substring(x, 1, 40).alias("oid"), F.substring(x, F.lit(42), F.length(x)).alias("name"))))


def prepared_refs(sources: DataFrame, refs: DataFrame, key: str, prefix: str) -> DataFrame:
    """(key, name, oid): the reference that holds each source's metadata, among its ``refs`` (key, oid, name).

    ``sources`` has (key, url, branch): the branch that is asked for, or else the names that the address gives, nearest
    first. A name is looked for as it stands, under ``prefix``, and among branches, before the next is.
    """
    names = F.when(F.col("branch").isNotNull(), F.array("branch")).otherwise(metadata_branches(F.col("url")))
    forms = F.flatten(F.transform(names, lambda b: F.array(b, F.concat(F.lit(prefix), b), F.concat(F.lit("refs/heads/"), b))))
    tried = sources.select(key, F.posexplode(forms).alias("_rank", "name"))
    met = tried.join(refs.select(key, "name", "oid"), [key, "name"])
    return met.groupBy(key).agg(F.min_by(F.struct("name", "oid"), "_rank").alias("_r")).select(key, "_r.name", "_r.oid")


def invalid_prepared(found: DataFrame, objects: DataFrame, author: str) -> DataFrame:
    """``found`` (oid, ...) that is no metadata of this kind: no commit of ``objects`` (oid, kind, content), not by ``author``, or with another body."""
    commits = objects.where("kind = 'commit'").select("oid", parse_commit(F.col("content").cast("string")).alias("_c"))
    words = F.array_sort(F.filter(F.split("_c.body", r"[ \t\n\f\r]+"), lambda w: w != ""))
    sound = F.coalesce(F.contains("_c.author", F.lit(author)) & (words == F.array(*[F.lit(w) for w in METADATA_WORDS])), F.lit(False))
    return found.join(commits, "oid", "left").where(~sound).drop("_c")


def replacements_needed(entries: DataFrame, objects: DataFrame, refs: DataFrame, prefix: str = "refs/replace/") -> DataFrame:
    """(oid, fetched, ref) of replacement commits (path, oid) that ``objects`` lacks: which of ``refs`` brings each, and its name here.

    A commit that no reference brings has a NULL in ``fetched``: the source is broken. Of several references the first by name is taken.
    """
    lacking = entries.select("path", "oid").join(objects.where("kind = 'commit'").select("oid"), "oid", "left_anti")
    by = refs.groupBy("oid").agg(F.min("name").alias("fetched"))
    return lacking.join(by, "oid", "left").select("oid", "fetched", F.concat(F.lit(prefix), "path").alias("ref"))


def adopt(store: Store, source: Store, snapshot_id: str | None = None) -> str | None:
    """Begin an empty store with a prepared one's snapshot (its present one, if none is named); an error if the store is not empty.

    Every table is copied by one job as one segment; the pointer is moved last, so a copy that dies leaves an empty store.
    """
    session = store.begin()
    if session.base.snapshot_id is not None:
        raise ValueError("only an empty store can begin with a prepared snapshot")
    state = source.at(snapshot_id) if snapshot_id else source.current()
    for name in sorted(state.tables):
        session.append(name, state.table(name))
    return session.commit()
