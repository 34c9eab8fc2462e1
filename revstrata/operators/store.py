"""The store of a repository's metadata: typed sets, notes, heads, replacements, references and the pointer to its present state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revstrata.functions.identity import object_id
from revstrata.operators import mapping, objects, snapshots

#: The kinds of entries, and the kind of object that each points to.
ENTRY_KINDS = {"changeset": "commit", "changeset-note": "blob", "manifest": "commit", "file": "blob", "file-header": "blob"}


def set_typed(store: DataFrame, changes: DataFrame, objects: DataFrame) -> DataFrame:
    """``store`` (kind, id, oid) after changes of the same columns: a NULL oid removes.

    A kind that is unknown, or an object (oid, kind) that is not there or of another kind than the entry's, is an error.
    """
    pairs = [F.lit(x) for kv in ENTRY_KINDS.items() for x in kv]
    wanted = F.create_map(*pairs)[F.col("kind")]
    met = changes.select("kind", "id", "oid").join(objects.select("oid", F.col("kind").alias("_is")), "oid", "left")
    wrong = wanted.isNull() | (F.col("oid").isNotNull() & ~F.col("_is").eqNullSafe(wanted))
    checked = met.withColumn("oid", F.when(wrong, F.raise_error(F.concat(F.lit("invalid object for "), "kind", F.lit(" "), "id")).cast("string")).otherwise(F.col("oid")))
    kept = store.select("kind", "id", "oid").join(changes.select("kind", "id"), ["kind", "id"], "left_anti")
    return kept.unionByName(checked.where(F.col("oid").isNotNull()).select("kind", "id", "oid"))


def written_notes(base: DataFrame, changes: DataFrame, key: str, value: str) -> tuple[DataFrame, bool]:
    """``base`` with changes laid over it, and whether that makes any difference; ``base`` itself, if not."""
    held = changes.join(base.select(key, F.col(value).alias("_held")), key, "left")
    if held.where(~F.col(value).eqNullSafe(F.col("_held"))).isEmpty():
        return base, False
    return mapping.overlay(base, changes, key, value), True


def heads_text(heads: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, text): a snapshot's heads (keys, rev, node, branch) as lines ``node branch`` in order of rev."""
    line = F.concat("node", F.lit(" "), "branch")
    rows = heads.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("rev", line.alias("line")))).alias("_l"))
    return rows.select(*keys, F.array_join("_l.line", "\n").alias("text"))


def heads_of_text(text: Column) -> Column:
    """The heads of :func:`heads_text` as an array of (node, branch); a line without a branch is an error."""
    lines = F.filter(F.split(text, "\n"), lambda x: x != "")
    node = lambda x: F.when(F.contains(x, F.lit(" ")), F.substring_index(x, " ", 1)).otherwise(F.raise_error(F.lit("a head has no branch")).cast("string"))
    return F.transform(lines, lambda x: F.struct(node(x).alias("node"), F.substring(x, F.instr(x, " ") + 1, F.length(x)).alias("branch")))


def manifest_heads(commits: DataFrame, key: str, raw: str) -> DataFrame:
    """(key, node): the heads of a snapshot's manifests, which are the distinct parents of its commit (key, raw); a commit that cannot be read is an error."""
    parents = objects.parse_commit(F.col(raw))["parents"]
    read = F.when(parents.isNull(), F.raise_error(F.concat(F.lit("no commit: "), F.col(key).cast("string"))).cast("array<string>")).otherwise(parents)
    return commits.select(key, F.explode(F.array_distinct(read)).alias("node"))


def added_objects(held: DataFrame, new: DataFrame) -> DataFrame:
    """(oid, kind, content): ``held`` of these columns with ``new`` (kind, content), each object once, under the hash of its kind and content.

    What is held already is not written again; a kind other than commit, tree and blob is an error.
    """
    kind = F.when(F.col("kind").isin("commit", "tree", "blob"), F.col("kind")).otherwise(F.raise_error(F.concat(F.lit("no kind of object: "), "kind")).cast("string"))
    named = new.select(kind.alias("kind"), F.coalesce(F.col("content").cast("binary"), F.lit("").cast("binary")).alias("content"))
    named = named.withColumn("oid", object_id(F.col("kind"), F.col("content")))
    once = named.groupBy("oid").agg(F.first("kind").alias("kind"), F.first("content").alias("content"))
    return mapping.put_if_absent(held.select("oid", "kind", F.col("content").cast("binary").alias("content")), once, "oid")


def refs_under(refs: DataFrame, objects: DataFrame, prefix: str) -> DataFrame:
    """(name, oid) of the references under a prefix that point to commits of ``objects`` (oid, kind)."""
    commits = objects.where("kind = 'commit'").select("oid")
    return refs.where(F.startswith(F.col("name"), F.lit(prefix))).join(commits, "oid", "left_semi").select("name", "oid")


def remotes(config: DataFrame) -> DataFrame:
    """(remote, url) of the settings (key, value) ``remote.NAME.url``; of several the last in ``place`` counts."""
    name = F.regexp_extract("key", r"^remote\.(.+)\.url$", 1)
    return config.withColumn("remote", name).where("remote <> ''").groupBy("remote").agg(F.max_by("value", "place").alias("url"))


def setting(config: DataFrame, wanted: DataFrame, product: str) -> DataFrame:
    """``wanted`` (name, remote) with ``value``: of the environment, else of the remote's setting, else of the product's.

    ``config`` has (source, key, value): source ``env`` for variables (PRODUCT_NAME in capitals), ``file`` for settings
    (``remote.REMOTE.product-NAME`` and ``product.NAME``).
    """
    variable = F.concat(F.lit(product.upper() + "_"), F.upper(F.replace(F.col("name"), F.lit("-"), F.lit("_"))))
    keys = {
        "_env": ("env", variable),
        "_remote": ("file", F.concat(F.lit("remote."), F.col("remote"), F.lit(f".{product}-"), F.col("name"))),
        "_plain": ("file", F.concat(F.lit(f"{product}."), F.col("name"))),
    }
    met = wanted
    for at, (source, key) in keys.items():
        held = config.where(F.col("source") == source).select(F.col("key").alias(f"{at}_key"), F.col("value").alias(at))
        met = met.withColumn(f"{at}_key", key).join(held, f"{at}_key", "left").drop(f"{at}_key")
    return met.withColumn("value", F.coalesce(*keys)).drop(*keys)


def replacements(rows: DataFrame) -> DataFrame:
    """(original, replacement) of a stored map: a replacement by itself is left out, one original twice is an error."""
    kept = rows.where(F.col("original") != F.col("replacement"))
    counted = kept.groupBy("original").agg(F.count("*").alias("_n"), F.min("replacement").alias("replacement"))
    once = F.when(F.col("_n") > 1, F.raise_error(F.concat(F.lit("duplicate replacement of "), "original")).cast("string")).otherwise(F.col("replacement"))
    return counted.select("original", once.alias("replacement"))


def moved_pointer(rows: DataFrame, current: str | None, target: str | None, status: str = "") -> tuple[DataFrame, str | None]:
    """``rows`` (snapshot_id, prev_id, status, components) and the pointer after a move to ``target``.

    The target must be an ancestor of the current snapshot, the current one itself, or none. A status of ``checked`` or
    ``broken`` is noted on the target; else it keeps its own.
    """
    if status not in ("", "checked", "broken"):
        raise ValueError(f"no such status: {status}")
    there = target if current is None and target is None else snapshots.rollback(rows, current, target)
    if target is not None and status:
        rows = rows.withColumn("status", F.when(F.col("snapshot_id") == target, status).otherwise(F.col("status")))
    return rows, there
