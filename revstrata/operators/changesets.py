"""Changesets and commits: their texts, notes of what a commit does not say, and which commit a changeset is grafted to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The keys of a note's lines, in the order in which they are written.
NOTE_KEYS = ("changeset", "manifest", "author", "extra", "files", "patch")


def changeset_text(manifest: Column, author: Column, date: Column, files: Column, body: Column) -> Column:
    """The raw text of a changeset: manifest, author, date, sorted files, an empty line, the body."""
    head = F.array_join(F.concat(F.array(manifest, author, date), F.array_sort(files)), "\n")
    return F.concat(head, F.lit("\n\n"), body)


def note_text(fields: dict[str, Column]) -> Column:
    """A note: ``key value`` lines in their fixed order, without those whose value is NULL."""
    return F.concat_ws("\n", *[F.concat(F.lit(f"{k} "), fields[k]) for k in NOTE_KEYS if k in fields])


def parse_note(note: Column) -> Column:
    """A note's fields as a map; NULL if any line has an unknown key or no value."""
    lines = F.split(note, "\n")
    known = F.forall(lines, lambda x: F.substring_index(x, " ", 1).isin(*NOTE_KEYS) & F.contains(x, F.lit(" ")))
    entries = F.transform(lines, lambda x: F.struct(F.substring_index(x, " ", 1).alias("key"), F.substring(x, F.instr(x, " ") + 1, F.length(x)).alias("value")))
    return F.when(known, F.map_from_entries(entries))


def differing(own: Column, implied: Column) -> Column:
    """What a note keeps of a field: its value where the commit implies another."""
    return F.when(~own.eqNullSafe(implied), own)


def commit_text(tree: Column, parents: Column, author: Column, committer: Column, body: Column) -> Column:
    """The raw text of a commit; ``author`` and ``committer`` are whole lines' values, ``parents`` is an array."""
    lines = F.concat(
        F.array(F.concat(F.lit("tree "), tree)),
        F.transform(parents, lambda p: F.concat(F.lit("parent "), p)),
        F.array(F.concat(F.lit("author "), author), F.concat(F.lit("committer "), committer)),
    )
    return F.concat(F.array_join(lines, "\n"), F.lit("\n\n"), body)


def spread_conflicts(commits: DataFrame, text: str = "text", order: str = "rev", filler: str = "\n") -> DataFrame:
    """``commits`` with fillers behind those texts that another commit has, so that all texts differ.

    A text with fewer fillers of its own comes first, then the one that is earlier in ``order``; each gets the
    least number of fillers, from its own on, that none before it has. NULL texts stay as they are.
    """
    stem = F.regexp_replace(text, f"{filler}+$", "") if filler == "\n" else F.rtrim(F.col(text), F.lit(filler))
    rows = commits.withColumn("_stem", stem).withColumn("_own", F.length(text) - F.length("_stem"))
    here = Window.partitionBy("_stem", F.when(F.col("_stem").isNull(), F.col(order))).orderBy("_own", order)
    number = F.row_number().over(here)
    placed = rows.withColumn("_n", number).withColumn("_slot", F.col("_n") + F.max(F.col("_own") - F.col("_n")).over(here))
    spread = F.when(F.col(text).isNotNull(), F.concat("_stem", F.repeat(F.lit(filler), F.col("_slot").cast("int"))))
    return placed.withColumn(text, spread).drop("_stem", "_own", "_n", "_slot")


def graft(changesets: DataFrame, commits: DataFrame, strict: bool = False) -> DataFrame:
    """(rev, commit, candidates) of each changeset (rev, tree, ts, parents, subject, author).

    Candidates are commits (commit, and the same columns, and ``own``: import would make just this commit) of the
    same tree and time, and with ``strict`` of the same parents. Of several, those with the same subject count if
    there is one of them; else those with the same subject and author, if there is one; of several left, one that
    is not ``own``. A commit goes to the first changeset that it fits; ``commit`` is NULL where there is none or no
    single one. Candidates are counted by key and never listed, so that a tree that many share costs no pairs.
    """
    keys = ["tree", "ts", *(["parents"] if strict else [])]
    levels = {"all": keys, "subject": [*keys, "subject"], "author": [*keys, "subject", "author"]}
    other = F.when(~F.coalesce("own", F.lit(False)), F.col("commit"))
    met = changesets
    for level, by in levels.items():
        counts = commits.groupBy(*by).agg(
            F.count("*").alias(f"{level}_n"), F.min("commit").alias(f"{level}_one"), F.count(other).alias(f"{level}_n2"), F.min(other).alias(f"{level}_one2")
        )
        met = met.join(counts, by, "left")
    n = {k: F.coalesce(f"{k}_n", F.lit(0)) for k in levels}
    level = F.when((n["all"] > 1) & (n["subject"] == 1), "subject").when((n["all"] > 1) & (n["subject"] > 1) & (n["author"] == 1), "author").otherwise("all")
    found = met.withColumn("_level", level)
    of = lambda what: F.coalesce(*[F.when(F.col("_level") == k, F.col(f"{k}_{what}")) for k in levels])
    found = found.withColumn("_commit", F.when(of("n") == 1, of("one")).when(of("n2") == 1, of("one2")))
    apart = F.when(F.col("_commit").isNull(), F.col("rev"))  # unmatched changesets do not meet in one task
    first = F.row_number().over(Window.partitionBy("_commit", apart).orderBy("rev"))
    return found.withColumn("_first", F.when(F.col("_commit").isNotNull(), first)).select(
        "rev", F.when(F.col("_first") == 1, F.col("_commit")).alias("commit"), F.coalesce(of("n"), F.lit(0)).cast("long").alias("candidates")
    )


def replacement_of(ids: DataFrame, replaces: DataFrame, key: str) -> DataFrame:
    """``ids`` with ``key`` replaced where ``replaces`` (original, replacement) has another for it."""
    found = replaces.select(F.col("original").alias(key), "replacement")
    return ids.join(found, key, "left").withColumn(key, F.coalesce("replacement", key)).drop("replacement")
