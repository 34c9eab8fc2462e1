"""Identifier maps: lookups, abbreviations, and key-value overlays with deletions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revstrata.functions.identity import NULL_ID, shared_prefix


def lookup(wanted: DataFrame, mapping: DataFrame, key: str, value: str) -> DataFrame:
    """``wanted`` with the mapped value; NULL where the key is unknown."""
    return wanted.join(mapping.select(key, value), key, "left")


def convert(wanted: DataFrame, mapping: DataFrame, key: str, value: str, abbrev: int = 40) -> DataFrame:
    """Batch conversion: the value's first ``abbrev`` nibbles, zeroes for unknown keys."""
    return lookup(wanted, mapping, key, value).withColumn(value, F.substring(F.coalesce(value, F.lit(NULL_ID)), 1, abbrev))


def resolve_abbreviations(prefixes: DataFrame, mapping: DataFrame, prefix: str, key: str, value: str) -> DataFrame:
    """(prefix, key, value) of abbreviations that fit exactly one key; NULLs for those that fit none or more.

    Keys are counted by their beginnings of the lengths that abbreviations have (41 at most), kept to those that are asked
    for, and joined by equality: the work is the keys times the lengths, however many keys a short abbreviation fits.
    """
    asked = prefixes.select(F.lower(F.col(prefix)).alias("_at")).where("_at IS NOT NULL").distinct()
    lengths = sorted(r[0] for r in asked.select(F.length("_at")).distinct().collect() if r[0] <= 40)
    if not lengths:
        return prefixes.select(prefix, *[c for c in prefixes.columns if c != prefix], F.lit(None).cast("string").alias(key), F.lit(None).cast(dict(mapping.dtypes)[value]).alias(value))
    begun = mapping.select(key, value, F.explode(F.transform(F.array(*[F.lit(n) for n in lengths]), lambda n: F.substring(F.col(key), F.lit(1), n))).alias("_at"))
    fits = begun.join(asked, "_at", "left_semi").groupBy("_at").agg(F.count("*").alias("_n"), F.min(key).alias(key), F.min_by(value, key).alias(value))
    rows = prefixes.withColumn("_at", F.lower(F.col(prefix)))
    return rows.join(fits.where("_n = 1").drop("_n"), "_at", "left").drop("_at")


def shortest_abbreviations(ids: DataFrame, key: str, least: int = 4) -> DataFrame:
    """(key, length): how many nibbles name each identifier, at least ``least``.

    Neighbours in order decide. Windows run over leading nibbles; a bucket's first and last identifier can share
    no more with other buckets than those nibbles, which ``least`` must exceed.
    """
    if least <= 1:
        raise ValueError("least must be over 1")
    rows = ids.select(key).distinct().withColumn("_at", F.substring(key, 1, min(3, least - 1)))
    order = Window.partitionBy("_at").orderBy(key)
    near = F.greatest(shared_prefix(F.col(key), F.lag(key).over(order)), shared_prefix(F.col(key), F.lead(key).over(order)))
    return rows.select(key, F.greatest(F.lit(least), F.least(F.lit(40), near + 1)).alias("length"))


def put_if_absent(base: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``base`` with those new rows whose key it lacks."""
    return base.unionByName(new.join(base.select(key), key, "left_anti"))


def overlay(base: DataFrame, changes: DataFrame, key: str, value: str) -> DataFrame:
    """``base`` with changes laid over it: a change's value replaces the base's, and a NULL removes the key."""
    over = changes.select(key, F.col(value).alias("_new"), F.lit(True).alias("_changed"))
    both = base.select(key, value).join(over, key, "full_outer")
    return both.withColumn(value, F.when(F.col("_changed"), F.col("_new")).otherwise(F.col(value))).where(F.col(value).isNotNull()).select(key, value)


def dangling(mapping: DataFrame, seen: list[DataFrame], key: str) -> DataFrame:
    """Keys of ``mapping`` that none of the tables has."""
    used = seen[0].select(key)
    for s in seen[1:]:
        used = used.unionByName(s.select(key))
    return mapping.select(key).join(used, key, "left_anti")
