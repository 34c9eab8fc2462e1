"""Stored digests of directories: trees are compared from the root down, and what is equal is not read.

A directory's digest is made of its files' values and its directories' digests. All digests of a set of trees are written once,
a partition for each depth; the entries are written beside them, in buckets by directory. A comparison joins one depth after
the other, only below directories that differ, and reads the buckets of those directories only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revstrata.operators import scratch
from revstrata.operators.paths import diff

#: Buckets of directories that entries are written in.
BUCKETS = 64


def _folder(path: str) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def _depth(folder: Column) -> Column:
    """0 for the root, else the number of a directory's parts."""
    return F.when(folder == "", 0).otherwise(F.size(F.split(folder, "/")))


def _bucket(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys, "folder"), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True)
class Digests:
    """Digests and entries of trees in a folder."""

    spark: SparkSession
    home: str
    keys: list[str]
    value: str
    deepest: int
    schema: str

    def level(self, depth: int) -> DataFrame | None:
        """(keys, folder, above, digest) of the directories at a depth."""
        path = f"{self.home}/digests/depth={depth}"
        return self.spark.read.parquet(path) if scratch.exists(self.spark, path) else None

    def entries(self, buckets: list[int] | None = None) -> DataFrame:
        """(keys, path, folder, value, bucket), of some buckets or of all."""
        rows = self.spark.read.schema(f"{self.schema}, bucket int").parquet(f"{self.home}/entries")
        return rows if buckets is None else rows.where(F.col("bucket").isin(buckets))


def store(entries: DataFrame, keys: list[str], value: str, home: str | None = None) -> Digests:
    """Write the digests of all directories of ``entries`` (keys, path, value, also bytes); ``keys`` name the tree. Paths are unique in a tree."""
    spark = entries.sparkSession
    home = home or scratch.folder(spark, "digests")
    rows = entries.select(*keys, "path", _folder("path").alias("folder"), value)
    rows.withColumn("bucket", _bucket(keys)).repartition("bucket").write.partitionBy("bucket").parquet(f"{home}/entries")
    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes)
    held = Digests(spark, home, keys, value, 0, schema)
    what = F.hex(value) if dict(rows.dtypes)[value] == "binary" else F.col(value).cast("string")
    own = held.entries().select(*keys, "folder", F.lit("f").alias("kind"), F.col("path").alias("name"), what.alias("what"))
    deepest = own.agg(F.max(_depth(F.col("folder")))).first()[0]
    if deepest is None:
        return held
    sums = [F.sum(F.xxhash64("kind", "name", "what", F.lit(seed)).cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    below = None
    for depth in range(deepest, -1, -1):
        level = own.where(_depth(F.col("folder")) == depth)
        if below is not None:
            level = level.unionByName(below.select(*keys, F.col("above").alias("folder"), F.lit("d").alias("kind"), F.col("folder").alias("name"), F.col("digest").alias("what")))
        made = level.groupBy(*keys, "folder").agg(F.concat_ws(":", F.count("*").cast("string"), *sums).alias("digest"))
        above = F.when(F.contains("folder", F.lit("/")), _folder("folder")).otherwise("")
        made.select(*keys, "folder", F.when(F.col("folder") != "", above).alias("above"), "digest").write.parquet(f"{home}/digests/depth={depth}")
        below = held.level(depth)
    return Digests(spark, home, keys, value, deepest, schema)


def differing(left: Digests, right: Digests) -> DataFrame:
    """(keys, folder) of the directories that differ, or that one side lacks, found from the root down."""
    keys, none = left.keys, None
    changed, out = None, None
    for depth in range(max(left.deepest, right.deepest) + 1):
        sides = [x.level(depth) for x in (left, right)]
        if none is sides[0] and none is sides[1]:
            break
        other = next(s for s in sides if s is not None)
        sides = [other.limit(0) if s is None else s for s in sides]
        if changed is not None:
            above = changed.withColumnRenamed("folder", "above")
            sides = [s.join(above, [*keys, "above"], "left_semi") for s in sides]
        changed = scratch.cut(diff(sides[0], sides[1], [*keys, "folder"], "digest").select(*keys, "folder"))
        if changed.isEmpty():
            break
        out = changed if out is None else out.unionByName(changed)
    return out if out is not None else left.entries().select(*keys, "folder").limit(0)


def compare(left: Digests, right: Digests) -> DataFrame:
    """(keys, path, left, right) of the paths whose values differ; only buckets of directories that differ are read."""
    keys = left.keys
    changed = scratch.cut(differing(left, right).withColumn("bucket", _bucket(keys)))
    buckets = sorted(r.bucket for r in changed.select("bucket").distinct().collect())  # BUCKETS at most
    sides = [x.entries(buckets).join(changed, [*keys, "folder", "bucket"], "left_semi").select(*keys, "path", x.value) for x in (left, right)]
    return diff(sides[0], sides[1], [*keys, "path"], left.value)
