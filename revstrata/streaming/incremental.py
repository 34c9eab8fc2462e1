"""Incremental import: a stream of revision files into a table, without repeated keys.

The table is laid out in partitions by the hash of the key, so a batch is checked against the partitions of its own keys only,
and only the key column of these is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StructField, StructType

from revstrata.operators.scratch import exists

#: Partitions of the target.
PARTS = 256


def part_of(key: str, parts: int = PARTS) -> Column:
    """The partition of the target that holds a key."""
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def held_keys(spark: SparkSession, target: str, schema: StructType, key: str, parts: list[int]) -> DataFrame:
    """The keys in some partitions of the target; the others are not read."""
    rows = spark.read.schema(StructType([*schema.fields, StructField("part", IntegerType())])).parquet(target)
    return rows.where(F.col("part").isin(parts)).select(key, "part")


def follow(spark: SparkSession, folder: str, schema: StructType, target: str, checkpoint: str, key: str, parts: int = PARTS) -> StreamingQuery:
    """Appends new rows of the parquet files in ``folder`` to the table at ``target``; rows whose key it holds are left out.

    The target has one column more, ``part``. Each batch is checked against the target, so that a batch that runs again
    adds nothing; of rows of one key in a batch any one stays. Runs until what is there is done.
    """
    def take(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        new = batch.dropDuplicates([key]).withColumn("part", part_of(key, parts))
        if exists(session, target):
            asked = sorted(r.part for r in new.select("part").distinct().collect())  # PARTS at most
            new = new.join(held_keys(session, target, schema, key, asked), [key, "part"], "left_anti")
        new.select(*schema.names, "part").write.mode("append").partitionBy("part").parquet(target)

    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
