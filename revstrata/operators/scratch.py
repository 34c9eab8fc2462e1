"""Written tables in the folder of ``spark.checkpoint.dir``: cuts of lineage that survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, or in a temporary one in local mode where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="revstrata-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/revstrata/{tag}-{uuid.uuid4().hex}"


def cut(df: DataFrame, tag: str = "table") -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = folder(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _path(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, store = _path(spark, path)
    return store.exists(target)


def drop(spark: SparkSession, path: str) -> None:
    target, store = _path(spark, path)
    store.delete(target, True)
