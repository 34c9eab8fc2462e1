"""What the operators of this package share: the shared folder, written tables, batches."""

from __future__ import annotations

import gc
import sys
import tempfile
import uuid

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ship(module: str) -> None:
    """Send a module's functions to the executors by value, so that workers need no path to this repository."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where that is unset (tests, local mode) a temporary one is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        held = spark.sparkContext.getCheckpointDir()
        if not held:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="revstrata-"))
            held = spark.sparkContext.getCheckpointDir()
        base = held
    return base.rstrip("/")


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/revstrata/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` as a table in the shared folder, read back: a cut of lineage that survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of plans that nothing refers to any more, before the next round writes more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the session's Arrow batches to ``rows``, unless they are smaller: a batch of long texts is held several times over."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(name, rows)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder through Spark's own file system classes."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def fold_of(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 4; 2 is the held-out part."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def code_points(text: str) -> np.ndarray:
    """The code points of a text as uint32; lone surrogates are kept as they are."""
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64 over a uint64 array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
