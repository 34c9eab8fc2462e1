"""Reading the input tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table ``name`` of the directory ``sf_dir``, by Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
