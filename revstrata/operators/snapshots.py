"""Snapshots of a store: a chain of component identifiers, a pointer, and status marks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revstrata.operators import dag


def add_snapshot(snapshots: DataFrame, current: str | None, components: list[str], snapshot_id: str) -> tuple[DataFrame, str]:
    """``snapshots`` (snapshot_id, prev_id, status, components) with a new one, and the pointer; unchanged if the components are."""
    same = snapshots.where((F.col("snapshot_id") == current) & (F.col("components") == F.array(*[F.lit(c) for c in components])))
    if current is not None and not same.isEmpty():
        return snapshots, current
    row = snapshots.sparkSession.range(1).select(
        F.lit(snapshot_id).alias("snapshot_id"), F.lit(current).cast("string").alias("prev_id"), F.lit("").alias("status"), F.array(*[F.lit(c) for c in components]).alias("components")
    )
    return snapshots.unionByName(row), snapshot_id


def walk(snapshots: DataFrame, start: DataFrame) -> DataFrame:
    """(snapshot_id, step) from the start back to the first snapshot."""
    links = snapshots.select(F.col("snapshot_id").alias("id"), F.col("prev_id").alias("prev"))
    return dag.linear_walk(links, start.select(F.col("snapshot_id").alias("id"))).select(F.col("id").alias("snapshot_id"), "step")


def candidates(snapshots: DataFrame, start: DataFrame) -> DataFrame:
    """Snapshots that can be rolled back to: the start's chain with status, nearest first."""
    return walk(snapshots, start).join(snapshots, "snapshot_id").select("snapshot_id", "step", "status")


def rollback(snapshots: DataFrame, current: str, target: str | None) -> str | None:
    """The pointer moved to an ancestor of the current snapshot, or to none; anything else is an error."""
    if target is None:
        return None
    start = snapshots.where(F.col("snapshot_id") == current).select("snapshot_id")
    if walk(snapshots, start).where(F.col("snapshot_id") == target).isEmpty():
        raise ValueError(f"{target} is not an ancestor of {current}")
    return target
