"""Tag histories: what a file of tag lines says, and how the files of several heads merge."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revstrata.shipping import ship

#: Ranks of heads that are compared with the one before together.
STRETCH = 4096


def tags_in_file(lines: DataFrame, file: str = "file", tag: str = "tag", line: str = "line", node: str = "node") -> DataFrame:
    """(file, tag, node, hist): the last line of a tag counts, hist is the distinct nodes of all lines before it.

    A NULL node marks a deleted tag.
    """
    marked = F.coalesce(node, F.lit(""))
    nodes = lines.groupBy(file, tag, marked.alias("_node")).agg(F.min(line).alias("_first"), F.max(line).alias("_last"))  # so a row holds distinct nodes only
    rows = nodes.groupBy(file, tag).agg(F.max_by("_node", "_last").alias("node"), F.max("_last").alias("_end"), F.collect_list(F.struct("_node", "_first")).alias("_l"))
    before = F.filter("_l", lambda x: x["_first"] < F.col("_end"))
    return rows.select(file, tag, "node", F.array_sort(F.transform(before, lambda x: x["_node"])).alias("hist"))


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a tag of rows (tag, node, hist) in order: what is held stays only if the newcomer is in its history and it is not in the newcomer's, or has the longer one."""
    start = object()
    tag, held, hist, out = start, "", set(), []

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.string()), pa.array([r[1] for r in out], pa.string()), pa.array([r[2] for r in out], pa.list_(pa.string()))], names=["tag", "node", "hist"])

    for batch in batches:
        for now, node, came in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if now != tag:
                if tag is not start:
                    out.append((tag, held, sorted(hist)))
                tag, held, hist = now, node, set(came)
                continue
            keep = node != held and node in hist and (held not in came or len(hist) > len(came))
            held = held if keep else node
            hist.update(came)
        yield rows()
        out.clear()
    if tag is not start:
        out.append((tag, held, sorted(hist)))
        yield rows()


def merged(per_head: DataFrame, rank: str = "rank", tag: str = "tag") -> DataFrame:
    """(tag, node, hist) over the heads' tags in order of ``rank``; an empty node is a deleted tag, which still counts in the fold.

    Heads that say what the one before says change nothing and go first, in stretches of ranks. What is left of a tag is sorted
    and streamed through one task, which holds the tag's node and its history, however many heads there are. Histories are
    distinct nodes. Of equal ranks the lesser node comes first.
    """
    order = [F.col(rank).asc_nulls_first(), F.col("node").asc_nulls_first(), F.col("hist").asc_nulls_first()]
    stretch = Window.partitionBy(tag, F.floor(F.col(rank) / STRETCH)).orderBy(*order)
    said = F.struct("node", "hist")
    rows = per_head.select(F.col(tag).cast("string").alias(tag), rank, "node", "hist").withColumn("_same", said.eqNullSafe(F.lag(said).over(stretch)))
    kept = rows.where(~F.col("_same")).repartition(tag).sortWithinPartitions(tag, *order).select(tag, "node", "hist")
    return kept.mapInArrow(_folded, "tag string, node string, hist array<string>").select(F.col("tag").alias(tag), "node", "hist")


def live(tags: DataFrame) -> DataFrame:
    """Tags that are not deleted."""
    return tags.where(F.col("node") != "")


def first_files(head_files: DataFrame) -> DataFrame:
    """(rank, blob): each distinct file of (rank, blob) once, where the first head has it."""
    return head_files.groupBy("blob").agg(F.min("rank").alias("rank")).select("rank", "blob")


def tag_lines_for(current: DataFrame, updates: DataFrame) -> DataFrame:
    """(tag, line, node) to append to a tag file for updates (tag, node): what the tag was, if it was, then what it is.

    An empty node deletes the tag. Updates that change nothing, and deletions of what is not there, add no lines.
    """
    met = updates.select("tag", F.col("node").alias("new")).join(current.select("tag", F.col("node").alias("old")), "tag", "left")
    moved = met.withColumn("old", F.coalesce("old", F.lit(""))).where(F.col("old") != F.col("new"))
    lines = F.filter(F.array(F.struct(F.lit(0).alias("line"), F.col("old").alias("node")), F.struct(F.lit(1).alias("line"), F.col("new").alias("node"))), lambda x: (x["line"] == 1) | (x["node"] != ""))
    return moved.select("tag", F.explode(lines).alias("l")).select("tag", "l.line", "l.node")


def same_tags(a: DataFrame, b: DataFrame) -> bool:
    """Whether two tag tables have the same live tags."""
    x, y = live(a).select("tag", "node"), live(b).select("tag", "node")
    return x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()


ship(__name__)
