"""Renames and copies by likeness of content.

The likeness of two files is the share, in per cent, of the greater file's bytes that are in lines which both have (each line as
often as both have it). Files are compared by blob, so equal files cost one comparison. A pair can only reach the threshold
if it shares one of the lines that are in front of each file's lines, rarest first, as long as those behind them weigh less than
the threshold asks: only pairs that meet in such a line are scored, and exactly. Nothing is cut: what the bound rules out cannot
reach the threshold.
"""

from __future__ import annotations

import hashlib
import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revstrata.operators.delta import small_batches
from revstrata.operators.scratch import cut
from revstrata.shipping import ship

#: A line in packed bytes: its hash, how often it comes and how many bytes it has.
LINE, LINE_BYTES = "<20sQQ", 36


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, packs = [], []
        for text in batch.column("content").to_pylist():
            raw = (text or "").encode()
            *ended, last = raw.split(b"\n")
            own = [struct.pack(LINE, hashlib.sha1(line + b"\n").digest(), n, len(line) + 1) for line, n in Counter(ended).items()]
            if last:
                own.append(struct.pack(LINE, hashlib.sha1(last).digest(), 1, len(last)))
            sizes.append(len(raw))
            packs.append(b"".join(own))
        yield pa.RecordBatch.from_arrays([batch.column("blob"), pa.array(sizes, pa.int64()), pa.array(packs, pa.binary())], names=["blob", "size", "lines"])


def line_weights(blobs: DataFrame) -> DataFrame:
    """(blob, size, lines): the different lines of each row of (blob, content), by hash, how often and how many bytes each, packed (``LINE``).

    A last line feed ends a line. Nothing is shuffled: a row's text stays where it is read.
    """
    small_batches(blobs.sparkSession)
    rows = blobs.select("blob", F.col("content").cast("string").alias("content"))
    return rows.mapInArrow(_packed, f"blob {rows.schema['blob'].dataType.simpleString()}, size long, lines binary")


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = np.dtype([("line", "<i8"), ("rest", "V12"), ("times", "<i8"), ("weight", "<i8")])
    for batch in batches:
        packs = batch.column("lines").to_pylist()
        lines = np.frombuffer(b"".join(packs), kind)
        owner = pa.array(np.repeat(np.arange(len(packs)), [len(p) // LINE_BYTES for p in packs]))
        along = [batch.column(c).take(owner) for c in ("id", "size", "is_old", "is_new")]
        yield pa.RecordBatch.from_arrays([pa.array(lines["line"].copy()), pa.array(lines["times"] * lines["weight"]), *along], names=["line", "mass", "id", "size", "is_old", "is_new"])


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared = []
        for a, b in zip(batch.column("_a").to_pylist(), batch.column("_b").to_pylist(), strict=True):
            other = {line: times for line, times, _ in struct.iter_unpack(LINE, b)}
            shared.append(sum(min(times, other.get(line, 0)) * weight for line, times, weight in struct.iter_unpack(LINE, a)))
        yield pa.RecordBatch.from_arrays([batch.column("old"), batch.column("new"), batch.column("_m"), pa.array(shared, pa.int64())], names=["old", "new", "_m", "_s"])


def _front(packs: DataFrame, threshold: int) -> DataFrame:
    """(line, id, size, is_old, is_new): lines of each of ``packs``, rarest first, until those that are left weigh less than ``threshold`` per cent of it.

    Lines go by the beginnings of their hashes: where two have the same, pairs too many meet, and none too few. Lines that one blob has alone,
    or one side, are left out and weigh nothing, as no pair has them in common.
    """
    lines = packs.select("id", "size", "is_old", "is_new", "lines").mapInArrow(_tokens, "line long, mass long, id long, size long, is_old boolean, is_new boolean")
    counts = lines.groupBy("line").agg(F.count("*").alias("_held"), F.max("is_old").alias("_o"), F.max("is_new").alias("_n"))
    counts = counts.where("_held > 1 AND _o AND _n").select("line", "_held")
    order = Window.partitionBy("id").orderBy("_held", "line").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = lines.join(counts, "line").withColumn("_left", F.sum("mass").over(order))
    return left.where(100 * F.col("_left") >= threshold * F.col("size")).select("line", "id", "size", "is_old", "is_new")


def _alike(packs: DataFrame, threshold: int) -> DataFrame:
    """:func:`alike` of ``packs`` (blob, size, lines, is_old, is_new), one row a blob."""
    if not 1 <= threshold <= 100:
        raise ValueError("a threshold is from 1 to 100")
    packs = cut(packs.where("size > 0").withColumn("id", F.monotonically_increasing_id()), "lines")
    front = cut(_front(packs, threshold), "front")
    met = front.where("is_old").select("line", F.col("id").alias("old"), F.col("size").alias("_a")).join(front.where("is_new").select("line", F.col("id").alias("new"), F.col("size").alias("_b")), "line")
    fits = 100 * F.least("_a", "_b") >= threshold * F.greatest("_a", "_b")
    pairs = met.where(fits & (F.col("old") != F.col("new"))).select("old", "new").distinct()
    own = packs.where("is_old").select(F.col("id").alias("old"), F.col("blob").alias("_old"), F.col("size").alias("_sa"), F.col("lines").alias("_a"))
    other = packs.where("is_new").select(F.col("id").alias("new"), F.col("blob").alias("_new"), F.col("size").alias("_sb"), F.col("lines").alias("_b"))
    both = pairs.join(own, "old").join(other, "new").select(F.col("_old").alias("old"), F.col("_new").alias("new"), F.greatest("_sa", "_sb").alias("_m"), "_a", "_b")
    kind = packs.schema["blob"].dataType.simpleString()
    scores = both.mapInArrow(_scored, f"old {kind}, new {kind}, _m long, _s long")
    return scores.select("old", "new", F.expr("100 * _s div _m").cast("int").alias("score")).where(F.col("score") >= threshold)


def alike(old: DataFrame, new: DataFrame, threshold: int) -> DataFrame:
    """(old, new, score): pairs of different blobs of (blob, content) whose likeness is ``threshold`` (1 to 100) per cent or more, score rounded down.

    Empty and NULL contents are like nothing. Blobs that come twice count once.
    """
    sides = [line_weights(side).withColumns({"is_old": F.lit(is_old), "is_new": F.lit(not is_old)}) for side, is_old in ((old, True), (new, False))]
    return _alike(_once(sides[0].unionAll(sides[1])), threshold)


def _once(packs: DataFrame) -> DataFrame:
    """One row a blob."""
    first = F.first(F.struct("size", "lines")).alias("_l")
    return packs.groupBy("blob").agg(first, F.max("is_old").alias("is_old"), F.max("is_new").alias("is_new")).select("blob", "_l.*", "is_old", "is_new")


def renames_and_copies(old: DataFrame, new: DataFrame, contents: DataFrame, threshold: int = 100, copies: bool = False) -> DataFrame:
    """(source, target, score, status) of the paths that came from (path, blob) to (path, blob); ``contents`` are (blob, content).

    Each path that is new takes the source of the greatest likeness, of equals the least path: a path that went, or with
    ``copies`` any old path. Equal blobs have a likeness of 100. The best target of a path that went is its rename (``R``; of equals
    the least path), all others are copies (``C``). Paths without a source of at least ``threshold`` per cent are left out.
    At 100 only equal blobs count, and no content is read. What a greater threshold below that gives are the rows whose score reaches it.
    """
    came = new.join(old.select("path"), "path", "left_anti").select(F.col("path").alias("target"), F.col("blob").alias("_new"))
    gone = old.join(new.select("path"), "path", "left_anti").select("path", "blob").withColumn("_gone", F.lit(True))
    sources = gone if not copies else gone.unionByName(old.join(new.select("path"), "path", "left_semi").select("path", "blob", F.lit(False).alias("_gone")))
    # one source for each blob: a path that went before one that stayed, then the least
    best = cut(sources.groupBy("blob").agg(F.min(F.struct((~F.col("_gone")).alias("_stays"), "path")).alias("_s")).select(F.col("blob").alias("_old"), "_s.path", F.col("_s._stays").alias("_stays")))
    came = cut(came)
    scored = came.select(F.col("_new").alias("_old")).distinct().join(best.select("_old"), "_old", "left_semi").select("_old", F.col("_old").alias("_new"), F.lit(100).alias("score"))
    if threshold < 100:
        held = best.select(F.col("_old").alias("blob"), F.lit(True).alias("is_old"), F.lit(False).alias("is_new")).unionAll(came.select("_new", F.lit(False), F.lit(True)))
        held = held.groupBy("blob").agg(F.max("is_old").alias("is_old"), F.max("is_new").alias("is_new"))
        packs = _once(line_weights(contents).join(held, "blob"))
        scored = scored.unionByName(_alike(packs, threshold).select(F.col("old").alias("_old"), F.col("new").alias("_new"), "score"))
    met = came.join(scored, "_new").join(best, "_old")
    chosen = met.groupBy("target").agg(F.min(F.struct((-F.col("score")).alias("_s"), "_stays", "path")).alias("_c")).select("target", F.col("_c.path").alias("source"), (-F.col("_c._s")).alias("score"), F.col("_c._stays").alias("_stays"))
    chosen = cut(chosen)
    first = chosen.where("NOT _stays").groupBy("source").agg(F.min(F.struct((-F.col("score")).alias("_s"), "target")).alias("_f")).select("source", "_f.target", F.lit("R").alias("status"))
    return chosen.join(first, ["source", "target"], "left").select("source", "target", "score", F.coalesce("status", F.lit("C")).alias("status"))


ship(__name__)
