"""Deltas: line differences, their application, their bases, and chains of them."""

from __future__ import annotations

import difflib
import struct
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from revstrata.shipping import ship

#: Lines of old times lines of new up to which a stretch is compared line by line, and how often longer ones are cut again.
DENSE, DEEP = 250_000, 8


def _lines(text: bytes) -> list[bytes]:
    """Lines with their line feeds; nothing else ends a line."""
    out = [x + b"\n" for x in text.split(b"\n")]
    out[-1] = out[-1][:-1]
    return out if out[-1] else out[:-1]


def _anchors(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs of places of lines that occur once in either, rising in both: the longest such sequence."""
    once_a, twice_a, twice_b = {x: k for k, x in enumerate(a)}, Counter(a), Counter(b)
    tails: list[int] = []
    ends: list[int] = []
    before: list[int] = []
    pairs = [(once_a[x], k) for k, x in enumerate(b) if twice_b[x] == 1 and twice_a.get(x) == 1]
    for n, (i, _) in enumerate(pairs):
        k = bisect_left(tails, i)
        before.append(ends[k - 1] if k else -1)
        tails[k : k + 1], ends[k : k + 1] = [i], [n]
    out, n = [], ends[-1] if ends else -1
    while n >= 0:
        out.append(pairs[n])
        n = before[n]
    return out[::-1]


def _runs(a: list[bytes], b: list[bytes]) -> Iterator[tuple[list, list]]:
    """The runs of 1, 2, 4, ... lines that begin at each line of either, as things to compare."""
    x, y, k = list(a), list(b), 1
    while x and y:
        yield x, y
        names: dict[tuple, int] = {}
        x, y = ([names.setdefault((r[n], r[n + k]), len(names)) for n in range(len(r) - k)] for r in (x, y))
        k *= 2


def _in_step(a: list[bytes], b: list[bytes], i1: int, i2: int, j1: int, j2: int, common: set[bytes]) -> list[tuple[int, int]] | None:
    """Pairs of places of the ``common`` lines of two stretches, if each occurs once in either and all in the same order: then any comparison keeps just these."""
    xs, ys = [k for k in range(i1, i2) if a[k] in common], [k for k in range(j1, j2) if b[k] in common]
    if len(xs) == len(ys) == len(common) and all(a[x] == b[y] for x, y in zip(xs, ys, strict=True)):
        return list(zip(xs, ys, strict=True))
    return None


def line_hunks(old: bytes, new: bytes) -> list[tuple[int, int, bytes]]:
    """(start, end, replacement) in bytes of ``old``, at line ends, in order; applying them gives ``new``.

    Long texts are cut at lines that occur once in both, or, where there are none, at the shortest runs of 2, 4, 8, ... lines that do,
    and so are the stretches between; so the work does not grow with the square of their lines. Only a long stretch in which
    no run occurs once in both is replaced as a whole.
    """
    a, b = _lines(old), _lines(new)
    at = [0]
    for line in a:
        at.append(at[-1] + len(line))
    out: list[tuple[int, int, bytes]] = []

    def between(i1: int, i2: int, j1: int, j2: int, deep: int = 0) -> None:
        while i1 < i2 and j1 < j2 and a[i1] == b[j1]:
            i1, j1 = i1 + 1, j1 + 1
        while i1 < i2 and j1 < j2 and a[i2 - 1] == b[j2 - 1]:
            i2, j2 = i2 - 1, j2 - 1
        if i1 == i2 and j1 == j2:
            return
        common = set(a[i1:i2]).intersection(b[j1:j2]) if i1 < i2 and j1 < j2 else ()
        if not common:
            out.append((at[i1], at[i2], b"".join(b[j1:j2])))
        elif pairs := _in_step(a, b, i1, i2, j1, j2, common):
            for i, j in (*pairs, (i2, j2)):
                if i1 < i or j1 < j:
                    out.append((at[i1], at[i], b"".join(b[j1:j])))
                i1, j1 = i + 1, j + 1
        elif (i2 - i1) * (j2 - j1) <= DENSE:
            for tag, x1, x2, y1, y2 in difflib.SequenceMatcher(None, a[i1:i2], b[j1:j2], autojunk=False).get_opcodes():
                if tag != "equal":
                    out.append((at[i1 + x1], at[i1 + x2], b"".join(b[j1 + y1 : j1 + y2])))
        else:
            tried = (_anchors(x, y) for x, y in _runs(a[i1:i2], b[j1:j2])) if deep < DEEP else ()
            pairs = next((p for p in tried if p), None)
            if not pairs:
                out.append((at[i1], at[i2], b"".join(b[j1:j2])))
                return
            x, y = i1, j1
            for i, j in pairs:
                between(x, i1 + i, y, j1 + j, deep + 1)
                x, y = i1 + i + 1, j1 + j + 1
            between(x, i2, y, j2, deep + 1)

    between(0, len(a), 0, len(b))
    return out


def byte_hunks(old: bytes, new: bytes) -> list[tuple[int, int, bytes]]:
    """Line hunks less the bytes that old and new have in common at either end of each."""
    out = []
    for start, end, data in line_hunks(old, new):
        piece, k = old[start:end], 0
        while k < min(len(piece), len(data)) and piece[k] == data[k]:
            k += 1
        m = 0
        while m < min(len(piece), len(data)) - k and piece[-1 - m] == data[-1 - m]:
            m += 1
        out.append((start + k, end - m, data[k : len(data) - m]))
    return out


def apply_hunks(old: bytes, hunks: list[tuple[int, int, bytes]]) -> bytes:
    """``old`` with hunks applied; hunks that overlap, go back or pass the end are an error."""
    out, last = [], 0
    for start, end, data in hunks:
        if start < last or end < start or end > len(old):
            raise ValueError("a hunk is out of place")
        out += [old[last:start], data]
        last = end
    return b"".join([*out, old[last:]])


def pack(hunks: list[tuple[int, int, bytes]]) -> bytes:
    """Hunks in their wire form: three big-endian numbers (start, end, size) and the data, one after another."""
    return b"".join(struct.pack(">III", s, e, len(d)) + d for s, e, d in hunks)


def unpack(raw: bytes) -> list[tuple[int, int, bytes]]:
    out, at = [], 0
    while at < len(raw):
        s, e, n = struct.unpack_from(">III", raw, at)
        if at + 12 + n > len(raw):
            raise ValueError("a delta ends inside a hunk")
        out.append((s, e, raw[at + 12 : at + 12 + n]))
        at += 12 + n
    return out


def small_batches(spark: SparkSession, rows: int = 200) -> None:
    """Bound the session's Arrow batches to ``rows``, unless they are smaller: a batch of texts and their deltas is held several times over."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(name, rows)


def delta(old: Column, new: Column) -> Column:
    """The packed line delta between two binary columns; NULL counts as empty."""

    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            yield pd.Series([pack(line_hunks(bytes(x or b""), bytes(y or b""))) for x, y in zip(a, b, strict=True)], dtype=object)

    return F.pandas_udf(of, "binary")(old, new)


def byte_delta(old: Column, new: Column) -> Column:
    """The packed delta between two binary columns whose hunks hold only the bytes that differ; NULL counts as empty."""

    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, b in batches:
            yield pd.Series([pack(byte_hunks(bytes(x or b""), bytes(y or b""))) for x, y in zip(a, b, strict=True)], dtype=object)

    return F.pandas_udf(of, "binary")(old, new)


def patched(old: Column, packed: Column) -> Column:
    """A packed delta applied to a binary column."""

    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for a, d in batches:
            yield pd.Series([apply_hunks(bytes(x or b""), unpack(bytes(y or b""))) for x, y in zip(a, d, strict=True)], dtype=object)

    return F.pandas_udf(of, "binary")(old, packed)


def implicit_bases(chunks: DataFrame, section: str, seq: str, node: str, p1: str) -> DataFrame:
    """``chunks`` with ``base``: the node before in the section, or the first parent for the first."""
    return chunks.withColumn("base", F.coalesce(F.lag(node).over(Window.partitionBy(section).orderBy(seq)), F.col(p1)))


def smallest(candidates: DataFrame, key: str, size: str, order: str, base: str) -> DataFrame:
    """(key, base): the candidate with the smallest delta, the first of equals."""
    return candidates.groupBy(key).agg(F.min_by(base, F.struct(size, order)).alias(base))


def first_occurrence(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_r", rank).where("_r = 1").drop("_r")


def replay_chains(deltas: DataFrame, chain: str = "chain", seq: str = "seq") -> DataFrame:
    """(chain, seq, content): the full texts along chains of packed deltas, each against the text before, the first against nothing.

    A chain is one group, as each text needs the one before it; writers keep chains short by full texts at intervals.
    """

    def of(group: pd.DataFrame) -> pd.DataFrame:
        group, text, out = group.sort_values(seq), b"", []
        for d in group["delta"]:
            text = apply_hunks(text, unpack(bytes(d)))
            out.append(text)
        return pd.DataFrame({chain: group[chain], seq: group[seq], "content": out})

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in deltas.schema if f.name in (chain, seq))
    return deltas.groupBy(chain).applyInPandas(of, f"{schema}, content binary").select(chain, seq, "content")


ship(__name__)
