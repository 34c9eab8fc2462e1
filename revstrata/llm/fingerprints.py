"""Document fingerprints from prefix polynomial hashes.

For a text of code points c the prefix arrays hold S[i] = sum over j < i of (c[j] + 1) * B**j,
modulo a prime, for two bases. They answer the equality of any two spans in constant time and
the longest common extension of two positions by binary search. The hash of a span does not
depend on where it stands, so the hashes of all spans of ``SPAN`` code points come from one
subtraction and one product over the arrays; the smallest ``SKETCH`` of them, mixed, are the
text's sketch. A fingerprint is the length, the whole text's hash and the sketch, in hex.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revstrata.llm.common import code_points, mix64, ship

P = np.uint64((1 << 31) - 1)
BASES = (np.uint64(918_273_645), np.uint64(1_357_924_681))
SPAN, SKETCH = 16, 64


class Powers:
    """Powers of the bases and of their inverses, grown by doubling when a longer text comes."""

    def __init__(self) -> None:
        self.tables = [np.array([1], dtype=np.uint64) for _ in range(4)]
        self.bases = [*BASES, *(np.uint64(pow(int(b), int(P) - 2, int(P))) for b in BASES)]

    def upto(self, n: int) -> list[np.ndarray]:
        while len(self.tables[0]) < n:
            m = len(self.tables[0])
            for k, t in enumerate(self.tables):
                self.tables[k] = np.concatenate([t, t * (t[-1] * self.bases[k] % P) % P])
            assert len(self.tables[0]) == 2 * m
        return self.tables


def prefix_arrays(codes: np.ndarray, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """The two prefix arrays of a text, each one longer than the text."""
    t = powers.upto(len(codes) + 1)
    c = codes.astype(np.uint64) + np.uint64(1)
    out = []
    for k in range(2):
        s = np.zeros(len(c) + 1, dtype=np.uint64)
        np.cumsum(c * t[k][: len(c)] % P, out=s[1:])
        out.append(s % P)
    return out[0], out[1]


def span_hash(s: tuple[np.ndarray, np.ndarray], i: int, j: int, powers: Powers) -> int:
    """The hash of the span [i, j), free of its position."""
    t = powers.upto(i + 1)
    h = [(int(s[k][j]) - int(s[k][i])) * int(t[2 + k][i]) % int(P) for k in range(2)]
    return h[0] << 31 | h[1]


def spans_equal(a: tuple, i: int, b: tuple, j: int, n: int, powers: Powers) -> bool:
    """Whether n code points from i in one text equal those from j in the other, by their hashes."""
    return span_hash(a, i, i + n, powers) == span_hash(b, j, j + n, powers)


def common_extension(a: tuple, i: int, b: tuple, j: int, powers: Powers) -> int:
    """The longest common extension of position i in one text and j in the other."""
    low, high = 0, min(len(a[0]) - 1 - i, len(b[0]) - 1 - j)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if spans_equal(a, i, b, j, mid, powers) else (low, mid - 1)
    return low


def sketch(s: tuple[np.ndarray, np.ndarray], powers: Powers) -> np.ndarray:
    """The smallest mixed hashes of all spans of SPAN code points (of the whole text, if shorter), sorted."""
    n = len(s[0]) - 1
    if not n:
        return np.zeros(0, dtype=np.uint64)
    w = min(SPAN, n)
    t = powers.upto(n + 1)
    h = [(s[k][w:] + P - s[k][: n - w + 1]) % P * t[2 + k][: n - w + 1] % P for k in range(2)]
    mixed = mix64((h[0] << np.uint64(31) | h[1]) ^ np.uint64(w))
    if len(mixed) > 8 * SKETCH:
        low = np.unique(np.partition(mixed, 4 * SKETCH)[: 4 * SKETCH])
        if len(low) >= SKETCH:
            return low[:SKETCH]
    return np.unique(mixed)[:SKETCH]


def fingerprint(s: tuple[np.ndarray, np.ndarray], powers: Powers) -> str:
    """Length, whole hash and sketch in hex; equal texts have equal fingerprints."""
    n = len(s[0]) - 1
    return f"{n:016x}{span_hash(s, 0, n, powers):016x}" + sketch(s, powers).astype(">u8").tobytes().hex()


def likeness(a: str, b: str) -> float:
    """Share of spans that two texts have in common (0 to 1), estimated from their fingerprints; 1 if these are equal."""
    if a == b:
        return 1.0
    x, y = (np.frombuffer(bytes.fromhex(f[32:]), dtype=">u8") for f in (a, b))
    if not len(x) or not len(y):
        return 0.0
    k = SKETCH if max(len(x), len(y)) == SKETCH else len(x) + len(y)
    union = np.union1d(x, y)[:k]
    both = len(np.intersect1d(np.intersect1d(x, y, assume_unique=True), union, assume_unique=True))
    j = both / len(union)
    return 2 * j / (1 + j)


def _bucket(key: Column, bounds: list[int]) -> Column:
    """How many bounds are at most ``key``, in two steps of about the square root of their number; nulls come first."""
    step = max(1, int(len(bounds) ** 0.5))
    array = lambda xs: F.array(*[F.lit(x) for x in xs]) if xs else F.expr("cast(array() as array<bigint>)")
    coarse = F.size(F.filter(array(bounds[step - 1 :: step]), lambda b: b <= key))
    fine = F.size(F.filter(F.slice(array(bounds), coarse * step + 1, step), lambda b: b <= key))
    return F.when(key.isNull(), 0).otherwise(coarse * step + fine)


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text", buckets: int | None = None) -> DataFrame:
    """Rows with the next row's text in ``next_text``, in ascending order of ``key``; the last row's next is the first.

    Rows are dealt once, to ranges of ``key`` with about as many rows each. Only the first row
    of a range is copied, to the range before it, behind that range's own rows; bounds and first
    keys are two numbers a range on the driver.
    """
    spark = docs.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.where(F.col(key).isNotNull()).approxQuantile(key, [k / n for k in range(1, n)], 0.25 / n) if n > 1 else []
    bounds = sorted({int(x) for x in cuts})
    at = _bucket(F.col(key), bounds)
    firsts = sorted((r[0], r[1]) for r in docs.select(at.alias("b"), key).groupBy("b").agg(F.min(F.coalesce(key, F.lit(-(1 << 63))))).collect())
    before = {b: firsts[k - 1][0] for k, (b, _) in enumerate(firsts)}
    first = dict(firsts)
    by_bucket = lambda d: F.element_at(F.array(*[F.lit(d.get(b, 0)).cast("long") for b in range(len(bounds) + 1)]), F.col("bucket") + 1)
    here = docs.withColumn("bucket", at.cast("int"))
    copies = F.when(
        F.coalesce(F.col(key), F.lit(-(1 << 63))) == by_bucket(first),
        F.array(F.struct(F.col("bucket").alias("b"), F.lit(False).alias("g")), F.struct(by_bucket(before).cast("int").alias("b"), F.lit(True).alias("g"))),
    ).otherwise(F.array(F.struct(F.col("bucket").alias("b"), F.lit(False).alias("g"))))
    dealt = here.withColumn("copy", F.explode(copies)).withColumn("bucket", F.col("copy.b")).withColumn("ghost", F.col("copy.g")).drop("copy")
    window = Window.partitionBy("bucket").orderBy(F.col("ghost").asc(), F.col(key).asc_nulls_first(), F.col(text))
    placed = dealt.repartition(n, "bucket").withColumn("next_text", F.lead(text).over(window))
    return placed.where(~F.col("ghost")).drop("bucket", "ghost")


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts and of their edited texts (see the module of queries).

    A null text is empty; empty texts have a fingerprint of no spans. Rows that share a doc_id are
    ordered by text; null doc_ids come first. An empty table has an empty result. Other columns are
    not read.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    placed = with_next(rows)

    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        powers, held = Powers(), (None, None, "")

        def prints(text: str) -> tuple[tuple, str]:
            arrays = prefix_arrays(code_points(text), powers)
            return arrays, fingerprint(arrays, powers)

        for texts, following in batches:
            out = []
            for a, b in zip(texts, following, strict=True):
                x, f = held[1:] if held[0] == a else prints(a)
                half = len(a) // 2
                changed = a[: len(a) - half] + b[:half]
                y, g = prints(changed)
                held = (b, *prints(b))
                out.append((len(a), hashlib.sha256(changed.encode()).hexdigest(), f, g, likeness(f, g), likeness(f, held[2]), common_extension(x, 0, y, 0, powers)))
            yield pd.DataFrame(out, columns=["n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "kept_chars"])

    prints = F.pandas_udf(of, "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, kept_chars long")
    return placed.select("doc_id", prints("text", "next_text").alias("f")).select("doc_id", "f.*")


ship(__name__)
