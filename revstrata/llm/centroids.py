"""Centroid clustering of integer vectors by the threshold algorithm.

Every dimension has its list of centroids sorted by value. For each vector the lists are walked outward from the vector's own
value, all dimensions one step a round; a centroid that a list shows for the first time gets its exact distance. No centroid
that is still unseen can be nearer than the sum of the squared gaps at the frontier of the lists, so the walk of a vector
stops once that sum strictly exceeds its best exact distance (strictly, as ties go to the smaller number).

Vectors are dealt as Spark reads them and never shuffled: a round sends one row of sums for each task, cluster and dimension
to an aggregate, and its k times ``dims`` totals to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revstrata.llm.common import ship, written

#: Components below this size are summed in 64 bits; a batch with larger ones is worked with Python's integers.
SMALL = 1 << 27


def is_kept(embedding: Column, dims: int) -> Column:
    """Whether a vector has exactly ``dims`` components, none null or non-finite."""
    sound = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(embedding.isNotNull() & (F.size(embedding) == dims) & sound, F.lit(False))


def quantised(column: pa.Array, dims: int, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors of a list column are kept, and their components as integers floor(scale * x)."""
    fits = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False) == dims
    values = column.filter(pa.array(fits)).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)
    sound = np.isfinite(values).all(axis=1)
    kept = fits.copy()
    kept[fits] = sound
    return kept, integers(np.floor(values[sound] * scale))


def integers(whole: np.ndarray) -> np.ndarray:
    """Whole doubles as 64-bit integers, or as Python's where they are large."""
    if not whole.size or np.abs(whole).max() < SMALL:
        return whole.astype(np.int64)
    if not np.isfinite(whole).all():
        raise ValueError("a component is too large to be scaled")
    return np.array([[int(x) for x in row] for row in whole], dtype=object)


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector and the squared distance, by the threshold algorithm; ties go to the smaller number."""
    (n, dims), k = vectors.shape, len(centroids)
    exact = vectors.dtype == object or centroids.dtype == object or (centroids.size > 0 and np.abs(centroids).max() >= SMALL)
    kind, far = (object, 1 << 3000) if exact else (np.int64, np.iinfo(np.int64).max)
    vectors, centroids = vectors.astype(kind), centroids.astype(kind)
    order = np.argsort(centroids, axis=0, kind="stable")
    values, column = np.take_along_axis(centroids, order, axis=0), np.arange(dims)
    right = np.stack([np.searchsorted(values[:, j], vectors[:, j]) for j in range(dims)], axis=1) if n else np.zeros((0, dims), dtype=np.int64)
    left = right - 1
    best, which, seen, live = np.full(n, far, dtype=kind), np.full(n, k), np.zeros((n, k), dtype=bool), np.arange(n)
    while len(live):
        low, high, x, rows = left[live], right[live], vectors[live], np.arange(len(live))
        # a list that has ended on one side is walked on the other; a step is never taken beyond both
        down = np.where(low >= 0, x - values[np.maximum(low, 0), column], far)
        up = np.where(high < k, values[np.minimum(high, k - 1), column] - x, far)
        back = (down <= up).astype(bool)
        at, gap = np.where(back, low, high), np.where(back, down, up)
        left[live], right[live] = low - back, high + ~back
        shown = np.zeros((len(live), k), dtype=bool)
        shown[rows[:, None], order[at, column]] = True
        fresh = shown & ~seen[live]
        seen[live] |= fresh
        row, number = np.nonzero(fresh)
        distance = np.full((len(live), k), far, dtype=kind)
        distance[row, number] = ((x[row] - centroids[number]) ** 2).sum(axis=1)
        found = distance.argmin(axis=1)
        least = distance[rows, found]
        better = ((least < best[live]) | ((least == best[live]) & (found < which[live]))).astype(bool)
        best[live[better]], which[live[better]] = least[better], found[better]
        frontier = (gap**2).sum(axis=1)
        live = live[(frontier <= best[live]).astype(bool) & ~seen[live].all(axis=1)]
    return which, best


def seeds(rows: DataFrame, k: int, dims: int, scale: float, seed: int) -> np.ndarray:
    """The first centroids: the k kept vectors with the smallest sha256 of ``seed:vec_id``, in that order."""
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    chosen = rows.where(is_kept(F.col("embedding"), dims)).select(named.alias("h"), F.col("embedding").cast("array<double>").alias("e"))
    first = chosen.orderBy(F.col("h").asc_nulls_last(), "e").limit(k).collect()
    return integers(np.floor(np.array([r.e for r in first], dtype=np.float64).reshape(-1, dims) * scale))


def _moved(rows: DataFrame, centroids: np.ndarray, scale: float) -> np.ndarray:
    """The centroids after one round: the floor of the mean of the vectors nearest to each; empty ones stay."""
    k, dims = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), dtype=object), np.zeros(k, dtype=np.int64)
        for batch in batches:
            _, vectors = quantised(batch.column(1), dims, scale)
            which, _ = nearest(vectors, centroids)
            for c in np.unique(which):
                total[c] += np.array([int(x) for x in vectors[which == c].sum(axis=0)], dtype=object)
            count += np.bincount(which, minlength=k)
        for c in np.flatnonzero(count):
            yield pa.RecordBatch.from_arrays(
                [pa.array([c] * dims, pa.int32()), pa.array(range(dims), pa.int32()), pa.array([Decimal(x) for x in total[c]], pa.decimal128(38, 0)), pa.array([count[c]] * dims, pa.int64())],
                names=["cluster", "dim", "total", "n"],
            )

    parts = rows.mapInArrow(sums, "cluster int, dim int, total decimal(38,0), n long")
    out = np.array([[int(x) for x in row] for row in centroids], dtype=object)
    for r in parts.groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():  # k * dims rows at most
        out[r.cluster, r.dim] = int(r.total) // r.n
    return integers(out.astype(np.float64)) if np.abs(out).max() < SMALL else out


def cluster(vectors: DataFrame, k: int = 16, dims: int = 64, rounds: int = 3, scale: float = 64.0, seed: int = 1) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector of (vec_id, embedding).

    Vectors that are null, of another length, or hold null or non-finite components are left out; other columns play no part.
    With fewer than k kept vectors each is a centroid; an empty table gives no rows. Rows that share a vec_id are vectors of
    their own, and a null vec_id comes last among the seeds. Equal centroids leave all but the first empty, and these stay.
    Components are scaled and floored exactly as doubles; a distance or a sum of distances that does not fit a long is null,
    and a scaled component, or a sum of one, of more than 38 digits is an error.
    """
    rows = vectors.select("vec_id", "embedding")
    centroids = seeds(rows, k, dims, scale, seed)
    if not len(centroids):
        return rows.limit(0).select("vec_id", *[F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
    for _ in range(rounds):
        centroids = _moved(rows, centroids, scale)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, own = quantised(batch.column(1), dims, scale)
            which, distance = nearest(own, centroids)
            fits = [int(x) if x < 1 << 63 else None for x in distance]
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(kept)), pa.array(which, pa.int32()), pa.array(fits, pa.int64())], names=["vec_id", "cluster", "distance"])

    kind = rows.schema["vec_id"].dataType.simpleString()
    assigned = written(rows.mapInArrow(assign, f"vec_id {kind}, cluster int, distance long"), "clusters")
    # a cluster with a distance beyond a long has no inertia either
    whole = F.when(F.count("distance") == F.count("*"), F.sum(F.col("distance").cast("decimal(38,0)")))
    totals = {r.cluster: r.total for r in assigned.groupBy("cluster").agg(whole.alias("total")).collect()}  # k rows at most
    fits = lambda x: None if x is None or x >= 1 << 63 else int(x)
    every = fits(None if None in totals.values() else sum(totals.values()))
    digest = [hashlib.sha256(",".join(str(int(x)) for x in c).encode()).hexdigest() for c in centroids]
    facts = [(c, fits(total), every, digest[c]) for c, total in sorted(totals.items())]
    table = rows.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(table), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


ship(__name__)
