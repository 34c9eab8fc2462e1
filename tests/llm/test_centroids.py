import hashlib
import math

import numpy as np
from pyspark.sql import functions as F

from revstrata.llm import centroids


def brute(rows, k, dims, rounds, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1]))
    cs = [v for _, v in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(cs))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        cs = [[sum(x) // len(groups[n]) for x in zip(*groups[n], strict=True)] if n in groups else c for n, c in enumerate(cs)]
    got = [(i, near(v)[1], near(v)[0]) for i, v in kept]
    total = {}
    for _, n, x in got:
        total[n] = total.get(n, 0) + x
    return sorted((i if i is not None else -1, n, x, total[n], sum(total.values()), hashlib.sha256(",".join(map(str, cs[n])).encode()).hexdigest()) for i, n, x in got)


def rows_of(df):
    return sorted((r.vec_id if r.vec_id is not None else -1, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)]
    rows += [(i + 300, list(rows[0][1])) for i in range(40)] + [(5, rows[9][1]), (None, rows[3][1]), (700, [0.0] * 6)]  # copies, a repeated and a null id
    rows += [(900, None), (901, []), (902, [1.0] * 5), (903, [None, *[1.0] * 5]), (904, [float("nan"), *[1.0] * 5]), (905, [float("inf"), *[1.0] * 5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("mine")).repartition(5)
    for k, rounds in ((16, 3), (3, 1), (1, 2), (7, 0)):
        assert rows_of(centroids.cluster(df, k=k, dims=6, rounds=rounds)) == brute(rows, k, 6, rounds)


def test_ties_few_rows_large_components_and_none(spark):
    same = [(i, [1.0, 2.0]) for i in range(5)]
    df = spark.createDataFrame(same, "vec_id long, embedding array<double>")
    assert rows_of(centroids.cluster(df, k=16, dims=2)) == brute(same, 16, 2, 3)
    large = [(1, [1e9, -3e8]), (2, [1e9 + 5, 0.0]), (3, [-7e8, 2.5]), (4, [1.0, 1.0])]
    df = spark.createDataFrame(large, "vec_id long, embedding array<double>")
    got, expected = rows_of(centroids.cluster(df, k=2, dims=2)), brute(large, 2, 2, 3)
    fits = [(i, n, *(x if x < 1 << 63 else None for x in rest[:3]), rest[3]) for i, n, *rest in expected]
    assert got == fits
    assert rows_of(centroids.cluster(df.limit(0), k=2, dims=2)) == []
    assert rows_of(centroids.cluster(df, k=2, dims=3)) == []


def test_walk_stops_early_and_is_exact():
    rng = np.random.default_rng(5)
    cs, vs = rng.integers(-50, 50, (40, 3)), rng.integers(-60, 60, (500, 3))
    which, best = centroids.nearest(vs, cs)
    full = ((vs[:, None, :] - cs[None]) ** 2).sum(2)
    assert (which == full.argmin(1)).all() and (best == full.min(1)).all()
