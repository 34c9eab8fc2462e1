import numpy as np
from revstrata.llm import ann


def _brute(rows, every, k):
    ok = {i: np.array(v) for i, v in rows.items()}
    out = {}
    for q in ok:
        if q % every == 0:
            s = sorted(((-float(ok[q] @ ok[c]), c) for c in ok if c != q))
            out[q] = [c for _, c in s[:k]]
    return out


def test_recall_against_brute_force(spark):
    rnd = np.random.RandomState(0)
    x = rnd.randn(1500, 16).astype("float32")
    rows = {i: x[i].tolist() for i in range(1500)}
    got = ann.nearest(spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<float>")).collect()
    want = _brute({i: np.array(v, dtype="float32").astype(float) for i, v in rows.items()}, 20, 20)
    by = {}
    for r in got:
        by.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(by) == set(want)
    hits = 0
    for q, rs in by.items():
        assert sorted(rs) == list(range(1, 21)) and [rs[k][1] for k in range(1, 21)] == sorted((v[1] for v in rs.values()), reverse=True)
        hits += len({v[0] for v in rs.values()} & set(want[q]))
    assert hits / (20 * len(want)) >= 0.9


def test_recall_where_few_pivots_gather_many_nodes(spark):
    rnd = np.random.RandomState(1)
    x = (rnd.randn(12, 16)[rnd.randint(12, size=4000)] + 0.3 * rnd.randn(4000, 16)).astype("float32")
    rows = {i: x[i].tolist() for i in range(4000)}
    got = ann.nearest(spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<float>"), every=100, most_pivots=8).collect()
    want = _brute({i: np.array(v, dtype="float32").astype(float) for i, v in rows.items()}, 100, 20)
    assert sum(r.vec_id in want[r.query_id] for r in got) / (20 * len(want)) >= 0.9


def test_split_keeps_every_node_once(spark):
    rnd = np.random.RandomState(2)
    x = rnd.randn(3000, 4).astype("float32")
    cells = spark.createDataFrame([(i, x[i].tobytes(), i % 2 and 7) for i in range(3000)], "node long, vec binary, cell long")
    out = ann.split(cells, "<f4", block=100).collect()
    assert sorted(r.node for r in out) == list(range(3000))
    sizes = {}
    for r in out:
        sizes[r.cell] = sizes.get(r.cell, 0) + 1
    assert max(sizes.values()) <= 200
    same = spark.createDataFrame([(i, x[0].tobytes(), 7) for i in range(500)], "node long, vec binary, cell long")
    assert ann.split(same, "<f4", block=100).count() == 500  # vectors that no pivots tell apart


def test_ties_repeats_and_bad_vectors(spark):
    rows = [(k, [1.0, 0.0]) for k in range(30)] + [(100, [0.0, 0.0]), (120, None), (140, [float("nan"), 1.0]), (160, [None, 1.0]), (None, [1.0, 0.0]), (0, [1.0, 0.0]), (200, [1.0, 2.0, 3.0])]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), every=20, k=3).collect()
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == {(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 3, 1.0), (20, 1, 0, 1.0), (20, 2, 1, 1.0), (20, 3, 2, 1.0)}
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).isEmpty()
