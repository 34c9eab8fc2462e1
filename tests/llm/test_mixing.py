from collections import defaultdict

from revstrata.llm import mixing
from revstrata.tables import load


def test_against_a_loop(spark):
    rows = mixing.calibrate(load(spark, "/root/testdata/sf0.01", "documents")).collect()
    cells = defaultdict(float)
    for r in rows:
        cells[r.source, r.lang, r.topic] += r.n_tokens
    total = sum(cells.values())
    goals = []
    for k in range(3):
        mass = defaultdict(float)
        for c, v in cells.items():
            mass[c[k]] += v
        z = sum(v**0.7 for v in mass.values())
        goals.append({c: v**0.7 / z * total for c, v in mass.items()})
    w = dict(cells)
    for _ in range(60):
        for k in range(3):
            mass = defaultdict(float)
            for c, v in w.items():
                mass[c[k]] += v
            w = {c: v * goals[k][c[k]] / mass[c[k]] for c, v in w.items()}
    for r in rows:
        c = (r.source, r.lang, r.topic)
        assert abs(r.weight - w[c] / cells[c]) < 1e-3 * r.weight
    top = max(r.weight for r in rows)
    assert all(abs(r.probability - r.weight / top) < 1e-9 for r in rows)
    expected = sum(r.probability for r in rows)
    assert abs(sum(r.sampled for r in rows) - expected) < 4 * expected**0.5


def test_salted_join_is_the_same(odd, monkeypatch):
    of = lambda: sorted(str((r.doc_id, r.source, r.topic, round(r.weight, 9), r.sampled)) for r in mixing.calibrate(odd).collect())
    plain = of()
    monkeypatch.setattr(mixing, "BROADCAST_CELLS", 0)
    assert of() == plain and len(plain) == odd.count()


def test_defined_results(odd, none):
    assert mixing.calibrate(none).isEmpty() and mixing.sample(odd.withColumnRenamed("score", "weight")).columns == [*odd.columns[:-1], "weight"]
    empty = [r for r in mixing.calibrate(odd).collect() if not r.text]
    assert all(r.n_tokens == 0 for r in empty)


def test_a_rare_document_does_not_thin_the_rest(spark):
    rows = [(i, "word " * 50, "ab"[i % 3 == 0], "en") for i in range(300)] + [(300, "un mot rare", "c", "fr")]
    kept = mixing.sample(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).count()
    assert kept > 250  # scaled by the rare cell's weight: about 60


def test_capped_rate(spark):
    cells = spark.createDataFrame([(100, 0.5), (50, 1.5), (10, 4.0)], "tokens long, _weight double")
    kept = lambda rate: 100 * min(1, 0.5 * rate) + 50 * min(1, 1.5 * rate) + 10 * min(1, 4.0 * rate)
    assert mixing.capped_rate(cells) == 1.0
    assert abs(kept(mixing.capped_rate(cells, budget=0.5)) - 80) < 1e-6 and abs(kept(mixing.capped_rate(cells, budget=0.1)) - 16) < 1e-6
