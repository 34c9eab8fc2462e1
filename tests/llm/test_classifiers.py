import random
import zlib

from pyspark.sql import functions as F
from revstrata.llm import ftrl, langid, toxicity
from revstrata.tables import load

SF = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    docs = load(spark, SF, "documents")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(r.lang == r.lang_pred for r in held) / len(held) >= 0.97 and all(0 <= r.score <= 1 for r in got)


def test_language_defined_results(odd, none):
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(odd).collect()}
    assert got[3] == got[4] == got[5] == got[9] == ("und", 0.0) and got[6][0] in ("de", "en", "fr")
    assert langid.identify(none).isEmpty()
    alone = langid.identify(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in alone.collect()} == {"und"}
    assert langid.accepted(odd, langid.fit(odd)).columns == odd.columns


def test_toxicity_held_out(spark):
    docs, labels = load(spark, "/root/testdata/sf0.1", "documents"), load(spark, "/root/testdata/sf0.1", "labels")
    labelled = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    got = toxicity.predict(labelled, toxicity.fit(docs, labels, rounds=2)).join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).collect()
    toxic = [r for r in got if r.toxic]
    assert sum(r.predicted for r in toxic) / len(toxic) >= 0.75
    assert sum(r.predicted for r in got if not r.toxic) / (len(got) - len(toxic)) <= 0.02


def test_toxicity_defined_results(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (6, 0), (None, 1), (77, 1)], "doc_id long, toxic int")
    got = toxicity.score(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    assert {r.predicted for r in toxicity.score(odd, labels.limit(0)).collect()} == {0}
    assert toxicity.score(none, labels).isEmpty()
    assert toxicity.clean(odd, toxicity.fit(odd, labels)).columns == odd.columns


def test_counterfactual_penalty_narrows_the_gap():
    import numpy as np

    assert toxicity.swapped("The Women came. No one else.") == "The men came. No one else." and toxicity.swapped("nothing") is None
    rnd = random.Random(0)
    rows = []
    for _ in range(300):  # term 0 goes with the label in this sample, term 1 does not; 2 is what makes it true
        y = rnd.random() < 0.5
        at = np.array(sorted({0 if y and rnd.random() < 0.9 else 1, *([2] if y and rnd.random() < 0.7 else []), rnd.randint(3, 9)}))
        other = np.array(sorted({1 if 0 in at else 0, *(set(at.tolist()) - {0, 1})}))
        rows.append((at, np.ones(len(at)), int(y), other))
    gaps = []
    for c in (0.0, 8.0):
        z, n = np.zeros((1, 11)), np.zeros((1, 11))
        p = ftrl.Penalty(alpha=0.5, l1=0.1, counterfactual=c)
        ftrl.run(rows, z, n, p, 4)
        w = ftrl.weights(z, n, p)[0]
        gaps.append(abs(w[0] - w[1]))
    assert gaps[1] < 0.6 * gaps[0]


def test_temperature():
    import numpy as np

    rnd = np.random.RandomState(0)
    logits = rnd.randn(4000, 3)
    labels = np.array([rnd.choice(3, p=q) for q in ftrl.probabilities(logits)])
    assert 0.85 < ftrl.temperature(logits, labels) < 1.15 and 2.5 < ftrl.temperature(3 * logits, labels) < 3.5


def test_ftrl_against_a_plain_loop():
    import math
    import random

    import numpy as np
    from revstrata.llm import ftrl

    rnd = random.Random(6)
    p = ftrl.Penalty(alpha=0.7, beta=1.0, l1=0.05, l2=0.2, counterfactual=2.0)
    rows = []
    for _ in range(60):
        at = sorted(rnd.sample(range(8), 3))
        rows.append((np.array(at), np.array([rnd.random() for _ in at]) if rnd.random() < 0.5 else np.ones(3), int(0 in at), np.array(sorted(rnd.sample(range(8), 3))) if rnd.random() < 0.4 else None))
    z, n = np.zeros((1, 9)), np.zeros((1, 9))
    ftrl.run(rows, z, n, p, 2)

    zs, ns = [0.0] * 9, [0.0] * 9

    def weight(k, l1=p.l1, l2=p.l2):
        return 0.0 if abs(zs[k]) <= l1 else -(zs[k] - math.copysign(l1, zs[k])) / ((p.beta + math.sqrt(ns[k])) / p.alpha + l2)

    def update(k, g, w):
        zs[k] += g - (math.sqrt(ns[k] + g * g) - math.sqrt(ns[k])) / p.alpha * w
        ns[k] += g * g

    sigmoid = lambda x: 1 / (1 + math.exp(-x))
    for _ in range(2):
        for at, x, y, other in rows:
            w, b = {k: weight(k) for k in at}, weight(8, 0.0, 0.0)
            error = sigmoid(sum(w[k] * v for k, v in zip(at, x)) + b) - y
            for k, v in zip(at, x):
                update(k, error * v, w[k])
            update(8, error, b)
            if other is not None:
                both = sorted({*at, *other})
                w = {k: weight(k) for k in both}
                q1, q2 = sigmoid(sum(w[k] for k in at) + b), sigmoid(sum(w[k] for k in other) + b)
                pull = 2 * p.counterfactual * (q1 - q2)
                for k in both:
                    update(k, pull * q1 * (1 - q1) * (k in at) - pull * q2 * (1 - q2) * (k in other), w[k])
    assert np.allclose(z[0], zs) and np.allclose(n[0], ns)
