import random
import re

import pytest
from revstrata.llm import jaccard as J


def brute(docs, words, percent):
    sets, parent = {}, {}
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({k: k + 32 for k in range(65, 91)}))
        sets[i] = frozenset() if not w else frozenset([tuple(w)]) if len(w) < words else frozenset(tuple(w[k : k + words]) for k in range(len(w) - words + 1))
        parent[i] = i

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), root(i)) for i in sets)


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80)])
def test_against_brute_force(spark, words, percent):
    rnd = random.Random(words)
    vocabulary = [f"w{k}" for k in range(400)]
    base = [rnd.choice(vocabulary) for _ in range(150)]
    passage = [rnd.choice(vocabulary) for _ in range(40)]
    docs = []
    for i in range(260):
        kind = i % 5
        w = list(base) if kind < 2 else [rnd.choice(vocabulary) for _ in range(rnd.randint(0, 60))]
        if kind < 2:  # near copies of one text, more and less alike
            for _ in range(rnd.randint(0, 8)):
                w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        elif kind == 2:  # a passage in many documents
            w += passage
        elif kind == 3 and docs:
            w = docs[rnd.randrange(len(docs))][1].upper().split()
            w = w[: len(w) - rnd.randint(0, 3)]
        docs.append((i, " ".join(w)))
    got = J.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), words, percent).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute(docs, words, percent)


def test_defined_results(odd, none):
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.near_duplicates(odd).collect()), key=str)
    assert (1, 8, 1) in got and got.count((2, 8, 1)) == 2 and (3, 0, 3) in got and (4, 0, 4) in got and (5, 0, 5) in got and (8, 1, 8) in got
    assert len(got) == odd.count() and J.near_duplicates(none).isEmpty()
    kept = J.deduplicated(odd)
    assert kept.columns == odd.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "4", "5", "6", "7", "8", "9", "None"]


def test_null_and_repeated_ids(spark):
    rnd = random.Random(3)
    text = lambda: [f"w{rnd.randrange(10**6)}" for _ in range(60)]
    near = lambda w: " ".join([*w[:-1], "other"])
    a, b, c, d = text(), text(), text(), text()
    rows = [(None, " ".join(a)), (7, near(a)), (1, " ".join(b)), (1, " ".join(c)), (2, near(b)), (3, near(c)), (None, " ".join(d)), (None, near(d)), (None, near(d))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    of = lambda x: sorted(x, key=str)
    got = [(r.doc_id, r.component_id) for r in J.near_duplicates(docs).collect()]
    assert of(got) == of([(None, 7), (7, 7), (1, 1), (1, 1), (2, 1), (3, 1), (None, None), (None, None), (None, None)])
    kept = [(r.doc_id, r.text) for r in J.deduplicated(docs).collect()]
    assert len(kept) == 4 and {(7, near(a)), (1, " ".join(b)), (1, " ".join(c))} < set(kept)
