"""Renames by likeness and stored digests against plain loops."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from revstrata.operators import digests, similarity


def _score(a, b):
    def lines(t):
        parts = t.split("\n")
        return Counter(x for x in [p + "\n" for p in parts[:-1]] + parts[-1:] if x)

    x, y = lines(a), lines(b)
    return 100 * sum(min(n, y[k]) * len(k.encode()) for k, n in x.items()) // max(len(a.encode()), len(b.encode()), 1)


def test_likeness(spark):
    rng = random.Random(8)
    words = ["alpha", "", "beta ü", "x" * 50, "gamma", "delta", "common", "common"]
    make = lambda: "\n".join(rng.choice(words) for _ in range(rng.randrange(0, 9)))
    old = {f"o{k}": make() for k in range(25)}
    new = {f"n{k}": make() for k in range(25)} | {"same": old["o3"], "edited": old["o4"] + "\nmore"}
    frame = lambda t: spark.createDataFrame([*t.items()], "blob string, content string")
    for threshold in (50, 90, 100):
        got = {(r.old, r.new): r.score for r in similarity.alike(frame(old), frame(new), threshold).collect()}
        assert got == {(a, b): s for a, x in old.items() for b, y in new.items() if (s := _score(x, y)) >= threshold}
    with pytest.raises(ValueError, match="from 1 to 100"):
        similarity.alike(frame(old), frame(new), 0)


def test_renames_and_copies(spark):
    text = {"A": "one\ntwo\nthree\nfour\n", "B": "one\ntwo\nthree\nfive\n", "C": "zzz\n", "E": "", "D": "one\ntwo\nthree\nfour\nsix\n"}
    contents = spark.createDataFrame([*text.items()], "blob string, content string")
    old = spark.createDataFrame([("a", "A"), ("stay", "C"), ("e", "E"), ("a2", "A")], "path string, blob string")
    new = spark.createDataFrame([("x", "A"), ("y", "B"), ("stay", "C"), ("z", "C"), ("w", "D"), ("v", "E")], "path string, blob string")
    of = lambda *a: {(r.source, r.target, r.score, r.status) for r in similarity.renames_and_copies(old, new, contents, *a).collect()}
    assert of(100) == {("a", "x", 100, "R"), ("e", "v", 100, "R")}
    assert of(100, True) == of(100) | {("stay", "z", 100, "C")}
    assert of(70) == {("a", "x", 100, "R"), ("a", "y", 73, "C"), ("a", "w", 82, "C"), ("e", "v", 100, "R")}
    assert similarity.renames_and_copies(old.limit(0), new, contents, 50).isEmpty()


def test_stored_digests(spark):
    rng = random.Random(3)
    names = ["a", "b", "c"]
    make = lambda: {"/".join(rng.choice(names) for _ in range(rng.randrange(1, 5))) + rng.choice("xyz"): rng.randrange(3) for _ in range(40)}
    left = {t: make() for t in range(4)}
    right = {t: dict(v) for t, v in left.items() if t}
    right[2]["a/b/c/new"] = 1
    right[3].pop(sorted(right[3])[0])
    right[5] = make()
    frame = lambda trees: spark.createDataFrame([(t, p, v) for t, e in trees.items() for p, v in e.items()], "tree int, path string, v int")
    a, b = digests.store(frame(left), ["tree"], "v"), digests.store(frame(right), ["tree"], "v")
    got = {(r.tree, r.path): (r.left, r.right) for r in digests.compare(a, b).collect()}
    flat = lambda trees: {(t, p): v for t, e in trees.items() for p, v in e.items()}
    x, y = flat(left), flat(right)
    assert got == {k: (x.get(k), y.get(k)) for k in x.keys() | y.keys() if x.get(k) != y.get(k)}
    opened = {(r.tree, r.folder) for r in digests.differing(a, b).collect()}
    assert not any(t == 1 for t, _ in opened) and (2, "a/b/c") in opened
    plan = digests.compare(a, b)._jdf.queryExecution().toString()
    assert "PartitionFilters: [bucket" in plan or "PartitionFilters: [isnotnull(bucket" in plan, plan[:3000]
    assert digests.compare(a, a).isEmpty()
    empty = digests.store(frame(left).limit(0), ["tree"], "v")
    assert digests.compare(a, empty).count() == len(x) and digests.compare(empty, empty).isEmpty()
    assert digests.compare(a, b).where(F.col("tree") == 1).isEmpty()


def test_the_query_equals_its_sql_where_lines_change_places(spark, tmp_path):
    import duckdb
    from revstrata.plans import registry

    text = {0: "x\ny\n", 1: "a\nb\nc\nd\nzz", 2: "d\nc\nb\na\n", 3: "x\ny\n", 4: None, 5: "", 6: "\n\n\nq", 7: "q\n\n\n\n\n", 8: "ü\nab\nü\ncdefg", 9: "only"}
    spark.createDataFrame([*text.items()], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.queries()["similar_renames"](spark, str(tmp_path)).select("threshold", "source", "target", "score", "status")
    got = {tuple(r) for r in got.collect()}
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert got == set(db.execute(registry.oracle_sql()["similar_renames"]).fetchall())
    assert (100, "old/2", "new/1", 100, "R") in got  # the same lines in another order, which are another blob


def test_texts_of_one_long_and_many_equal_lines(spark):
    frame = lambda *t: spark.createDataFrame([*t], "blob binary, content string")
    old, new = frame((b"\xff", "x\n" * 5000 + "y" * 5000), (b"\x01", "z")), frame((b"\xfe", "x\n" * 4000 + "y" * 5000), (b"\x01", "z"))
    assert [(bytes(r.old), bytes(r.new), r.score) for r in similarity.alike(old, new, 50).collect()] == [(b"\xff", b"\xfe", 86)]
