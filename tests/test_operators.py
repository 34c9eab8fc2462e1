import random

import pytest
from pyspark.sql import functions as F
from revstrata.functions import authorship, text
from revstrata.operators import dag, delta, integrity, mapping, paths, refs, snapshots, tags


def _graph(spark, parents):
    rows = [(k, *(list(p) + [None, None])[:2]) for k, p in enumerate(parents)]
    nodes = spark.createDataFrame(rows, "rev int, p1 int, p2 int")
    return nodes, dag.edges_of(nodes)


def _revs(df):
    return {r.rev for r in df.collect()}


def _random_parents(n, seed):
    rnd = random.Random(seed)
    return [tuple(rnd.sample(range(k), min(k, rnd.choice([0, 1, 1, 2])))) for k in range(n)]


def test_traversals_against_brute_force(spark):
    parents = _random_parents(40, 3)
    nodes, edges = _graph(spark, parents)

    def up(starts):
        seen = set(starts)
        for k in range(39, -1, -1):
            if k in seen:
                seen |= set(parents[k])
        return seen

    def down(starts):
        seen = set(starts)
        for k in range(40):
            if set(parents[k]) & seen:
                seen.add(k)
        return seen

    starts = [30, 35, 99]
    of = lambda xs: spark.createDataFrame([(x,) for x in xs], "rev int")
    assert _revs(dag.ancestors(nodes, edges, of(starts))) == up([30, 35])
    assert _revs(dag.descendants(nodes, edges, of([2, 5]))) == down([2, 5])
    assert _revs(dag.descendants(nodes, edges, of([2, 99]))) == set()
    assert _revs(dag.rev_range(nodes, edges, of([39, 30]), of([20]))) == up([39, 30]) - up([20])
    assert _revs(dag.heads(nodes, edges)) == set(range(40)) - {p for ps in parents for p in ps}
    assert _revs(dag.roots(nodes, edges)) == {k for k, ps in enumerate(parents) if not ps}
    depth = []
    for ps in parents:
        depth.append(1 + max(depth[p] for p in ps) if ps else 0)
    assert {r.rev: r.depth for r in dag.generation(nodes, edges).collect()} == dict(enumerate(depth))
    pairs = spark.createDataFrame([(a, b) for a in (0, 3, 7) for b in (7, 20, 39)], "a int, b int")
    assert {(r.a, r.b): r.is_ancestor for r in dag.is_ancestor(nodes, edges, pairs).collect()} == {(a, b): a in up([b]) for a in (0, 3, 7) for b in (7, 20, 39)}


def test_empty_graph_and_duplicates(spark):
    nodes, edges = _graph(spark, [])
    assert dag.heads(nodes, edges).isEmpty() and dag.generation(nodes, edges).isEmpty()
    twice = spark.createDataFrame([(1, None, None), (1, None, None)], "rev int, p1 int, p2 int")
    with pytest.raises(Exception, match="twice"):
        dag.assert_unique(twice).collect()


def test_tree_order_and_three_way(spark):
    r = spark.createDataFrame([("a", True), ("a", False), ("a.b", False), ("a0", False)], "p string, t boolean").orderBy(paths.tree_key(F.col("p"), F.col("t"))).collect()
    assert [(x.p, x.t) for x in r] == [("a", False), ("a.b", False), ("a", True), ("a0", False)]
    of = lambda d: spark.createDataFrame(list(d.items()), "path string, f string")
    m, x, y = of({"same": "1", "one": "2", "both": "3", "new": "4"}), of({"same": "1", "one": "2", "both": "0"}), of({"same": "1", "one": "9", "both": "8", "gone": "7"})
    rows = {r.path: (r.new, r.first, r.second) for r in paths.three_way(m, x, y, ["path"], "f").collect()}
    assert rows == {"both": ("3", "0", "8"), "new": ("4", None, None)}
    rows = {r.path: (r.new, r.first, r.second) for r in paths.three_way(m, x, y, ["path"], "f", one_sided=True).collect()}
    assert rows["one"] == ("2", "2", "9") and rows["gone"] == (None, None, "7") and "same" not in rows
    assert paths.diff_by_directory(m, x, ["path"], "path", "f").count() == paths.diff(m, x, ["path"], "f").count() == 2


def test_abbreviations(spark):
    m = spark.createDataFrame([("abc1", "x"), ("abd2", "y"), ("b000", "z")], "k string, v string")
    p = spark.createDataFrame([("AB",), ("abc",), ("b",), ("f",)], "p string")
    assert {r.p: r.v for r in mapping.resolve_abbreviations(p, m, "p", "k", "v").collect()} == {"AB": None, "abc": "x", "b": "z", "f": None}


def test_tag_fold_against_a_loop(spark):
    rnd = random.Random(5)
    rows = []
    for head in range(5):
        for tag in "tuv":
            hist = sorted(rnd.sample("abcde", rnd.randint(0, 3)))
            rows.append((head, tag, rnd.choice("abcde"), hist))
    held = {}
    for _, tag, a, ah in rows:
        if tag not in held:
            held[tag] = (a, set(ah))
            continue
        b, bh = held[tag]
        keep = b != a and a in bh and (b not in ah or len(bh) > len(ah))
        held[tag] = (b if keep else a, bh | set(ah))
    got = tags.merged(spark.createDataFrame(rows, "rank int, tag string, node string, hist array<string>")).collect()
    assert {r.tag: (r.node, set(r.hist)) for r in got} == held


def test_tags_in_file(spark):
    rows = [("f", "t", 1, "a"), ("f", "t", 2, "b"), ("f", "t", 3, "a"), ("f", "u", 4, None)]
    got = {r.tag: (r.node, r.hist) for r in tags.tags_in_file(spark.createDataFrame(rows, "file string, tag string, line int, node string")).collect()}
    assert got == {"t": ("a", ["a", "b"]), "u": ("", [])}


def test_tips(spark):
    rows = [("x", 1, True), ("x", 2, False), ("x", 3, True), ("y", 4, True), ("y", 5, True)]
    assert {r.branch: r.rev for r in refs.tips(spark.createDataFrame(rows, "branch string, rev int, closed boolean")).collect()} == {"x": 2, "y": 4}


def test_compare_and_set(spark):
    held = spark.createDataFrame([("a", "1"), ("b", "2")], "name string, oid string")
    ok = spark.createDataFrame([("a", "1", "9"), ("b", "2", None), ("c", None, "3")], "name string, old string, new string")
    assert {(r.name, r.oid) for r in refs.compare_and_set(held, ok).collect()} == {("a", "9"), ("c", "3")}
    with pytest.raises(Exception, match="lost race"):
        refs.compare_and_set(held, spark.createDataFrame([("a", "0", "9")], "name string, old string, new string")).collect()


def test_deltas():
    rnd = random.Random(2)
    lines = [b"foo\n", b"bar\n", b"baz\n", b"qux\n", b"", b"end"]
    for _ in range(300):
        a, b = (b"".join(rnd.choice(lines) for _ in range(rnd.randint(0, 9))) for _ in range(2))
        for make in (delta.line_hunks, delta.byte_hunks):
            hunks = make(a, b)
            assert delta.apply_hunks(a, delta.unpack(delta.pack(hunks))) == b
    with pytest.raises(ValueError):
        delta.apply_hunks(b"abc", [(2, 1, b"")])
    with pytest.raises(ValueError):
        delta.apply_hunks(b"abc", [(0, 9, b"")])


def test_authorship(spark):
    cases = {"Foo Bar <foo@bar>": ("Foo Bar", "foo@bar"), "foo@bar": ("", "foo@bar"), "Foo": ("Foo", ""), "<foo@bar>": ("", "foo@bar"), "a<b": ("ab", "")}
    rows = spark.createDataFrame([(c,) for c in cases], "s string").select("s", authorship.name_and_email(F.col("s")).alias("a")).collect()
    assert {r.s: (r.a.name, r.a.email) for r in rows} == cases
    offsets = {"+0900": -32400, "-0300": 10800, "-1100": 39600, "-900": -900, "-1800": -1800, "7200": 7200, "-3600": -3600}
    rows = spark.createDataFrame([(c,) for c in offsets], "s string").select("s", authorship.committer_offset(F.col("s")).alias("w")).collect()
    assert {r.s: r.w for r in rows} == offsets


def test_text_codecs(spark):
    r = spark.createDataFrame([("a:b,c;d=e f+g%",)], "s string").select(
        text.batch_escape(F.col("s")).alias("e"), text.batch_unescape(text.batch_escape(F.col("s"))).alias("b"), text.percent_encode(F.col("s")).alias("p"), text.percent_decode(text.percent_encode(F.col("s"))).alias("q")
    ).first()
    assert r.b == r.q == "a:b,c;d=e f+g%" and r.e == "a:cb:oc:sd:ee f+g%" and " " not in r.p and "%20" in r.p
    bad = {"tip": True, "123": True, "a:b": True, " a": True, "": True, "ok-1": False}
    rows = spark.createDataFrame([(b,) for b in bad], "s string").select("s", text.bad_label(F.col("s")).alias("b")).collect()
    assert {x.s: x.b for x in rows} == bad


def test_snapshots(spark):
    none = spark.createDataFrame([], "snapshot_id string, prev_id string, status string, components array<string>")
    s, at = snapshots.add_snapshot(none, None, ["a", "b"], "s1")
    s, at = snapshots.add_snapshot(s, at, ["a", "c"], "s2")
    same, still = snapshots.add_snapshot(s, at, ["a", "c"], "s3")
    assert still == "s2" and same.count() == 2
    start = s.where("snapshot_id = 's2'").select("snapshot_id")
    assert [(r.snapshot_id, r.step) for r in snapshots.candidates(s, start).orderBy("step").collect()] == [("s2", 0), ("s1", 1)]
    assert snapshots.rollback(s, "s2", "s1") == "s1" and snapshots.rollback(s, "s2", None) is None
    with pytest.raises(ValueError):
        snapshots.rollback(s, "s1", "s2")


def test_checks(spark):
    n = spark.createDataFrame([(0, None, None), (1, 0, 9), (2, 5, None), (5, 0, None)], "rev int, p1 int, p2 int")
    assert {(r.rev, r.parent) for r in integrity.missing_parents(n).collect()} == {(1, 9), (2, 5)}
    assert integrity.self_replacements(spark.createDataFrame([("a", "a"), ("a", "b")], "original string, replacement string")).count() == 1
