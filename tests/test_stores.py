import hashlib
import random

import pytest
from pyspark.sql import functions as F
from revstrata.functions import text
from revstrata.operators import dag, delta, history, mapping, objects, refs, store
from revstrata.sources import bundle


def _raises(df, what):
    with pytest.raises(Exception, match=what):
        df.collect()


def test_runs_against_brute_force(spark):
    rnd = random.Random(8)
    parents = [()] + [tuple({k - 1} if rnd.random() < 0.8 else set(rnd.sample(range(k), min(k, rnd.choice([0, 1, 2]))))) for k in range(1, 70)]
    nodes = spark.createDataFrame([(k, *(sorted(p) + [None, None])[:2]) for k, p in enumerate(parents)], "rev int, p1 int, p2 int")
    edges = dag.edges_of(nodes)
    depth = []
    for p in parents:
        depth.append(1 + max(depth[x] for x in p) if p else 0)
    assert {r.rev: r.depth for r in dag.generation(nodes, edges).collect()} == dict(enumerate(depth))
    up = [{k}.union(*[()]) for k in range(70)]
    for k, p in enumerate(parents):
        for x in p:
            up[k] |= up[x]
    some = rnd.sample(range(70), 6)
    of = lambda xs: spark.createDataFrame([(x,) for x in xs], "rev int")
    assert {r.rev for r in dag.ancestors(nodes, edges, of(some)).collect()} == set().union(*[up[k] for k in some])
    assert {r.rev for r in dag.descendants(nodes, edges, of(some[:2])).collect()} == {k for k in range(70) if up[k] & set(some[:2])}
    pairs = [(a, b) for a in some for b in some]
    got = {(r.a, r.b): r.is_ancestor for r in dag.is_ancestor(nodes, edges, spark.createDataFrame(pairs, "a int, b int")).collect()}
    assert got == {(a, b): a in up[b] for a, b in pairs}


def test_typed_errors(spark):
    held = spark.createDataFrame([("file", "x", "o1")], "kind string, id string, oid string")
    known = spark.createDataFrame([("o1", "blob"), ("c1", "commit")], "oid string, kind string")
    change = lambda *r: spark.createDataFrame([r], "kind string, id string, oid string")
    assert store.set_typed(held, change("file", "x", None), known).isEmpty()
    assert store.set_typed(held, change("changeset", "y", "c1"), known).count() == 2
    for bad in (("file", "x", "c1"), ("file", "x", "lost"), ("other", "x", "o1")):
        _raises(store.set_typed(held, change(*bad), known), "invalid object")
    _raises(store.replacements(spark.createDataFrame([("a", "b"), ("a", "c")], "original string, replacement string")), "duplicate")
    assert store.replacements(spark.createDataFrame([("a", "a")], "original string, replacement string")).isEmpty()
    _raises(history.wanted_refs(spark.createDataFrame([("r",)], "name string"), spark.createDataFrame([], "name string, node string")), "no such ref")


def test_pointer(spark):
    rows = spark.createDataFrame([("s1", None, "", ["a"]), ("s2", "s1", "", ["b"]), ("x", None, "", ["c"])], "snapshot_id string, prev_id string, status string, components array<string>")
    moved, at = store.moved_pointer(rows, "s2", "s1", "checked")
    assert at == "s1" and {r.snapshot_id: r.status for r in moved.collect()} == {"s1": "checked", "s2": "", "x": ""}
    assert store.moved_pointer(rows, "s2", None)[1] is None
    with pytest.raises(ValueError):
        store.moved_pointer(rows, "s2", "x")


def test_objects(spark):
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(objects.parse_commit(F.lit("tree t\nauthor a b\n\nbody"))) is None and one(objects.parse_commit(F.lit("tree t"))) is None
    got = one(objects.parse_commit(F.lit("tree t\nparent p\nparent q\nauthor a b\ncommitter c d\nmergetag x\n\nb\n\nc")))
    assert (got.tree, list(got.parents), got.author, got.committer, got.body) == ("t", ["p", "q"], "a b", "c d", "b\n\nc")
    assert one(objects.parse_patch(F.lit("1,2"))) is None and one(objects.parse_patch(F.lit("a,2,x"))) is None
    hunks = lambda *h: F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(d).alias("data")) for a, b, d in h])
    assert bytes(one(objects.apply_patch(F.lit("aébc"), hunks((0, 1, ""), (3, 4, "ñ"))))).decode() == "éñc"
    for bad in (((2, 1, ""),), ((0, 2, ""), (1, 2, "")), ((0, 9, ""),)):
        assert one(objects.apply_patch(F.lit("abc"), hunks(*bad))) is None
    assert objects.EMPTY_FILE == hashlib.sha1(b"\0" * 40).hexdigest()
    whole = objects.full_files(spark.createDataFrame([(objects.EMPTY_FILE,)], "node string"), spark.createDataFrame([], "node string, content string"), spark.createDataFrame([], "node string, header string"))
    assert bytes(whole.first().content) == b""
    for bad in (b"100644 a\0short", b"1006x4 a\0" + b"0" * 20, b"100644 \0" + b"0" * 20):
        _raises(objects.tree_entries(spark.createDataFrame([(1, bytearray(bad))], "tree int, content binary")), "malformed")


def test_addresses(spark):
    vectors = {
        "http://foo.com/foo": None, "hg::https://foo.com/foo": "https://foo.com/foo", "hg::tags:": "tags:", "hg://:tags": "tags:", "/foo/bar": None, "hg::file:///foo/bar": "file:///foo/bar", "hg://:file/foo/bar": "file:///foo/bar",
        "hg::/foo/bar": "file:///foo/bar", "hg://foo.com/foo": "https://foo.com/foo", "hg://foo.com:8443/foo": "https://foo.com:8443/foo", "hg://foo.com:http/foo": "http://foo.com/foo", "hg://foo.com:8080.http/foo": "http://foo.com:8080/foo",
    }
    rows = spark.createDataFrame([(x,) for x in vectors], "a string").select("a", text.plain_url(F.col("a")).alias("u")).collect()
    assert {r.a: r.u for r in rows} == vectors
    cut = spark.createDataFrame([("a b c",), ("a",), ("",)], "t string").select(text.split_exactly(F.col("t"), " ", 2).alias("x"), text.split_exactly(F.col("t"), " ", 2, True).alias("y")).collect()
    assert [(r.x, r.y) for r in cut] == [(["a", "b c"], ["a b", "c"]), (None, None), (None, None)]
    lines = ["https://a#b graft=" + "0" * 40, "https://a x=1", "https://a graft=zz", "", "no", "https://a"]
    parsed = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "place int, l string").select("place", text.clone_line(F.col("l")).alias("c")).where("c IS NOT NULL").select("place", "c.*")
    assert [(r.url, r.branch) for r in refs.clone_source(parsed).collect()] == [("https://a", "b")]
    assert [(r.url, r.branch) for r in refs.clone_source(parsed, graft=False).collect()] == [("https://a", None)]
    assert [(r.url, r.branch) for r in refs.clone_source(parsed, known=spark.createDataFrame([], "oid string")).collect()] == [("https://a", None)]


def test_hunks_of_long_texts_without_lines_of_their_own():
    """Two letters on 20,000 lines, with edits far apart: no line occurs once, runs do."""
    rng = random.Random(5)
    lines = [rng.choice([b"x\n", b"y\n"]) for _ in range(20_000)]
    new = [b"new\n", *lines[:5_000], b"x\n", b"x\n", *lines[5_040:12_000], *lines[12_003:], b"end\n"]
    a, b = b"".join(lines), b"".join(new)
    hunks = delta.line_hunks(a, b)
    assert delta.apply_hunks(a, hunks) == b and sum(len(d) for _, _, d in hunks) < 600
    same, other = b"x\n" * 3_000, b"x\n" * 2_500 + b"y\n" + b"x\n" * 700
    assert delta.apply_hunks(same, delta.line_hunks(same, other)) == other
    for _ in range(60):
        a, b = (b"".join(rng.choice([b"x\n", b"y\n", b"z"]) for _ in range(rng.randrange(0, 1_400))) for _ in range(2))
        assert delta.apply_hunks(a, delta.line_hunks(a, b)) == b


def test_line_hunks():
    rnd = random.Random(2)
    for n in (0, 1, 5, 40, 1500):
        old = [b"%d\r\n" % rnd.randrange(10**6) if rnd.random() < 0.9 else b"same\n" for _ in range(n)]
        new = [x if rnd.random() < 0.7 else b"new %d\n" % rnd.randrange(99) for x in old if rnd.random() < 0.95]
        a, b = b"".join(old), b"".join(new)[: -1 if rnd.random() < 0.5 else None]
        hunks = delta.line_hunks(a, b)
        assert delta.apply_hunks(a, hunks) == b and all(s == 0 or a[s - 1 : s] == b"\n" for s, _, _ in hunks)
    assert delta.line_hunks(b"a\rb\nc\n", b"a\rx\nc\n") == [(0, 4, b"a\rx\n")]
    a, b = b"".join(b"%d\n" % k for k in range(60_000)), b"".join(b"%d\n" % (k if k % 50 else -k) for k in range(60_000))
    assert sum(len(d) for _, _, d in delta.line_hunks(a, b)) < 20_000 and delta.apply_hunks(a, delta.line_hunks(a, b)) == b


def test_bundles_of_odd_keys(spark):
    rows = spark.createDataFrame([("a:b,c", 2, bytearray(b"x\n")), ("a:b,c", 1, None), ("", -3, bytearray(b""))], "k string, n long, c binary")
    back = bundle.decode(bundle.encode(rows, "k", "n", "c")).collect()
    assert sorted((r.k, r.seq, bytes(r.content)) for r in back) == [("", -3, b""), ("a:b,c", 1, b""), ("a:b,c", 2, b"x\n")]


def test_abbreviations(spark):
    keys = spark.createDataFrame([("ab" * 20, 1), ("ac" * 20, 2), ("b0" * 20, 3)], "k string, v int")
    asked = spark.createDataFrame([("A",), ("ab",), ("B",), ("c",), ("",), ("ab" * 20,), ("ab" * 21,), (None,)], "p string")
    got = {r.p: r.v for r in mapping.resolve_abbreviations(asked, keys, "p", "k", "v").collect()}
    assert got == {"A": None, "ab": 1, "B": 3, "c": None, "": None, "ab" * 20: 1, "ab" * 21: None, None: None}
    assert mapping.resolve_abbreviations(asked.limit(0), keys, "p", "k", "v").columns == ["p", "k", "v"]


def test_manifest_misfit(spark):
    parent = spark.createDataFrame([(1, "a", "00", "")], "k int, path string, file_node string, attr string")
    change = lambda *r: spark.createDataFrame([r], "k int, path string, status string, source string, old_oid string, oid string, attr string, content string")
    for bad in ((1, "b", "D", None, None, None, None, None), (1, "b", "M", None, "x", "y", "", "t"), (1, "b", "R", "z", None, "y", "", "t")):
        _raises(history.manifest_of_diff(parent, change(*bad), ["k"]), "does not fit")
    empty = history.manifest_of_diff(parent, change(1, "b", "R", "a", None, history.EMPTY_BLOB, "", ""), ["k"]).collect()
    assert {(r.path, r.file_node, r.listed) for r in empty} == {("a", None, True), ("b", objects.EMPTY_FILE, True)}
