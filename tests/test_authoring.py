import hashlib
import random

import pytest
from pyspark.sql import functions as F

from revstrata.functions import identity, text
from revstrata.operators import changesets, dag, ordering, paths, refs, tags


def _sha(*parts):
    return hashlib.sha1(b"".join(p if isinstance(p, bytes) else p.encode() for p in parts)).hexdigest()


def test_changeset_and_note_round_trip(spark):
    rows = spark.createDataFrame([("m", "me <a@b>", "1 0", ["z", "a"], "body\n\nmore"), ("m", "x", "2 0", [], "")], "m string, a string, d string, f array<string>, b string")
    raw = rows.select(changesets.changeset_text(F.col("m"), F.col("a"), F.col("d"), F.col("f"), F.col("b")).alias("raw"))
    texts = [r.raw for r in raw.collect()]
    assert texts == ["m\nme <a@b>\n1 0\na\nz\n\nbody\n\nmore", "m\nx\n2 0\n\n"]
    back = [r.c for r in raw.select(text.split_changeset(F.col("raw")).alias("c")).collect()]
    assert (back[0].files, back[0].body, back[1].files, back[1].body) == (["a", "z"], "body\n\nmore", [], "")
    notes = spark.createDataFrame([("changeset abc\nauthor a b",), ("changeset abc\nodd x",), ("changeset",)], "n string")
    parsed = [r.p for r in notes.select(changesets.parse_note(F.col("n")).alias("p")).collect()]
    assert parsed == [{"changeset": "abc", "author": "a b"}, None, None]


def test_conflicts_are_spread(spark):
    rows = [(1, "x"), (2, "x\n"), (3, "x"), (4, "y"), (5, "x"), (6, "x\n\n\n\n\n\n"), (7, None), (8, "y")]
    got = {r.rev: r.text for r in changesets.spread_conflicts(spark.createDataFrame(rows, "rev long, text string")).collect()}
    assert got == {1: "x", 3: "x\n", 5: "x\n\n", 2: "x\n\n\n", 6: "x\n\n\n\n\n\n", 4: "y", 8: "y\n", 7: None}


def test_graft_against_a_loop(spark):
    rng = random.Random(5)
    kind = "tree int, ts int, subject string, author string"
    new = [(k, rng.randrange(6), rng.randrange(3), rng.choice("stu"), rng.choice("ab")) for k in range(80)]
    old = [(k, rng.randrange(6), rng.randrange(3), rng.choice("stu"), rng.choice("ab"), rng.random() < 0.5) for k in range(60)]
    got = {r.rev: (r.commit, r.candidates) for r in changesets.graft(spark.createDataFrame(new, f"rev int, {kind}"), spark.createDataFrame(old, f"commit int, {kind}, own boolean")).collect()}
    want, taken = {}, set()
    for rev, *key in new:
        c = [o for o in old if list(o[1:3]) == key[:2]]
        if len(c) > 1:
            s = [o for o in c if o[3] == key[2]]
            if len(s) > 1:
                s = [o for o in s if o[4] == key[3]]
            c = s if len(s) == 1 else c
        n = len(c)
        if len(c) > 1:
            c = [o for o in c if not o[5]]
        commit = c[0][0] if len(c) == 1 and c[0][0] not in taken else None
        taken.add(c[0][0] if len(c) == 1 else None)
        want[rev] = (commit, n)
    assert got == want


def test_branches_against_a_loop(spark):
    rng = random.Random(3)
    n = 60
    parents = {k: sorted(rng.sample(range(max(0, k - 6), k), min(k, rng.choice([0, 1, 1, 1, 2]))), reverse=True) for k in range(n)}
    known = {k: rng.random() < 0.3 for k in range(n)}
    rows = [(k, (p + [None, None])[0], (p + [None, None])[1], f"b{k % 4}", known[k]) for k, p in parents.items()]
    nodes = spark.createDataFrame(rows, "rev long, p1 long, p2 long, branch string, known boolean")
    pushes = [(59, "one", 0), (50, "two", 1), (55, "three", 2)]
    got = {r.rev: (r.branch, r.kind) for r in dag.infer_branches(nodes, dag.edges_of(nodes), spark.createDataFrame(pushes, "rev long, branch string, order int")).collect()}
    info = {}
    for k in range(n):
        p = parents[k][0] if parents[k] else None
        info[k] = (f"b{k % 4}", "known") if known[k] else ((info[p][0] if p is not None else None), "inferred")
    for start, name, _ in pushes:
        todo, seen = [start], set()
        while todo:
            k = todo.pop()
            if k in seen or info[k][1] != "inferred":
                continue
            seen.add(k)
            info[k] = (name, "set")
            todo += parents[k]
    assert got == info


def test_rewrite_and_discovery(spark):
    rng = random.Random(9)
    n = 40
    parents = {k: sorted(rng.sample(range(k), min(k, rng.choice([0, 1, 2]))), reverse=True) for k in range(n)}
    rows = [(k, _sha(str(k)), (p + [None, None])[0], (p + [None, None])[1], f"c{k}") for k, p in parents.items()]
    nodes = spark.createDataFrame(rows, "rev long, node string, p1 long, p2 long, content string")
    inside = {k for k in range(n) if k % 3 != 1}
    got = {r.rev: r.new_node for r in dag.rewrite(nodes, nodes.where("rev % 3 <> 1"), identity.node_of).collect()}
    now = {k: _sha(str(k)) for k in range(n)}
    for k in sorted(inside):
        a, b = sorted(([now[p] for p in parents[k]] + ["0" * 40] * 2)[:2])
        now[k] = _sha(bytes.fromhex(a), bytes.fromhex(b), f"c{k}")
    assert got == {k: now[k] for k in inside}
    edges = dag.edges_of(nodes)
    remote = dag.ancestors(nodes, edges, nodes.where("rev in (30, 17, 5)"))
    want = {r.rev for r in dag.heads(remote, edges).collect()}
    assert {r.rev for r in dag.discover(nodes, edges, remote, sample=4).collect()} == want
    assert dag.discover(nodes.limit(0), edges, remote).count() == 0


def test_merged_manifest(spark):
    kind = "path string, file_node string, oid string, attr string"
    files = spark.createDataFrame([("a", "1", ""), ("b", "9", ""), ("new", "5", ""), ("one", "1", "x"), ("two", "2", ""), ("old", "3", "")], "path string, oid string, attr string")
    first = spark.createDataFrame([("a", "f1", "1", ""), ("b", "f2", "2", ""), ("gone1", "f3", "3", ""), ("one", "f1", "1", ""), ("old", "f8", "8", "")], kind)
    second = spark.createDataFrame([("a", "f1", "1", ""), ("b", "f4", "4", ""), ("gone2", "f5", "5", ""), ("two", "f6", "2", ""), ("old", "f3", "3", "")], kind)
    ancestry = spark.createDataFrame([("old", "f8", "f3")], "path string, a string, b string")
    got = {r.path: (r.parents, r.file_node, r.listed) for r in paths.merged_manifest(files, first, second, ["path"], ancestry).collect()}
    assert got == {
        "a": (["f1"], "f1", False), "b": (["f2", "f4"], None, True), "new": ([], None, True), "one": (["f1"], "f1", True),
        "two": (["f6"], "f6", False), "old": (["f3"], "f3", False), "gone1": (None, None, True),
    }
    plain = {r.path: r.parents for r in paths.merged_manifest(files, first, second, ["path"]).collect()}
    assert plain["old"] == ["f8", "f3"] and plain["new"] == []


def test_trees(spark):
    blob = _sha("blob 2\0a\n")
    rows = [("r", "a", "100644", blob), ("r", "d/x", "100755", blob), ("r", "d/e/y", "120000", blob), ("r", "d.c", "100644", blob)]
    got = {r.path: r.oid for r in paths.tree_objects(spark.createDataFrame(rows, "repo string, path string, mode string, oid string"), ["repo"]).collect()}

    def tree(*entries):
        body = b"".join(f"{m} {n}\0".encode() + bytes.fromhex(o) for m, n, o in entries)
        return _sha(f"tree {len(body)}\0", body)

    e = tree(("120000", "y", blob))
    d = tree(("40000", "e", e), ("100755", "x", blob))
    assert got == {"d/e": e, "d": d, "": tree(("100644", "a", blob), ("100644", "d.c", blob), ("40000", "d", d))}
    messy = spark.createDataFrame([(1, "a//b", "x"), (1, "a/b", "y"), (1, "c///d", "z")], "k int, path string, v string")
    assert {(r.path, r.v) for r in paths.clean_paths(messy, ["k"]).collect()} == {("a/b", "y"), ("c/d", "z")}


def test_names_tags_and_policies(spark):
    urls = spark.createDataFrame([("https://u@host:80/a/b/?q",), ("hg://host",)], "u string")
    assert [r.b for r in urls.select(text.metadata_branches(F.col("u")).alias("b")).collect()] == [["b", "a/b", "host/a/b", "metadata"], ["host", "metadata"]]
    caps = spark.createDataFrame([("HG20\nbundle2=HG20,a%2Cb\n",)], "c string").select(text.decode_capabilities(F.col("c")).alias("m"))
    assert caps.first().m == {"HG20": None, "bundle2": ["HG20", "a,b"]}
    assert caps.select(text.encode_capabilities(F.col("m")).alias("c")).first().c == "HG20\nbundle2=HG20,a%2Cb"
    now = spark.createDataFrame([("a", "n1"), ("b", "n2"), ("d", "")], "tag string, node string")
    lines = tags.tag_lines_for(now, spark.createDataFrame([("a", "n3"), ("b", ""), ("c", "n4"), ("d", "")], "tag string, node string"))
    assert {(r.tag, r.line, r.node) for r in lines.collect()} == {("a", 0, "n1"), ("a", 1, "n3"), ("b", 0, "n2"), ("b", 1, ""), ("c", 1, "n4")}
    assert tags.same_tags(now, now.where("tag <> 'd'")) and not tags.same_tags(now, now.where("tag = 'a'"))
    known = spark.createDataFrame([("n1", "g1")], "hg string, git string")
    assert {r.line for r in refs.tag_list(now, known, "%(objectname) %(tagname)").collect()} == {"g1 a", "0" * 40 + " b"}
    with pytest.raises(ValueError):
        refs.tag_list(now, known, "%(other)")
    pushed, drafts = spark.createDataFrame([(1,), (2,)], "rev int"), spark.createDataFrame([(2,)], "rev int")
    assert [refs.retained(pushed, drafts, p).count() for p in ("never", "phase", "always", "force")] == [0, 1, 2, 2]
    with pytest.raises(ValueError):
        refs.retained(pushed, drafts, "sometimes")


def test_orders(spark):
    rows = spark.range(1000).select(((F.col("id") * 7919) % 1000).alias("k"))
    got = ordering.numbered(rows, ["k"], parts=7).collect()
    assert len(got) == 1000 and all(r.k == r.number for r in got)
    assert ordering.batches(rows.limit(0), ["k"], 10).count() == 0
    a, b = ({r.k for r in ordering.sample_of(rows.repartition(n), "k", 50).collect()} for n in (1, 9))
    assert a == b and len(a) == 50
    texts = spark.createDataFrame([(1, "ab\n\nc"), (2, ""), (3, None), (4, "é\n")], "id int, text string")
    assert sorted(tuple(r) for r in ordering.line_offsets(texts, "id").collect()) == [(1, 0, 0, 3), (1, 1, 3, 1), (1, 2, 4, 1), (4, 0, 0, 3)]
