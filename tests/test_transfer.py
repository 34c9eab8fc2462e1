import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from revstrata.operators import transfer
from revstrata.operators.delta import apply_hunks, line_hunks, pack
from revstrata.sources import bundle

TEXTS = st.lists(st.sampled_from([b"a\n", b"b\n", b"c\n", b"d"]), max_size=12).map(b"".join)
ROWS = "bundle int, version int, place long, section string, path string, node string, p1 string, p2 string, link string, content binary"
CHAIN = "section string, path string, node string, p1 string, p2 string, base string, link string, delta binary"


def node_of(content, p1=None, p2=None):
    a, b = sorted(bytes.fromhex(x or "0" * 40) for x in (p1, p2))
    return hashlib.sha1(a + b + content).hexdigest()


@given(TEXTS, TEXTS, TEXTS)
def test_composed_hunks(a, b, c):
    both = transfer.compose(line_hunks(a, b), line_hunks(b, c))
    assert apply_hunks(a, both) == c


@given(st.lists(TEXTS, min_size=2, max_size=6))
def test_composed_chain_from_nothing(texts):
    whole, before = [], b""
    for now in texts:
        whole, before = transfer.compose(whole, line_hunks(before, now)), now
    assert apply_hunks(b"", whole) == texts[-1]


def history(n=40):
    """A changeset, a manifest and two files a step; every fifth merges the one three before."""
    rows, last = [], {}
    for k in range(n):
        files = {"a": b"".join(b"%d\n" % j for j in range(k, k + 30)), "b c": None if k == 0 else b"\xff\x00" + bytes([k])}
        merges = k if k % 5 == 4 else None
        nodes, made = {}, []
        for path, content in files.items():
            line = last.setdefault(path, [])
            p1, p2 = line[-1] if line else None, line[-3] if merges else None
            nodes[path] = node_of(content or b"", p1, p2)
            made.append(("file", path, nodes[path], p1, p2, content))
        for section, content in (("manifest", None), ("changeset", None)):
            line = last.setdefault(section, [])
            p1, p2 = line[-1] if line else None, line[-3] if merges else None
            content = "".join(f"{p}\0{x}\n" for p, x in nodes.items()).encode() if section == "manifest" else f"{nodes['manifest']}\nme\n{k} 0\na\n\nstep {k}".encode()
            nodes[section] = node_of(content, p1, p2)
            made.append((section, None, nodes[section], p1, p2, content))
        for key in last:
            last[key].append(nodes[key])
        rows += [(k // 16, k, s, p, x, p1, p2, nodes["changeset"], c) for s, p, x, p1, p2, c in made]
    return rows


@pytest.mark.parametrize("spec", ["raw", "gzip-v2"])
def test_history_through_bundles(spark, spec):
    rows = history()
    df = spark.createDataFrame([(r[0], bundle.SPECS[spec][2], *r[1:]) for r in rows], ROWS)
    out = transfer.delta_revisions(df, "bundle")
    assert out.where("delta IS NULL").isEmpty() and out.where("base IS NULL").count() == 4
    data = bundle.encode_revisions(out.withColumn("spec", F.lit(spec)), "bundle", "spec")
    got = transfer.imported(bundle.decode_revisions(data, "bundle"))
    assert {(r.path, r.node): bytes(r.content) for r in got["files"].collect()} == {(r[3], r[4]): r[8] or b"" for r in rows if r[2] == "file"}
    assert {(r.node, r.p1, r.p2, r.body) for r in got["changesets"].collect()} == {(r[4], r[5], r[6], f"step {r[1]}") for r in rows if r[2] == "changeset"}
    assert got["manifests"].count() == 40 and got["entries"].count() == 80
    assert {tuple(r) for r in got["entries"].select("path", "file_node").collect()} == {(r[3], r[4]) for r in rows if r[2] == "file"}


def test_repeated_revisions_and_empty_tables(spark):
    rows = spark.createDataFrame([(r[0], 2, *r[1:]) for r in history(6)], ROWS)
    twice = rows.unionByName(rows).withColumn("extra", F.lit(1))
    assert transfer.delta_revisions(twice, "bundle").count() == 24
    none = transfer.delta_revisions(rows.limit(0), "bundle")
    assert none.count() == 0 and transfer.texts(none).count() == 0


def test_known_bases_long_chains_and_faults(spark):
    texts = [b"x\n" * k for k in range(100)]
    nodes = [node_of(t) for t in texts]
    chain = [("file", "f", nodes[k], None, None, nodes[k - 1], nodes[0], pack(line_hunks(texts[k - 1], texts[k]))) for k in range(1, 100)]
    known = spark.createDataFrame([("file", "f", nodes[0], texts[0])], "section string, path string, node string, content binary")
    rows = spark.createDataFrame(chain, CHAIN)
    got = {r.node: bytes(r.content) for r in transfer.texts(rows, known).collect()}
    assert got == dict(zip(nodes, texts, strict=True))
    assert transfer.checked_revisions(rows, known).count() == 99
    with pytest.raises(Exception, match="base is missing"):
        transfer.texts(rows).collect()
    circle = spark.createDataFrame([("file", "f", a, None, None, b, nodes[0], b"") for a, b in ((nodes[1], nodes[2]), (nodes[2], nodes[1]))], CHAIN)
    with pytest.raises(ValueError, match="circle"):
        transfer.texts(circle)
    false = spark.createDataFrame([("file", "f", nodes[1], None, None, None, nodes[0], pack([(0, 0, b"other")]))], CHAIN)
    with pytest.raises(Exception, match="another content"):
        transfer.checked_revisions(false).collect()
    lost = spark.createDataFrame([("file", "f", nodes[1], None, None, None, nodes[2], pack([(0, 0, texts[1])]))], CHAIN)
    with pytest.raises(Exception, match="no changeset"):
        transfer.imported(lost)["files"].collect()


def test_header_of_a_copied_file(spark):
    text = b"\x01\ncopy: a\ncopyrev: 00\n\x01\nbody \xff"
    change = f"{'0' * 40}\nme\n0 0\n\nx".encode()
    rows = [("changeset", None, node_of(change), None, None, None, node_of(change), pack([(0, 0, change)])), ("file", "f", node_of(text), None, None, None, node_of(change), pack([(0, 0, text)]))]
    r = transfer.imported(spark.createDataFrame(rows, CHAIN))["files"].first()
    assert r.header == "copy: a\ncopyrev: 00\n" and bytes(r.content) == b"body \xff"
