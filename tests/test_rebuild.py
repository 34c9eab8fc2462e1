import pytest
from pyspark.sql import functions as F
from revstrata.functions.identity import node_of
from revstrata.operators import peer, rebuild, store
from revstrata.operators.changesets import parse_note
from revstrata.operators.session import Store

M, A = "1" * 40, "Á B <a@b> 100 +0100"


def commit(body, author=A, committer=A, parents=()):
    return "\n".join([f"tree {M}", *[f"parent {p}" for p in parents], f"author {author}", f"committer {committer}"]) + "\n\n" + body


def changeset(body, author="Á B <a@b>", date="100 -3600", files=("a", "b")):
    return "\n".join([M, author, date, *files]) + "\n\n" + body


PAIRS = {
    "plain": (commit("x"), changeset("x")),
    "no files, empty body": (commit(""), changeset("", files=())),
    "author": (commit("x"), changeset("x", author="someone odd")),
    "extra": (commit("x"), changeset("x", date="100 -3600 branch:b c\0close:1")),
    "committer": (commit("x", committer="C <c@d> 7 -0230"), changeset("x", date="100 -3600 committer:C <c@d> 7 9000")),
    "committer and branch": (commit("x", committer="C <c@d> 7 -0230"), changeset("x", date="100 -3600 branch:b\0committer:C <c@d> 7 9000")),
    "another committer": (commit("x", committer="C <c@d> 7 -0230"), changeset("x", date="100 -3600 committer:D 8 0")),
    "no name": (commit("x", author=" <> 0 +0000", committer=" <> 0 +0000"), changeset("x", author="<>", date="0 0")),
    "patch inside a letter": (commit("é"), changeset("è", files=("z", "a"))),
    "long": (commit("line\n" * 20000), changeset("line\n" * 19999 + "end")),
}


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([(k, c, node_of(None, None, t.encode()), t) for k, (c, t) in PAIRS.items()], "oid string, raw string, node string, text string")


def test_notes_and_texts_there_and_back(spark, pairs):
    none = spark.createDataFrame([], "git string, hg string")
    notes = rebuild.notes_for(pairs)
    got = {r.oid: (r.node, r.text) for r in rebuild.rebuilt(pairs.select("oid", "raw"), notes.select("oid", "note"), none).collect()}
    assert got == {k: (node_of(None, None, t.encode()), t) for k, (_, t) in PAIRS.items()}
    fields = {r.oid: r.f for r in notes.select("oid", parse_note(F.col("note")).alias("f")).collect()}
    assert set(fields["plain"]) == {"changeset", "manifest", "files"} and "author" in fields["author"] and fields["committer and branch"]["extra"] == "branch:b"
    assert "extra" not in fields["committer"] and fields["another committer"]["extra"].startswith("committer:D")
    assert {k for k, f in fields.items() if "patch" in f} == {"patch inside a letter", "long"}


def test_what_cannot_be_read(spark, pairs):
    none = spark.createDataFrame([], "git string, hg string")
    note = f"changeset {M}\nmanifest {M}"
    rows = [("gone", None, note), ("no header", "text", note), ("no manifest", commit("x"), f"changeset {M}"), ("bad key", commit("x"), note + "\nwhat ever"), ("no note", commit("x"), None),
            ("bad patch", commit("x"), note + "\npatch 1,x,y"), ("far patch", commit("x"), note + "\npatch 9000,9001,"), ("not ours", commit("x"), "-")]
    table = spark.createDataFrame(rows, "oid string, raw string, note string")
    got = {r.oid: r.text for r in rebuild.rebuilt(table.select("oid", "raw"), table.select("oid", "note"), none).collect()}
    assert got == {k: None for k, *_ in rows}
    assert rebuild.rebuilt(table.select("oid", "raw").limit(0), table.select("oid", "note"), none).isEmpty()
    odd = spark.createDataFrame([("a", None, "n", "t"), ("b", commit("x"), "n", None), ("c", commit("x"), "n", "no empty line"), ("d", "", None, "")], pairs.schema)
    assert [r.note for r in rebuild.notes_for(odd).collect()] == [None] * 4


def test_fillers_need_the_parents(spark):
    p, q = "a" * 40, "b" * 40
    text = changeset("x", files=()) + "\0"
    node = node_of(q, None, text.encode())
    note = f"changeset {node}\nmanifest {M}"
    rows = spark.createDataFrame([("1", commit("x\0\0\0", parents=[p]), note), ("2", commit("x\0\0", parents=["c" * 40]), note), ("3", commit("x", parents=["c" * 40]), note)], "oid string, raw string, note string")
    known = spark.createDataFrame([(p, q)], "git string, hg string")
    got = {r.oid: r.text for r in rebuild.rebuilt(rows.select("oid", "raw"), rows.select("oid", "note"), known).collect()}
    assert got == {"1": text, "2": None, "3": text[:-1]}


def test_dump_by_abbreviation(spark, pairs):
    known = spark.createDataFrame([("plain", "ab" + "0" * 38), ("author", "ab1" + "0" * 37)], "git string, hg string")
    wanted = spark.createDataFrame([("AB0",), ("ab",), ("f",), (None,), ("ab0",)], "abbrev string")
    got = sorted((r.abbrev or "", r.text) for r in rebuild.dump(wanted, known, pairs.select("oid", "raw"), rebuild.notes_for(pairs)).collect())
    assert got == [("", None), ("AB0", PAIRS["plain"][1]), ("ab", None), ("ab0", PAIRS["plain"][1]), ("f", None)]


def test_known_and_claims(spark):
    nodes = spark.createDataFrame([("a",), ("a",), ("b",)], "node string")
    asked = spark.createDataFrame([(1, 2, "x"), (1, 1, "a"), (1, 3, None), (2, 1, "b")], "request int, place int, node string")
    assert {r.request: r.answer for r in peer.known_answers(asked, nodes, "request", "place").collect()} == {1: "100", 2: "1"}
    heads = spark.createDataFrame([("r", "0b"), ("r", "0a"), ("r", "0a"), ("s", "0c")], "repo string, node string")
    pushes = spark.createDataFrame([("r", False, True), ("r", False, False), ("s", True, True), ("empty", False, True)], "repo string, force boolean, hashed boolean")
    claims = peer.push_claims(heads, pushes, "repo").select("repo", "claim")
    assert all(r.accepted for r in peer.accepted(claims, heads, "repo").collect()) and claims.count() == 4
    later = heads.unionAll(spark.createDataFrame([("r", "0d"), ("s", "0d"), ("empty", "0e")], heads.schema))
    assert sorted((r.repo, r.accepted) for r in peer.accepted(claims, later, "repo").collect()) == [("empty", False), ("r", False), ("r", False), ("s", True)]


def test_bundle_lines_and_headers(spark):
    lines = [None, "", "https://h/x", "https://h/x BUNDLESPEC=", "file:///x BUNDLESPEC=none-v1", "https://h/x BUNDLESPEC=gzip-v2;stream", "https://h/x BUNDLESPEC=%zz", "https://h/x a BUNDLESPEC=none-v1", "http://h BUNDLESPEC=zstd-v2"]
    table = spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "place int, line string").withColumn("key", F.lit(1))
    assert [tuple(r) for r in peer.first_bundle(table, "key").collect()] == [(1, "http://h", "zstd-v2")]
    heads = [None, "", "# v2 git bundle\n\nPACK", f"# v2 git bundle\n{M} refs/a b\n\nPACK", f"# v2 git bundle\n-{M} x\n\n", "# v3 git bundle\n\n"]
    got = [r.r for r in spark.createDataFrame([(h,) for h in heads], "h string").select(peer.bundle_refs(F.col("h")).alias("r")).collect()]
    assert got[0] is got[1] is got[4] is got[5] is None and got[2] == [] and [tuple(x) for x in got[3]] == [(M, "refs/a b")]


def test_prepared_snapshots(spark, tmp_path):
    sources = spark.createDataFrame([(1, "https://h/a", None), (2, "https://h/a", "b"), (3, "https://h/a", None), (4, None, None)], "key int, url string, branch string")
    refs = spark.createDataFrame([(1, "x", "refs/heads/a"), (1, "y", "p/h/a"), (2, "z", "b"), (2, "x", "a"), (3, "x", "refs/heads/c"), (4, "x", "a")], "key int, oid string, name string")
    assert sorted(tuple(r) for r in peer.prepared_refs(sources, refs, "key", "p/").collect()) == [(1, "refs/heads/a", "x"), (2, "b", "z")]
    source, empty = Store(spark, str(tmp_path / "a")), Store(spark, str(tmp_path / "b"))
    assert peer.adopt(empty, source) is None and empty.pointer() == (0, None)
    session = source.begin()
    session.append("t", spark.range(5))
    session.append("none", spark.range(0))
    first = session.commit()
    session = source.begin()
    session.append("t", spark.range(5))
    session.commit()
    peer.adopt(empty, source, first)
    assert empty.current().table("t").count() == 5 and empty.current().table("none").isEmpty() and source.current().table("t").count() == 10
    with pytest.raises(ValueError, match="empty store"):
        peer.adopt(empty, source)


def test_objects_and_manifest_heads(spark):
    none = spark.createDataFrame([], "oid string, kind string, content binary")
    new = spark.createDataFrame([("blob", b""), ("blob", None), ("tree", b""), ("blob", b"x")], "kind string, content binary")
    held = store.added_objects(none, new)
    assert sorted((r.oid[:6], r.kind) for r in held.collect()) == [("4b825d", "tree"), ("c1b0730e"[:6], "blob"), ("e69de2", "blob")]
    assert store.added_objects(held, new).count() == 3
    with pytest.raises(Exception, match="no kind of object"):
        store.added_objects(none, new.withColumn("kind", F.lit("tag"))).collect()
    rows = spark.createDataFrame([(1, commit("x", parents=["a" * 40, "a" * 40, "b" * 40])), (2, commit("x"))], "k int, raw string")
    assert sorted(tuple(r) for r in store.manifest_heads(rows, "k", "raw").collect()) == [(1, "a" * 40), (1, "b" * 40)]
    with pytest.raises(Exception, match="no commit"):
        store.manifest_heads(rows.withColumn("raw", F.lit("x")), "k", "raw").collect()
