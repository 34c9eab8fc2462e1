"""Sessions that end well, die, lose a race or are refused; imports into a live store; checks of what is new."""

import hashlib

import pytest
from pyspark.sql import functions as F

from revstrata.functions.identity import node_of
from revstrata.operators import live, transfer
from revstrata.operators.delta import delta
from revstrata.operators.session import LostRace, Refused, Store


def _rows(store, name="t"):
    table = store.current().table(name)
    return None if table is None else sorted(r.id for r in table.collect())


def test_session_steps(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    assert _rows(store) is None and store.pointer() == (0, None)
    one = store.begin()
    one.append("t", spark.range(3))
    assert _rows(store) is None, "nothing is seen before the pointer moves"
    first = one.commit()
    assert _rows(store) == [0, 1, 2]
    dead = store.begin()
    dead.append("t", spark.range(10, 12))  # and it is never committed
    assert _rows(store) == [0, 1, 2]
    a, b = store.begin(), store.begin()
    a.append("t", spark.range(3, 4))
    b.replace("t", spark.range(7, 8))
    second = a.commit()
    with pytest.raises(LostRace):
        b.commit()
    assert _rows(store) == [0, 1, 2, 3]
    same = store.begin()
    same.append("t", spark.range(0))
    same.replace("u", spark.range(0))
    third = same.commit()
    again = store.begin()
    again.replace("u", spark.range(0))
    assert again.commit() == third == store.pointer()[1], "no change makes no snapshot"
    bad = store.begin()
    bad.append("t", spark.range(9, 10))
    with pytest.raises(Refused, match="no nines"):
        bad.commit({"no nines": lambda state, base: state.new_rows("t", base).where("id = 9")})
    assert _rows(store) == [0, 1, 2, 3]
    store.move_to(second, "checked")
    assert store.pointer()[1] == second and {r.snapshot_id: r.status for r in store.snapshots().collect()}[second] == "checked"
    with pytest.raises(ValueError, match="not an ancestor"):
        store.move_to(third)
    store.move_to(first)
    assert _rows(store) == [0, 1, 2]
    with pytest.raises(ValueError, match="no such mark"):
        store.move_to(first, "odd")
    number = store.pointer()[0]
    (tmp_path / "store" / "pointer" / f"{number + 1:012d}").write_bytes(b"")  # a writer that died
    assert store.pointer() == (number + 1, first) and _rows(store) == [0, 1, 2]


def _revisions(spark, ks, wrong=False):
    """Changesets k over k - 1 (and the sixth over the second, too), each with its manifest and file, as whole deltas."""
    rows, sets, manifests, files = [], {}, {}, {}
    for k in range(max(ks) + 1):
        p1, p2 = k - 1 if k else None, 1 if k == 5 else None
        at = lambda t, p: None if p is None else t[p]
        text = f"line {k}\n".encode()
        files[k] = node_of(at(files, p1), at(files, p2), text)
        lines = f"f\0{files[k]}\n".encode()
        manifests[k] = node_of(at(manifests, p1), at(manifests, p2), lines)
        extra = " branch:side" if k in (3, 4) else ""
        raw = f"{manifests[k]}\nA <a@b>\n{k} 0{extra}\nf\n\nbody {k}".encode()
        sets[k] = node_of(at(sets, p1), at(sets, p2), raw)
        if k in ks:
            for section, path, table, content in (("changeset", None, sets, raw), ("manifest", None, manifests, lines), ("file", "f", files, text)):
                rows.append((k, section, path, table[k], at(table, p1), at(table, p2), None, sets[k], content))
    df = spark.createDataFrame(rows, "seq long, section string, path string, node string, p1 string, p2 string, base string, link string, content binary")
    return df.withColumn("delta", delta(F.lit(None).cast("binary"), F.col("content"))).drop("content"), sets


def test_imports_and_checks(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    first, sets = _revisions(spark, range(4))
    live.import_revisions(store, first, ["seq"])
    assert live.check_and_mark(store).isEmpty()
    checked = store.current()
    second, sets = _revisions(spark, range(2, 8))
    new, heads = live.overlay(checked, second, ["seq"])
    assert {(r.rev, r.node) for r in new.collect()} == {(k, sets[k]) for k in range(4, 8)}
    live.import_revisions(store, second, ["seq"])
    now = store.current()
    assert {tuple(r) for r in heads.collect()} == {tuple(r) for r in now.table("heads").select(*heads.columns).collect()}
    new, heads = live.overlay(checked, first, ["seq"])
    assert new.isEmpty() and heads.count() == checked.table("heads").count()
    got = {r.node: r for r in now.table("changesets").collect()}
    assert {r.rev: n for n, r in got.items()} == {k: n for k, n in sets.items()}
    assert now.new_rows("changesets", checked).count() == 4
    assert {(r.node, r.branch) for r in now.table("heads").collect()} == {(sets[4], "side"), (sets[7], "default"), (sets[2], "default")}
    mapping = {r.hg: r.git for r in now.table("mapping").where("kind = 'changeset'").collect()}
    git, blob = {}, {}
    for k in range(8):
        text = f"line {k}\n".encode()
        blob[k] = hashlib.sha1(b"blob %d\0" % len(text) + text).digest()
        body = b"100644 f\0" + blob[k]
        tree = hashlib.sha1(b"tree %d\0" % len(body) + body).hexdigest()
        parents = "".join(f"parent {git[p]}\n" for p in ([k - 1] if k else []) + ([1] if k == 5 else []))
        raw = f"tree {tree}\n{parents}author A <a@b> {k} +0000\ncommitter A <a@b> {k} +0000\n\nbody {k}".encode()
        git[k] = hashlib.sha1(b"commit %d\0" % len(raw) + raw).hexdigest()
    assert mapping == {sets[k]: git[k] for k in range(8)}
    assert live.import_revisions(store, second, ["seq"]) == now.snapshot_id
    assert live.check_new(store).isEmpty() and live.check_new(store, full=True).isEmpty()
    session = store.begin()
    session.replace("heads", now.table("heads").where("branch <> 'side'"))
    session.commit()
    assert [(r.kind, r.id) for r in live.check_and_mark(store).collect()] == [("head", sets[4])]
    assert store.snapshots().where("status = 'broken'").count() == 1
    orphan = second.where(F.col("seq") > 5)
    with pytest.raises(Exception, match="not known"):
        live.overlay(checked, orphan, ["seq"])[0].collect()
    with pytest.raises(Exception, match="not known"):
        live.import_revisions(Store(spark, f"file://{tmp_path}/other"), orphan, ["seq"])
    assert Store(spark, f"file://{tmp_path}/other").pointer() == (0, None)
    assert transfer.imported(first)["changesets"].count() == 4

