"""Sweeps, labels and derived identifiers against plain loops, with blocks so small that all ways between them are taken."""

import random

import pytest
from pyspark.sql import functions as F

from revstrata.functions import identity
from revstrata.operators import dag, labels, sweep


def _graph(seed, n, stride=1, reach=6):
    rng = random.Random(seed)
    parents = {}
    for k in range(n):
        near = range(max(0, k - reach), k) if rng.random() < 0.8 else range(k)
        parents[k * stride - 3] = sorted({(rng.choice(near)) * stride - 3 for _ in range(rng.choice([1, 1, 2]))}) if k and rng.random() < 0.95 else []
    return parents


def _frames(spark, parents):
    edges = spark.createDataFrame([(c, p) for c, ps in parents.items() for p in ps], "child long, parent long")
    return spark.createDataFrame([(k,) for k in parents], "rev long"), edges


def _up(parents):
    out = {}
    for k in sorted(parents):
        out[k] = {k}.union(*[out[p] for p in parents[k]])
    return out


@pytest.mark.parametrize(("stride", "size"), [(1, 1000), (1 << 40, 17)])
def test_fields(spark, stride, size):
    parents = _graph(size, 40, stride)
    nodes, edges = _frames(spark, parents)
    up = _up(parents)
    rng = random.Random(1)
    own = {k: rng.randrange(100) for k in parents if rng.random() < 0.4}
    seeds = spark.createDataFrame([(k, v, 1 << v % 50, v, 1) for k, v in own.items()], "rev long, most long, bits long, least long, n long")
    ways = edges.withColumns({"most": F.lit(0), "bits": F.lit(0), "least": F.when(F.col("child") % 2 == 0, F.lit(2)), "n": F.lit(None)})
    fields = {"most": "max", "bits": "or", "least": "min", "n": "sum"}
    got = {r.rev: (r.most, r.bits, r.least, r.n) for r in sweep.sweep(ways, seeds, fields, True, size).collect()}
    least = {}
    for k in sorted(parents):
        came = [least[p] + 2 for p in parents[k] if p in least and k % 2 == 0] + ([own[k]] if k in own else [])
        if came:
            least[k] = min(came)
    for k in parents:
        vs = [own[a] for a in up[k] if a in own]
        bits = 0
        for v in vs:
            bits |= 1 << v % 50
        assert got.get(k) == ((max(vs), bits, least.get(k), 1 if k in own else None) if vs else None)
    seeds = spark.createDataFrame([(k, 0) for k in own], "rev long, seen long")
    upward = {r.rev for r in sweep.sweep(edges.withColumn("seen", F.lit(0)), seeds, {"seen": "max"}, False, size).collect()}
    assert upward == set().union(*[up[k] for k in own])


@pytest.mark.parametrize(("stride", "size", "group"), [(1, 1000, 8192), (1 << 33, 20, 11)])
def test_labels_and_search(spark, stride, size, group):
    parents = _graph(size + group, 40, stride)
    nodes, edges = _frames(spark, parents)
    up = _up(parents)
    pairs = [(a, b) for a in parents for b in parents]
    df = spark.createDataFrame([*pairs, pairs[7], (None, 1), (999, 999), (999, -3)], "a long, b long")
    got = labels.is_ancestor(nodes, edges, df, size=size, group=group).collect()
    assert len(got) == len(pairs) + 3
    assert {(r.a, r.b): r.is_ancestor for r in got} == {(a, b): a in up[b] for a, b in pairs} | {(999, 999): True, (999, -3): False}
    told = labels.decided(df.where("a IS NOT NULL"), labels.index(nodes, edges, size=size)).where("found IS NOT NULL").collect()
    assert all(r.found == (r.a in up.get(r.b, {r.b})) for r in told) and len(told) > len(pairs) * 0.8
    found = labels.search(edges, spark.createDataFrame([(a, b) for a, b in pairs if a < b and b in {c for c, ps in parents.items() if ps}], "a long, b long").join(edges.select(F.col("parent").alias("a")).distinct(), "a"), size, group)
    inner = {p for ps in parents.values() for p in ps}
    assert {(r.a, r.b) for r in found.collect()} == {(a, b) for b in parents if parents[b] for a in up[b] if a != b and a in inner}


def test_derived_identifiers(spark):
    parents = _graph(5, 40)
    rows = [(k, f"{k % 97:040x}", *(ps + [None, None])[:2], f"content {k}".encode()) for k, ps in parents.items()]
    nodes = spark.createDataFrame(rows, "rev long, node string, p1 long, p2 long, content binary")
    old, new = {r[0]: r[1] for r in rows}, {}
    for k, _, p1, p2, content in sorted(rows):
        if k % 3:
            new[k] = identity.node_of(*[None if p is None else new.get(p, old[p]) for p in (p1, p2)], content)
    assert {r.rev: r.new_node for r in dag.rewrite(nodes, nodes.where("rev % 3 <> 0"), identity.node_of).collect()} == new
    part = nodes.where("rev % 3 <> 0")
    for p in ("p1", "p2"):
        part = part.join(nodes.select(F.col("rev").alias(p), F.col("node").alias(f"{p}_id")), p, "left")
    assert {r.rev: r.new_node for r in sweep.derived(part, identity.node_of, 13).collect()} == new
    hashed = nodes.select(identity.node_hash(F.col("node"), F.lit(None), F.col("content")).alias("a"), "node", "content").collect()
    assert all(r.a == identity.node_of(None, r.node, bytes(r.content)) for r in hashed)


def test_circles_are_errors(spark):
    nodes = spark.createDataFrame([(k,) for k in range(4)], "rev long")
    ring = spark.createDataFrame([(1, 2), (2, 1), (3, 2), (2, 0)], "child long, parent long")
    one = spark.createDataFrame([(3,)], "rev long")
    for f in (dag.ancestors, dag.descendants):
        with pytest.raises(Exception, match="not before its child"):
            f(nodes, ring, one).collect()
    with pytest.raises(Exception, match="not before its child"):
        dag.generation(nodes, ring).collect()
    with pytest.raises(ValueError, match="circle"):
        dag.linear_walk(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "id string, prev string"), spark.createDataFrame([("a",)], "id string"))


def test_fast_forward(spark):
    parents = {0: [], 1: [0], 2: [0], 3: [1, 2], 4: [2]}
    nodes, edges = _frames(spark, parents)
    rows = [("a", 0, 3, "forward"), ("b", 1, 4, "forced"), ("c", None, 4, "new"), ("d", 4, None, "gone"), ("e", 4, 4, "same"), ("f", 3, 1, "forced")]
    df = spark.createDataFrame([r[:3] for r in rows], "ref string, old long, new long")
    assert {r.ref: r.kind for r in dag.fast_forward(nodes, edges, df).collect()} == {r[0]: r[3] for r in rows}
