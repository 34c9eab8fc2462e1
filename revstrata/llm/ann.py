"""Approximate nearest neighbours by inner product: NN-descent and greedy graph search.

Equal vectors are one node. The graph starts with each node's best neighbours inside blocks of nodes that share a
pivot (a bounded sample of nodes; what gathers at one pivot is split among pivots of its own, until blocks are small),
and is improved by NN-descent: in each round a join brings a sample of every
node's neighbours and reverse neighbours together, where they are scored with each other; each node keeps the best.
Queries walk the graph: each step is a join of the best nodes not yet looked at with their neighbours. Scores are
inner products in double precision on the original vectors throughout.
"""

from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revstrata.llm.common import release, ship, written

DEGREE, PIVOTS, NEAR, BLOCK = 30, 1024, 6, 400
#: Pivots that a large cell is split by at once, rows of it in a task, and levels of splits.
FANOUT, SLICE, LEVELS = 64, 4000, 8
FRESH, OLD, PROPOSE = 15, 12, 8
WIDTH, STEP_NODES, ENTRIES = 192, 64, 3
LOG = logging.getLogger(__name__)


def _matrix(column: pd.Series, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column), dtype=kind).reshape(len(column), -1).astype(np.float64)


def usable(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> tuple[DataFrame, str]:
    """(vec_id, node, vec) of the vectors that take part, and the number type of the bytes ``vec``.

    Null or zero vectors and those with null, infinite or NaN components take no part, nor do rows with a null id or with
    another number of components than most. Of rows with one id the first by its components counts. ``node`` is the
    smallest id with an equal vector.
    """
    kind = "<f4" if dict(vectors.dtypes)[column] == "array<float>" else "<f8"

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([None if v is None else np.asarray(v, dtype=kind).tobytes() for v in batch], dtype=object)

    sound = ~F.exists(column, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(column, lambda x: x != 0)
    rows = vectors.where(F.col(key).isNotNull() & F.col(column).isNotNull()).where(sound).select(F.col(key).cast("long").alias("vec_id"), F.col(column).alias("v"))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    rows = rows.where(F.size("v") == (sizes[0]["d"] if sizes else 0)).select("vec_id", F.pandas_udf(of, "binary")("v").alias("vec"))
    rows = written(rows, "vectors")
    least = rows.groupBy("vec").agg(F.min("vec_id").alias("node"))
    return written(rows.join(least, "vec").select("vec_id", "node", "vec"), "nodes"), kind


def _best(edges: DataFrame, degree: int) -> DataFrame:
    """Each node's best ``degree`` of (u, v, s, fresh), once each."""
    once = edges.groupBy("u", "v").agg(F.max("s").alias("s"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("s"), "v"))
    return once.withColumn("_rank", rank).where(F.col("_rank") <= degree).drop("_rank")


def pivots_of(nodes: DataFrame, kind: str, most: int = PIVOTS) -> tuple[np.ndarray, np.ndarray]:
    """Identifiers and vectors of one in BLOCK / 4 nodes, at most ``most``, chosen by a hash of the id."""
    picked = nodes.orderBy(F.xxhash64("node"), "node").limit(min(most, 1 + nodes.count() // (BLOCK // 4))).toPandas()
    return picked["node"].to_numpy(dtype=np.int64), _matrix(picked["vec"], kind) if len(picked) else np.zeros((0, 1))


def split(cells: DataFrame, kind: str, block: int = BLOCK) -> DataFrame:
    """``cells`` (node, vec, cell) with cells of more than 2 * ``block`` nodes split again and again.

    A large cell is split by up to FANOUT of its own nodes, each node going to the nearest of these by distance, so that cells
    stay about as small however many nodes there are. A cell is worked on in slices of about SLICE nodes. What is still large
    after LEVELS levels (vectors that no pivots tell apart) stays so.
    """

    def nearest_pivot(members: pd.DataFrame, pivots: pd.DataFrame) -> pd.DataFrame:
        pivots = pivots.sort_values("number")
        p = _matrix(pivots["vec"], kind)
        scores = _matrix(members["vec"], kind) @ p.T - (p * p).sum(axis=1) / 2
        return members[["node", "vec", "cell"]].assign(number=pivots["number"].to_numpy()[scores.argmax(axis=1)])

    for _ in range(LEVELS):
        sizes = cells.groupBy("cell").agg(F.count("*").alias("n"))
        large = written(sizes.where(F.col("n") > 2 * block).select("cell", F.least(F.ceil(F.col("n") / block), F.lit(FANOUT)).alias("fan"), F.ceil(F.col("n") / SLICE).alias("slices")), "large")
        if large.isEmpty():
            break
        order = F.row_number().over(Window.partitionBy("cell").orderBy(F.xxhash64("node", "cell"), "node"))
        members = cells.join(large, "cell")
        pivots = members.withColumn("number", order).where(F.col("number") <= FANOUT).where(F.col("number") <= F.col("fan"))
        pivots = written(pivots.select("cell", "vec", "number", "slices"), "cell-pivots")
        pivots = pivots.select("cell", "vec", "number", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1)).alias("slice"))
        members = members.withColumn("slice", F.pmod(F.xxhash64("node", F.lit(7)), F.col("slices")))
        dealt = members.groupBy("cell", "slice").cogroup(pivots.groupBy("cell", "slice")).applyInPandas(nearest_pivot, "node long, vec binary, cell long, number int")
        again = dealt.select("node", "vec", F.xxhash64("cell", "number").alias("cell"))
        cells = written(cells.join(large, "cell", "left_anti").select("node", "vec", "cell").unionAll(again), "cells")
    return cells


def start_graph(nodes: DataFrame, kind: str, pivots: np.ndarray, degree: int = DEGREE, near: int = NEAR) -> DataFrame:
    """(u, v, s, fresh): each node's best neighbours among blocks of about BLOCK nodes with a pivot in common."""
    held = nodes.sparkSession.sparkContext.broadcast(pivots)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.iloc[at : at + 2000]
                scores = _matrix(part["vec"], kind) @ held.value.T
                top = np.argsort(-scores, axis=1, kind="stable")[:, :near]
                for k in range(top.shape[1]):
                    yield pd.DataFrame({"node": part["node"].to_numpy(), "vec": part["vec"].to_numpy(), "cell": top[:, k]})

    def inside(group: pd.DataFrame) -> pd.DataFrame:
        ids, x = group["node"].to_numpy(), _matrix(group["vec"], kind)
        scores = x @ x.T
        np.fill_diagonal(scores, -np.inf)
        k = min(degree, len(ids) - 1)
        top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
        return pd.DataFrame({"u": np.repeat(ids, k), "v": ids[top].ravel(), "s": np.take_along_axis(scores, top, 1).ravel()})

    cells = split(written(nodes.mapInPandas(assign, "node long, vec binary, cell long"), "cells"), kind)
    blocks = cells.groupBy("cell").agg(F.ceil(F.count("*") / (2 * BLOCK)).alias("blocks"))
    dealt = cells.join(blocks, "cell").withColumn("block", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int"))
    edges = dealt.groupBy("cell", "block").applyInPandas(inside, "u long, v long, s double")
    return written(_best(edges.withColumn("fresh", F.lit(True)), degree), "graph")


def improve(graph: DataFrame, nodes: DataFrame, kind: str, round_number: int, degree: int = DEGREE) -> DataFrame:
    """One round of NN-descent: neighbours of neighbours are scored where a common neighbour is."""

    def some(edges: DataFrame, by: str, other: str) -> DataFrame:
        order = F.row_number().over(Window.partitionBy(by, "fresh").orderBy(F.xxhash64(by, other, F.lit(round_number))))
        # the plain limit comes first: it is the one that Spark applies before the shuffle, so that a hub's edges do not meet in one task
        return edges.withColumn("_k", order).where(F.col("_k") <= max(FRESH, OLD)).where(F.col("_k") <= F.when(F.col("fresh"), FRESH).otherwise(OLD)).drop("_k")

    forward = written(some(graph.select("u", "v", "fresh"), "u", "v"), "forward")
    backward = some(forward, "v", "u")
    around = (
        forward.select(F.col("u").alias("centre"), F.col("v").alias("member"), "fresh")
        .unionAll(backward.select(F.col("v").alias("centre"), F.col("u").alias("member"), "fresh"))
        .groupBy("centre", "member")
        .agg(F.max("fresh").alias("fresh"))
    )
    floor = graph.groupBy("u").agg(F.when(F.count("*") >= degree, F.min("s")).otherwise(float("-inf")).alias("floor"))
    known = nodes.join(floor, nodes.node == floor.u, "left").select(F.col("node").alias("member"), "vec", F.coalesce("floor", F.lit(float("-inf"))).alias("floor"))

    def propose(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["centre", "member"], kind="stable")
        centres = group["centre"].to_numpy()
        ids, fresh, floors, x = group["member"].to_numpy(), group["fresh"].to_numpy(), group["floor"].to_numpy(), _matrix(group["vec"], kind)
        edges = np.flatnonzero(np.concatenate([[True], centres[1:] != centres[:-1], [True]]))
        out = []
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            scores = x[a:b] @ x[a:b].T
            f = fresh[a:b]
            scores[~(f[:, None] | f[None, :])] = -np.inf
            np.fill_diagonal(scores, -np.inf)
            scores[scores <= floors[a:b, None]] = -np.inf
            k = min(PROPOSE, b - a)
            top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
            s = np.take_along_axis(scores, top, 1)
            r, c = np.nonzero(s > -np.inf)
            out.append((ids[a:b][r], ids[a:b][top[r, c]], s[r, c]))
        u, v, s = (np.concatenate(y) for y in zip(*out, strict=True))
        return pd.DataFrame({"u": u, "v": v, "s": s})

    # groups of a few hundred centres, each with at most 2 * (FRESH + OLD) members
    n = max(1, nodes.count() // 300)
    met = around.join(known, "member").withColumn("part", F.pmod(F.xxhash64("centre"), F.lit(n)))
    found = met.groupBy("part").applyInPandas(propose, "u long, v long, s double").withColumn("fresh", F.lit(True))
    used = forward.where("fresh").select("u", "v", F.lit(True).alias("used"))
    kept = graph.join(used, ["u", "v"], "left").select("u", "v", "s", (F.col("fresh") & F.col("used").isNull()).alias("fresh"))
    return written(_best(kept.unionByName(found), degree), "graph")


def build(nodes: DataFrame, kind: str, pivots: np.ndarray, rounds: int = 10, enough: float = 0.02, degree: int = DEGREE) -> DataFrame:
    """The neighbour graph (u, v, s); rounds end when less than ``enough`` of its edges are new."""
    graph = start_graph(nodes, kind, pivots, degree)
    for k in range(rounds):
        graph = improve(graph, nodes, kind, k, degree)
        release(nodes.sparkSession)
        edges, fresh = graph.agg(F.count("*"), F.sum(F.col("fresh").cast("int"))).first()
        if (fresh or 0) <= enough * edges:
            break
    else:
        LOG.warning("ann: after %d rounds %.1f %% of the graph's edges are still new", rounds, 100.0 * (fresh or 0) / max(1, edges))
    return graph.select("u", "v", "s")


def _dot(a: Column, b: Column, kind: str) -> Column:
    def of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for x, y in batches:
            yield pd.Series(np.einsum("ij,ij->i", _matrix(x, kind), _matrix(y, kind)) if len(x) else np.zeros(0))

    return F.pandas_udf(of, "double")(a, b)


def search(queries: DataFrame, graph: DataFrame, nodes: DataFrame, kind: str, pivot_ids: np.ndarray, pivots: np.ndarray, width: int = WIDTH, steps: int = 24) -> DataFrame:
    """(query_id, node, score): the ``width`` best nodes that a greedy walk finds for each of ``queries`` (query_id, vec).

    Walks begin at the nearest pivots, and at the query's own node where it has one (column ``node``). A step looks at
    the neighbours, either way, of the best STEP_NODES nodes not yet looked at among the best ``width``.
    """
    held = queries.sparkSession.sparkContext.broadcast((pivot_ids, pivots))

    def enter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, x = held.value
        for batch in batches:
            scores = _matrix(batch["vec"], kind) @ x.T if len(batch) else np.zeros((0, len(ids)))
            top = np.argsort(-scores, axis=1, kind="stable")[:, :ENTRIES]
            yield pd.DataFrame({"query_id": np.repeat(batch["query_id"].to_numpy(), top.shape[1]), "node": ids[top].ravel()})

    back = Window.partitionBy("v").orderBy(F.desc("s"), "u")
    both = graph.select("u", "v").unionAll(graph.withColumn("_k", F.row_number().over(back)).where(F.col("_k") <= DEGREE).select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = written(both.distinct().groupBy("u").agg(F.collect_list("v").alias("near")), "near")
    vectors = nodes.select("node", F.col("vec").alias("node_vec"))

    def scored(pairs: DataFrame) -> DataFrame:
        met = pairs.join(vectors, "node").join(queries.select("query_id", "vec"), "query_id")
        return met.select("query_id", "node", _dot(F.col("vec"), F.col("node_vec"), kind).alias("score"), F.lit(False).alias("seen"))

    entry = queries.select("query_id", "vec").mapInPandas(enter, "query_id long, node long").unionAll(queries.where(F.col("node").isNotNull()).select("query_id", "node"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "node")
    turn = F.sum((~F.col("seen")).cast("int")).over(best.rowsBetween(Window.unboundedPreceding, 0))

    def ranked(rows: DataFrame) -> DataFrame:
        """A query's best nodes, and which of them the next step goes from: one sort a step."""
        kept = rows.withColumn("_r", F.row_number().over(best)).withColumn("_turn", turn).where(F.col("_r") <= 4 * width)
        return written(kept.withColumn("_go", ~F.col("seen") & (F.col("_r") <= width) & (F.col("_turn") <= STEP_NODES)).drop("_turn"), "walk")

    state = ranked(scored(entry.distinct()))
    for _ in range(steps):
        going = state.where("_go").select("query_id", "node")
        if going.isEmpty():
            break
        new = going.join(near, going.node == near.u).select("query_id", F.explode("near").alias("node")).distinct().join(state, ["query_id", "node"], "left_anti")
        state = ranked(state.select("query_id", "node", "score", (F.col("seen") | F.col("_go")).alias("seen")).unionByName(scored(new)))
    else:
        open_ = state.where("_go").select("query_id").distinct().count()
        if open_:
            LOG.warning("ann: after %d steps the walks of %d queries had not ended", steps, open_)
    return state.where(F.col("_r") <= width).select("query_id", "node", "score")


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, most_pivots: int = PIVOTS, **how) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vec_id divisible by ``every`` its ``k`` nearest other rows.

    All rows are indexed. Nodes found are spread to their ``k`` + 1 smallest ids, which holds every id that can be among the
    ``k`` nearest; ties go to smaller ids. An empty table has an empty result.
    """
    rows, kind = usable(vectors)
    nodes = written(rows.where(F.col("vec_id") == F.col("node")).select("node", "vec"), "graph-nodes")
    ids, pivots = pivots_of(nodes, kind, most_pivots)
    queries = written(rows.where(F.pmod("vec_id", F.lit(every)) == 0).select(F.col("vec_id").alias("query_id"), "node", "vec"), "queries")
    found = search(queries, build(nodes, kind, pivots, **how), nodes, kind, ids, pivots)
    members = rows.withColumn("_k", F.row_number().over(Window.partitionBy("node").orderBy("vec_id"))).where(F.col("_k") <= k + 1).select("node", "vec_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.join(members, "node").where(F.col("vec_id") != F.col("query_id")).withColumn("rank", F.row_number().over(best))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ship(__name__)
