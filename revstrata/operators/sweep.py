"""Sweeps over commit graphs, block by block.

A parent's rev is below its child's, so revs are a topological order. They are cut into blocks of at most ``BLOCK`` nodes.
A sweep goes through the blocks in order, down from the oldest or up from the youngest; a block is solved by one task in one
pass over its edges, from its seeds and what earlier blocks have sent to it. What it sends on is a join of its values
with the edges that leave it, however many these are, and is combined before it is
written. So the number of jobs follows the blocks and not the generations, a task holds one block, and a lost executor costs
one block. Blocks that nothing is sent to are passed over.

Every edge and every node carries some fields, all longs. A field goes along an edge where the edge's column of that name is not
NULL, grows by it, and is combined with the field of the node that it comes to by ``or``, ``max``, ``min`` or ``sum``; ``any`` is for a
field that is 0 everywhere and says only that a node is reached.

Written revs take about a byte a row, so Spark would take tables of millions of rows for small ones and send them through the driver: joins are
told here which way to go, by counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revstrata.operators import scratch
from revstrata.shipping import ship

#: Nodes of a block, of a block whose identifiers are derived, and edges that a task has as numbers of Python's at once.
BLOCK, DERIVED, STRETCH = 1 << 21, 1 << 20, 1 << 16
OPERATORS: dict[str, tuple[Callable[[Column], Column], Callable[[int, int], int]]] = {
    "or": (F.bit_or, lambda x, y: x | y),
    "max": (F.max, max),
    "min": (F.min, min),
    "sum": (F.sum, lambda x, y: x + y),
    "any": (F.max, max),
}
#: Rows of a table that may go to every task: those of one that is known to have no more.
FEW = 1 << 16


def _ranked(revs: DataFrame) -> DataFrame:
    """(rev, rank) of distinct revs in their order, from 0: ranges are numbered apart and moved by the counts before them."""
    n = int(revs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = scratch.cut(revs.repartitionByRange(n, "rev").withColumn("_part", F.spark_partition_id()))
    counts = sorted((r["_part"], r["count"]) for r in dealt.groupBy("_part").count().collect())  # one number a range
    before, pairs = 0, []
    for part, count in counts:
        pairs += [F.lit(part), F.lit(before).cast("long")]
        before += count
    at = F.row_number().over(Window.partitionBy("_part").orderBy("rev")) - 1
    return dealt.select("rev", (F.create_map(*pairs)[F.col("_part")] + at).alias("rank")) if pairs else dealt.select("rev", F.lit(0).cast("long").alias("rank"))


def near(rows: DataFrame, n: int | None = None) -> DataFrame:
    """``rows``, which are ``n`` (counted here if not given), as a side of a join: sent to every task if few, else both sides are dealt by key."""
    return F.broadcast(rows) if (rows.count() if n is None else n) <= FEW else rows.hint("merge")


class Blocks:
    """Which block a rev is in: by its distance from the smallest, or by its rank where revs are far apart."""

    def __init__(self, revs: DataFrame, size: int = BLOCK) -> None:
        """``revs`` (rev) may repeat."""
        low, high, n = revs.agg(F.min("rev"), F.max("rev"), F.approx_count_distinct("rev")).first()
        self.low, self.size = low or 0, size
        width = 0 if low is None else high - low + 1
        self.ranks = None
        if width > max(4 * n, size):
            self.ranks = scratch.cut(_ranked(revs.distinct()).select("rev", F.expr(f"rank div {size}").alias("block")))
            width = self.ranked = self.ranks.count()
        self.n = -(-width // size)

    def place(self, rows: DataFrame, *columns: str) -> DataFrame:
        """``rows`` with the block of each column in a column ``COLUMN_block``."""
        for c in columns:
            if self.ranks is None:
                rows = rows.withColumn(f"{c}_block", F.expr(f"({c} - {self.low}) div {self.size}"))
            else:
                rows = rows.join(near(self.ranks.select(F.col("rev").alias(c), F.col("block").alias(f"{c}_block")), self.ranked), c)
        return rows


def _arrays(batches: Iterator[pa.RecordBatch]) -> dict[str, tuple[np.ndarray, np.ndarray]] | None:
    """Each column of a block, NULL as 0, and where it is not NULL; None of no rows."""
    held = list(batches)
    if not held:
        return None
    table = pa.Table.from_batches(held)
    return {c: (table[c].fill_null(0).to_numpy(), table[c].is_valid().to_numpy()) for c in table.column_names}


def _places(parts: list[np.ndarray]) -> tuple[np.ndarray, Callable[[np.ndarray], np.ndarray]]:
    """The distinct revs of ``parts`` in their order, and what gives the places of revs among them: by a table where they lie close together."""
    low, high = min(int(p.min()) for p in parts if len(p)), max(int(p.max()) for p in parts if len(p))
    if high - low > 4 * sum(map(len, parts)):
        revs = np.unique(np.concatenate(parts))
        return revs, lambda x: np.searchsorted(revs, x)
    here = np.zeros(high - low + 1, dtype=bool)
    for p in parts:
        here[p - low] = True
    at = np.cumsum(here, dtype=np.int64) - 1
    return np.flatnonzero(here) + low, lambda x: at[x - low]


def _met(n: int, own: np.ndarray, src: np.ndarray, dst: np.ndarray, ways: np.ndarray) -> np.ndarray:
    """Which of ``n`` places are reached from ``own`` along ``ways``, in their order."""
    met = bytearray(n)
    np.frombuffer(met, dtype=np.uint8)[own] = 1
    for k in range(0, len(ways), STRETCH):
        part = ways[k : k + STRETCH]
        for a, b in zip(src[part].tolist(), dst[part].tolist(), strict=True):
            if met[a]:
                met[b] = 1
    return np.frombuffer(met, dtype=np.uint8) > 0


def _solver(fields: dict[str, str], down: bool):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _arrays(batches)
        if held is None:
            return
        (src, _), (dst, is_edge) = held.pop("src"), held.pop("dst")
        revs, places = _places([src, dst[is_edge]])
        edges, seeds = np.flatnonzero(is_edge), np.flatnonzero(~is_edge)
        edges = edges[np.argsort(src[edges] if down else -src[edges], kind="stable")]
        src, dst = places(src), places(np.where(is_edge, dst, revs[0]))  # places in revs; those of seeds' dst are not used
        columns, reached = [], np.zeros(len(revs), dtype=bool)
        for name, kind in fields.items():
            join, (steps, there) = OPERATORS[kind][1], held.pop(name)
            own, ways = seeds[there[seeds]], edges[there[edges]]
            if kind == "any":
                met = _met(len(revs), src[own], src, dst, ways)
                columns.append(pa.array(np.zeros(len(revs), np.int64), mask=~met))
                reached |= met
                continue
            value: list[int | None] = [None] * len(revs)
            for a, v in zip(src[own].tolist(), steps[own].tolist(), strict=True):
                value[a] = v
            for k in range(0, len(ways), STRETCH):
                part = ways[k : k + STRETCH]
                for a, b, step in zip(src[part].tolist(), dst[part].tolist(), steps[part].tolist(), strict=True):
                    v = value[a]
                    if v is not None:
                        w = value[b]
                        value[b] = v + step if w is None else join(w, v + step)
            columns.append(pa.array(value, pa.int64()))
            del value
            reached |= columns[-1].is_valid().to_numpy(zero_copy_only=False)
        kept = np.flatnonzero(reached)
        yield pa.RecordBatch.from_arrays([pa.array(revs[kept]), *[c.take(pa.array(kept)) for c in columns]], names=["rev", *fields])

    return of


def _combined(rows: DataFrame, fields: dict[str, str], key: str = "rev") -> DataFrame:
    return rows.groupBy(key).agg(*[OPERATORS[kind][0](c).alias(c) for c, kind in fields.items()])


def ordered_edges(edges: DataFrame) -> DataFrame:
    """``edges``, failing where a parent's rev is not below its child's: a closed cycle has such an edge."""
    wrong = F.raise_error(F.concat(F.lit("the parent "), F.col("parent").cast("string"), F.lit(" is not before its child "), F.col("child").cast("string")))
    return edges.withColumn("parent", F.when(F.col("parent") < F.col("child"), F.col("parent")).otherwise(wrong.cast("long")))


def sweep(edges: DataFrame, seeds: DataFrame, fields: dict[str, str], down: bool, size: int = BLOCK) -> DataFrame:
    """(rev, fields) of all nodes that the fields come to, written; ``fields`` names them and how each is combined.

    ``edges`` are (child, parent, fields) and ``seeds`` (rev, fields). ``down`` goes from parents to children, else the other way. An
    edge whose parent is not before its child is an error; repeated edges count once for each but ``sum``; seeds of one rev
    are combined. No edges or no seeds give the seeds or nothing.
    """
    spark = edges.sparkSession
    src, dst = ("parent", "child") if down else ("child", "parent")
    longs = [F.col(c).cast("long").alias(c) for c in fields]
    ways = ordered_edges(edges.select(F.col("child").cast("long").alias("child"), F.col("parent").cast("long").alias("parent"), *longs)).select(F.col(src).alias("src"), F.col(dst).alias("dst"), *fields)
    seeds = scratch.cut(seeds.select(F.col("rev").cast("long").alias("rev"), *longs), "seeds")
    ways = scratch.cut(ways, "edges")  # read several times
    blocks = Blocks(seeds.select("rev").unionAll(ways.select("src")).unionAll(ways.select("dst")), size)
    solve, kind = _solver(fields, down), ", ".join(f"{c} long" for c in ("rev", *fields))
    none = F.lit(None).cast("long")

    def solved(inner: DataFrame | None, own: DataFrame) -> DataFrame:
        rows = _combined(own, fields).select(F.col("rev").alias("src"), none.alias("dst"), *fields)
        if inner is not None:
            rows = rows.unionByName(inner.select("src", "dst", *fields))
        return rows.coalesce(1).mapInArrow(solve, kind)  # a block's files are one task's anyway, so they are not dealt again

    if blocks.n <= 1:
        return scratch.cut(solved(ways, seeds), "sweep")
    home = scratch.folder(spark, "sweep")
    placed = blocks.place(ways, "src", "dst") if blocks.ranks is None else scratch.cut(blocks.place(ways, "src", "dst"), "edges")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = {c: f"{home}/{c}" for c in ("inner", "cross", "sent", "done")}
    inner = placed.where("src_block = dst_block").select("src", "dst", *fields, F.col("src_block").alias("block"))
    inner.repartition(n, "block").write.partitionBy("block").parquet(at["inner"])
    # the edges that leave a block may be any number, so they are spread
    cross = placed.where("src_block <> dst_block").select("src", "dst", *fields, "dst_block", F.col("src_block").alias("block"))
    cross.repartition(n, "block", F.expr("pmod(hash(dst), 16)")).write.partitionBy("block").parquet(at["cross"])
    first = blocks.place(seeds, "rev").withColumnRenamed("rev_block", "block")
    first.repartition(n, "block").write.partitionBy("block").parquet(at["sent"])
    types = {"inner": f"src long, dst long, {kind.partition(', ')[2]}", "cross": f"src long, dst long, {kind.partition(', ')[2]}, dst_block long", "sent": kind, "done": kind}

    def part(name: str, k: int) -> DataFrame | None:
        path = f"{at[name]}/block={k}"
        return spark.read.schema(types[name]).parquet(path) if scratch.exists(spark, path) else None

    for k in range(blocks.n) if down else range(blocks.n - 1, -1, -1):
        own = part("sent", k)
        if own is None:
            continue
        solved(part("inner", k), own).write.parquet(f"{at['done']}/block={k}")
        leaving = part("cross", k)
        if leaving is not None:
            values = part("done", k).select(F.col("rev").alias("src"), *[F.col(c).alias(f"_{c}") for c in fields])
            came = near(leaving).join(values, "src").select(F.col("dst").alias("rev"), F.col("dst_block").alias("block"), *[(F.col(f"_{c}") + F.col(c)).alias(c) for c in fields])
            sent = came.groupBy("rev", "block").agg(*[OPERATORS[op][0](c).alias(c) for c, op in fields.items()])
            sent.where(F.coalesce(*fields).isNotNull()).write.mode("append").partitionBy("block").parquet(at["sent"])
    out = spark.read.schema(f"{kind}, block long").parquet(at["done"]) if scratch.exists(spark, at["done"]) else spark.createDataFrame([], kind)
    for name in ("inner", "cross", "sent"):
        scratch.drop(spark, at[name])
    return out.select("rev", *fields)


class Laid:
    """Edges (child, parent) written block by block once, for many questions of what is reached; each reads only the blocks that it comes to."""

    def __init__(self, revs: DataFrame, edges: DataFrame, size: int = BLOCK) -> None:
        """``revs`` (rev) are nodes that may be asked about and have no edge; both tables are read several times."""
        self.spark = edges.sparkSession
        ways = ordered_edges(edges.select(F.col("child").cast("long").alias("child"), F.col("parent").cast("long").alias("parent")))
        self.blocks = Blocks(revs.select(F.col("rev").cast("long").alias("rev")).unionAll(ways.select("child")).unionAll(ways.select("parent")), size)
        self.home = scratch.folder(self.spark, "laid")
        self.shuffles = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        placed = self.blocks.place(ways, "child", "parent")
        if self.blocks.ranks is not None:
            placed = scratch.cut(placed, "edges")
        inner = placed.where("child_block = parent_block").select("child", "parent", F.col("child_block").alias("block"))
        inner.repartition(self.shuffles, "block").write.partitionBy("block").parquet(f"{self.home}/inner")
        cross = placed.where("child_block <> parent_block")
        self.leaving = {}
        for down, src, dst in ((False, "child", "parent"), (True, "parent", "child")):
            rows = cross.select(F.col(src).alias("src"), F.col(dst).alias("dst"), F.col(f"{dst}_block").alias("dst_block"), F.col(f"{src}_block").alias("block"))
            path = f"{self.home}/{'down' if down else 'up'}"
            rows.repartition(self.shuffles, "block", F.expr("pmod(hash(dst), 16)")).write.partitionBy("block").parquet(path)
            at = self.spark.read.schema("src long, dst long, dst_block long, block long").parquet(path)
            self.leaving[down] = {r.block: r["count"] for r in at.groupBy("block").count().collect()}  # one number a block

    def _part(self, path: str, k: int, schema: str) -> DataFrame | None:
        path = f"{path}/block={k}"
        return self.spark.read.schema(schema).parquet(path) if scratch.exists(self.spark, path) else None

    def reached(self, seeds: DataFrame, down: bool) -> DataFrame:
        """(rev) of the seeds, which must be among the nodes, and all that is reached from them, written."""
        home, none = scratch.folder(self.spark, "reached"), F.lit(None).cast("long")
        seeds = self.blocks.place(seeds.select(F.col("rev").cast("long").alias("rev")), "rev").withColumnRenamed("rev_block", "block")
        seeds.repartition(self.shuffles, "block").write.partitionBy("block").parquet(f"{home}/sent")
        src, dst = ("parent", "child") if down else ("child", "parent")
        solve, zero = _solver({"seen": "any"}, down), F.lit(0).cast("long").alias("seen")
        for k in range(self.blocks.n) if down else range(self.blocks.n - 1, -1, -1):
            rows = self._part(f"{home}/sent", k, "rev long")
            if rows is None:
                continue
            rows = rows.select(F.col("rev").alias("src"), none.alias("dst"), zero)
            inner = self._part(f"{self.home}/inner", k, "child long, parent long")
            if inner is not None:
                rows = rows.unionAll(inner.select(src, dst, zero))
            rows.coalesce(1).mapInArrow(solve, "rev long, seen long").select("rev").write.parquet(f"{home}/done/block={k}")
            leaving = self._part(f"{self.home}/{'down' if down else 'up'}", k, "src long, dst long, dst_block long")
            if leaving is not None:
                values = self._part(f"{home}/done", k, "rev long").withColumnRenamed("rev", "src")
                came = near(leaving, self.leaving[down].get(k, 0)).join(values, "src").select(F.col("dst").alias("rev"), F.col("dst_block").alias("block")).distinct()
                came.write.mode("append").partitionBy("block").parquet(f"{home}/sent")
        if not scratch.exists(self.spark, f"{home}/done"):
            return self.spark.createDataFrame([], "rev long")
        return self.spark.read.schema("rev long, block long").parquet(f"{home}/done").select("rev")

    def drop(self) -> None:
        scratch.drop(self.spark, self.home)


def derived(rows: DataFrame, new_id: Callable[[str | None, str | None, bytes | None], str], size: int = DERIVED, kept: str | None = None, revs: DataFrame | None = None) -> DataFrame:
    """(rev, new_node) of ``rows`` (rev, p1, p2, p1_id, p2_id, content): identifiers made of the parents' and the content.

    With ``kept`` (rev, kept, new_node): that column of bytes goes along, which takes no join afterwards. ``revs`` (rev) are the rows' revs, where these
    cost less to list: then ``rows`` is worked out once. What comes back is written.

    A parent among the rows counts with its new identifier, any other with p1_id or p2_id. Blocks go by in the order of revs,
    each in one task, and send their new identifiers to the later blocks that ask for them. A task has its identifiers in memory, ``size``
    and those that were sent to it, and its contents a batch at a time. A parent that is not before its child is an error.
    """
    spark = rows.sparkSession
    kind = "rev long, p1 long, p2 long, p1_id string, p2_id string, content binary, made string, kept binary"
    result = "rev long, made string, kept binary" if kept else "rev long, made string"
    named = ["rev", *([F.col("kept").alias(kept)] if kept else []), F.col("made").alias("new_node")]
    longs = [F.col(c).cast("long").alias(c) for c in ("rev", "p1", "p2")]
    facts = rows.select(*longs, "p1_id", "p2_id", F.col("content").cast("binary").alias("content"), F.lit(None).cast("string").alias("made"), (F.col(kept) if kept else F.lit(None)).cast("binary").alias("kept"))
    wrong = F.raise_error(F.concat(F.lit("a parent is not before "), F.col("rev").cast("string"))).cast("long")
    facts = facts.withColumn("rev", F.when(F.coalesce(F.greatest("p1", "p2") >= F.col("rev"), F.lit(False)), wrong).otherwise(F.col("rev")))
    blocks = Blocks((facts if revs is None else revs).select("rev"), size)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new: dict[int, str] = {}
        for batch in batches:
            revs, mades, along = [], [], []
            for rev, p1, p2, id1, id2, content, made, fact in zip(*(batch.column(c).to_pylist() for c in range(8)), strict=True):
                if made is None:
                    made = new_id(new.get(p1, id1) if p1 is not None else None, new.get(p2, id2) if p2 is not None else None, content)
                    revs.append(rev)
                    mades.append(made)
                    along.append(fact)
                new[rev] = made
            columns = [pa.array(revs, pa.int64()), pa.array(mades, pa.string()), *([pa.array(along, pa.binary())] if kept else [])]
            yield pa.RecordBatch.from_arrays(columns, names=["rev", "made", *(["kept"] if kept else [])])

    def solved(own: DataFrame) -> DataFrame:
        """What was sent comes first, then a block's rows in order of their revs."""
        return own.sortWithinPartitions(F.col("made").isNull(), "rev").mapInArrow(solve, result)

    if blocks.n <= 1:
        return scratch.cut(solved(facts.repartition(1)), "derived").select(*named)
    home = scratch.folder(spark, "derived")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = blocks.place(facts, "rev").withColumnRenamed("rev_block", "block")
    placed.repartition(n, "block", F.expr("pmod(rev, 16)")).write.partitionBy("block").parquet(f"{home}/rows")
    written = spark.read.schema(f"{kind}, block long").parquet(f"{home}/rows")
    links = written.select(F.explode(F.array_compact(F.array("p1", "p2"))).alias("rev"), F.col("block").alias("asks")).distinct()
    asked = blocks.place(links.join(written.select("rev"), "rev", "left_semi"), "rev").where("rev_block <> asks").withColumnRenamed("rev_block", "block")
    asked.repartition(n, "block", F.expr("pmod(hash(asks), 16)")).write.partitionBy("block").parquet(f"{home}/asked")

    def part(name: str, k: int, schema: str) -> DataFrame | None:
        path = f"{home}/{name}/block={k}"
        return spark.read.schema(schema).parquet(path) if scratch.exists(spark, path) else None

    for k in range(blocks.n):
        own = part("rows", k, kind)
        if own is None:
            continue
        came = part("sent", k, "rev long, made string")
        if came is not None:
            own = own.unionByName(came, allowMissingColumns=True)
        solved(own.coalesce(1)).write.parquet(f"{home}/done/block={k}")  # a block's files are one task's anyway, so they are not dealt again
        wanted = part("asked", k, "rev long, asks long")
        if wanted is not None:
            wanted.join(part("done", k, "rev long, made string"), "rev").select("rev", "made", F.col("asks").alias("block")).write.mode("append").partitionBy("block").parquet(f"{home}/sent")
    done = spark.read.schema(f"{result}, block long").parquet(f"{home}/done") if scratch.exists(spark, f"{home}/done") else spark.createDataFrame([], result)
    for name in ("rows", "asked", "sent"):
        scratch.drop(spark, f"{home}/{name}")
    return done.select(*named)


ship(__name__)
