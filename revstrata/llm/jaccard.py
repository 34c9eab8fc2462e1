"""Exact joins of documents by the Jaccard likeness of their word n-grams, with a token-group matrix.

1. Equal sets are one class. Everything that follows works on classes.
2. Of each class only the tokens (hashed n-grams) at the front of one global order are listed: two sets as
   like as asked must share at least ``need`` of them. The order puts tokens that are frequent in a bounded
   sample last; it decides what the join costs, never what it finds.
3. Classes are gathered into groups: every listed token proposes its least edited class as leader, and a
   class is grouped with the leaders that it is verified to link with.
4. The token-group matrix holds each group's union of listed tokens, with the sizes and places at
   which its members hold them. Pairs of groups whose overlap in it could reach the threshold qualify;
   only these are opened, and only their members that could link are verified: those whose listed tokens and
   whose spreads over a few dozen buckets of tokens allow the overlap.

As only links between different groups are looked for in step 4, no group's own pairs are ever
listed, however large the group is. Every link between different texts lies inside a component.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revstrata.llm.common import mix64, release, ship, small_batches, written
from revstrata.llm.components import components

NEED = 3
BLOCK = 256
BLOCK_TOKENS = 2_000_000
SLICE = 500
FILTER_BITS = 24
BUCKETS = 64
WORD_STEP = np.uint64(0x9E3779B97F4A7C55)
CHAIN = np.uint64(0xD6E8FEB86659FD93)


class Shingler:
    """Sets of hashed word n-grams; words are runs of bytes other than white space, with A-Z in lower case."""

    def __init__(self, words: int) -> None:
        self.words = words
        self.powers = np.array([1], dtype=np.uint64)

    def __call__(self, text: str | None) -> np.ndarray:
        """The sorted distinct hashes (uint64); all words as one n-gram, if there are too few; empty without words."""
        raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
        space = (raw == 32) | ((raw >= 9) & (raw <= 13))
        starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]]))
        if not len(starts):
            return np.zeros(0, dtype=np.uint64)
        c = np.where(space, 0, raw.astype(np.uint64) + np.where((raw >= 65) & (raw <= 90), 33, 1).astype(np.uint64)).astype(np.uint64)
        at = np.arange(len(raw)) - np.repeat(np.concatenate([[0], starts]), np.diff(np.concatenate([[0], starts, [len(raw)]])))
        while len(self.powers) <= at.max():
            self.powers = np.concatenate([self.powers, self.powers * (self.powers[-1:] * WORD_STEP)])
        h = mix64(np.add.reduceat(c * self.powers[at], starts))
        k = min(self.words, len(h))
        s = np.full(len(h) - k + 1, k, dtype=np.uint64)
        for i in range(k):
            s = mix64(s * CHAIN + h[i : len(h) - k + 1 + i])
        return np.unique(s)


def digest(tokens: np.ndarray) -> int:
    """A number for a set, the same for equal sets."""
    d = np.concatenate([mix64(tokens ^ CHAIN), np.array([len(tokens)], dtype=np.uint64) * WORD_STEP])
    return int(mix64(np.add.reduce(d, keepdims=True)).view(np.int64)[0])


def required(n: int | Column, percent: int) -> int | Column:
    """The least overlap of a set of n tokens with any set that links with it: percent/100 of n, rounded up."""
    return F.ceil(n * percent / 100.0 - 1e-9).cast("int") if isinstance(n, Column) else -(-n * percent // 100)


def frequent_tokens(docs: DataFrame, words: int, one_in: int = 5, sample_rows: int = 10_000, least: int = 3, most: int = 500_000) -> np.ndarray:
    """Tokens of at least ``least`` documents of a sample (one in ``one_in``, but about ``sample_rows`` at least), at most ``most``.

    Only the order uses them. The share of the sample is fixed, so that "frequent" means as many documents at every size.
    """
    total = docs.count()
    places = 1_000_000
    share = places if total <= sample_rows else max(places // one_in, int(places * sample_rows / total) + 1)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle = Shingler(words)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(shingle(text).view(np.int64))], names=["token"])

    tokens = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(places)) < share).select("text").mapInArrow(of, "token long")
    often = tokens.groupBy("token").count().where(F.col("count") >= least).orderBy(F.desc("count"), "token").limit(most)
    return np.sort(often.toPandas()["token"].to_numpy(dtype=np.int64).view(np.uint64))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A hash of a row's doc_id and text: never null, and different for the texts under one doc_id."""
    return F.xxhash64(F.col(doc_id).cast("long"), F.col(text))


def sets_of(docs: DataFrame, words: int, percent: int, frequent: np.ndarray, need: int = NEED) -> DataFrame:
    """(doc_id, n, class, tokens, spread, key): set size, the set's digest, the listed tokens in order, how many tokens fall in each of BUCKETS, row_key().

    Within a task only a class's first row has tokens and spread (the last 100,000 classes are remembered).
    """
    held = docs.sparkSession.sparkContext.broadcast(frequent)
    smallest = next(n for n in range(1, 1000) if (n + 1) * percent <= 100 * n)  # smaller sets link with equal ones only

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, often, seen = Shingler(words), held.value, {}
        for batch in (b.slice(k, SLICE) for b in batches for k in range(0, b.num_rows, SLICE)):
            sizes, classes, lists, spreads = [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingle(text)
                n, d = len(s), digest(s)
                tokens = spread = None
                if n >= smallest and d not in seen:
                    seen[d] = None
                    if len(seen) > 100_000:
                        del seen[next(iter(seen))]
                    at = np.searchsorted(often, s)
                    late = (often[np.minimum(at, len(often) - 1)] == s) if len(often) else np.zeros(n, dtype=bool)
                    tokens = np.concatenate([s[~late], s[late]])[: n - required(n, percent) + need].view(np.int64)
                    spread = np.bincount((s >> np.uint64(20)).astype(np.int64) % BUCKETS, minlength=BUCKETS).astype(np.int32)
                sizes.append(n)
                classes.append(d)
                lists.append(tokens)
                spreads.append(spread)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int32()), pa.array(classes, pa.int64()), pa.array(lists, pa.list_(pa.int64())), pa.array(spreads, pa.list_(pa.int32())), batch.column(2)],
                names=["doc_id", "n", "class", "tokens", "spread", "key"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text", row_key().alias("key")).mapInArrow(of, "doc_id long, n int, class long, tokens array<long>, spread array<int>, key long")


def _filter_of(ids: DataFrame) -> np.ndarray:
    """A bit for each of 2**FILTER_BITS remainders of the keys: 2 MB, whatever the number of ids."""
    h = F.pmod(F.col("key"), F.lit(1 << FILTER_BITS))
    bits = ids.select(F.shiftright(h, 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(pmod(key, 64) as int))").alias("bit"))
    words = bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    out[words["word"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def _sets_for(docs: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """(class, set) of the classes of ``ids`` (class, key), each from the row with that key; others are left out by a filter of fixed size, then by the join."""
    held = docs.sparkSession.sparkContext.broadcast(_filter_of(ids))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, seen = Shingler(words), {}
        for batch in batches:
            keys, h = batch.column(0).to_pylist(), batch.column(2).to_numpy()
            live = []
            for k in np.flatnonzero((held.value[h >> 6] >> (h & 63).astype(np.uint64)) & np.uint64(1)):
                if keys[k] not in seen:  # repeated rows have one key
                    seen[keys[k]] = None
                    if len(seen) > 100_000:
                        del seen[next(iter(seen))]
                    live.append(k)
            for k in range(0, len(live), 500):
                part = batch.take(pa.array(live[k : k + 500], pa.int64()))
                sets = [shingle(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array([digest(x) for x in sets], pa.int64()), pa.array([x.tobytes() for x in sets], pa.binary())], names=["class", "set"])

    hashed = docs.select(row_key().alias("key"), "text", F.pmod(row_key(), F.lit(1 << FILTER_BITS)).alias("h"))
    # joined by the set's own digest, so that no other text can stand for a class; one row a class, whatever rows have one key
    return ids.select("class").join(hashed.mapInArrow(of, "class long, set binary"), "class").dropDuplicates(["class"])


def _verified(docs: DataFrame, pairs: DataFrame, representatives: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that link, checked on whole sets.

    The pairs of one class a are cut into blocks of about BLOCK, or of about BLOCK_TOKENS tokens, each with a copy of a's set.
    """
    pairs = written(pairs, "pairs")
    sizes = pairs.join(representatives.select(F.col("class").alias("b"), "n"), "b")
    blocks = sizes.groupBy("a").agg(F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_TOKENS)).cast("int").alias("blocks"))
    dealt = pairs.join(blocks, "a").select("a", F.pmod(F.xxhash64("b"), F.col("blocks")).cast("int").alias("block"), "b")
    rows = dealt.select("a", "block", F.col("b").alias("class")).unionAll(dealt.select("a", "block", F.col("a").alias("class")).distinct())
    ids = rows.select("class").distinct().join(representatives, "class")
    ids = written(ids.select("key", "class"), "asked")
    sets = _sets_for(docs, ids, words)

    def of(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        own = {c: np.frombuffer(s, dtype=np.uint64) for c, s in zip(group["class"], group["set"], strict=True)}
        x = own[key[0]]
        out = []
        for c, y in own.items():
            if c != key[0]:
                at = np.searchsorted(x, y)
                both = int((x[np.minimum(at, len(x) - 1)] == y).sum()) if len(x) else 0
                if both and 100 * both >= percent * (len(x) + len(y) - both):
                    out.append(c)
        return pd.DataFrame({"a": [key[0]] * len(out), "b": out}).astype("int64")

    return written(rows.join(sets, "class").groupBy("a", "block").applyInPandas(of, "a long, b long"), "verified")


def _listed(sets: DataFrame, percent: int, need: int) -> DataFrame:
    """(token, class, n, reach, leader) of listed tokens that more classes than one hold.

    ``reach`` is the size up to which a set may link with this one and have this token among the first
    they share; a set is strong at a token if it reaches its own size: of two that link, the smaller is.
    """
    per = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = sets.where(F.col("tokens").isNotNull()).select("class", "n", F.posexplode("tokens").alias("place", "token"))
    once = rows.repartition(per, "token").groupBy("token", "class").agg(F.first("n").alias("n"), F.first("place").alias("place"))
    here = Window.partitionBy("token")
    shared = once.withColumn("classes", F.count("*").over(here)).withColumn("leader", F.min(F.struct("place", "n", "class")).over(here)).where(F.col("classes") > 1)
    left = F.col("n") - F.greatest(F.col("place") - (need - 1), F.lit(0))
    reach = (F.floor(left * (100 + percent) / percent + 1e-9) - F.col("n")).cast("int")
    return shared.select("token", "class", "n", reach.alias("reach"), F.col("leader.class").alias("leader"), F.col("leader.n").alias("leader_n"))


def _needed(percent: int, need: int, *sizes: Column) -> Column:
    return F.least(F.lit(need), *[required(n, percent) for n in sizes])


def _could_link(percent: int, x: Column, xn: Column, y: Column, yn: Column) -> Column:
    """Whether the overlap that two sets' spreads allow, the sum of the lesser counts of each bucket, reaches the threshold."""
    most = F.aggregate(F.zip_with(x, y, lambda i, j: F.least(i, j)), F.lit(0), lambda t, v: t + v)
    return most * (100 + percent) >= (xn + yn) * percent


def _opened(placed: DataFrame, qualify: DataFrame, spreads: DataFrame, percent: int, need: int) -> DataFrame:
    """The pairs (a, b) of classes that could link, with a of the smaller set, in the pairs of groups (small, large) that qualify.

    Of a pair of groups the one with fewer listed tokens is copied for the other, so that a group with many partners stays
    where it is and is met by its partners' rows.
    """
    rows = placed.groupBy("group").agg(F.count("*").alias("rows"))
    sized = qualify.join(rows.select(F.col("group").alias("small"), F.col("rows").alias("small_rows")), "small")
    sized = sized.join(rows.select(F.col("group").alias("large"), F.col("rows").alias("large_rows")), "large")
    turned = F.col("large_rows") < F.col("small_rows")
    pairs = sized.select(F.when(turned, F.col("large")).otherwise(F.col("small")).alias("mover"), F.when(turned, F.col("small")).otherwise(F.col("large")).alias("group"), turned.alias("turned"))
    whole = placed.join(spreads, "class")
    p = placed.withColumnRenamed("group", "mover").join(pairs, "mover").join(spreads, "class")
    p = p.select("token", "group", "turned", F.col("class").alias("pc"), F.col("n").alias("pn"), F.col("reach").alias("pr"), F.col("spread").alias("ps"))
    q = whole.join(pairs.select("group").distinct(), "group", "left_semi").select(
        "token", "group", F.col("class").alias("qc"), F.col("n").alias("qn"), F.col("reach").alias("qr"), F.col("spread").alias("qs")
    )
    side = lambda x, y: F.when(F.col("turned"), F.col(y)).otherwise(F.col(x))
    an, ar, bn, br = side("pn", "qn"), side("pr", "qr"), side("qn", "pn"), side("qr", "pr")
    fits = (an <= bn) & (ar >= bn) & (br >= an) & (bn * percent <= an * 100)
    same = (F.col("p.token") == F.col("q.token")) & (F.col("p.group") == F.col("q.group"))
    met = p.alias("p").join(q.alias("q"), same & fits & _could_link(percent, F.col("ps"), F.col("pn"), F.col("qs"), F.col("qn")))
    found = met.select(side("pc", "qc").alias("a"), side("qc", "pc").alias("b"), an.alias("an"), bn.alias("bn"))
    counts = found.groupBy("a", "b").agg(F.count("*").alias("shared"), F.first("an").alias("an"), F.first("bn").alias("bn"))
    return counts.where(F.col("shared") >= _needed(percent, need, F.col("an"), F.col("bn"))).select("a", "b")


def links_and_classes(docs: DataFrame, words: int = 5, percent: int = 80, need: int = NEED) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, class, key) of every document, and links (a, b) of classes whose components are those of all links."""
    docs = docs.select("doc_id", "text")
    small_batches(docs.sparkSession)
    sets = written(sets_of(docs, words, percent, frequent_tokens(docs, words), need), "sets")
    representatives = sets.where(F.col("n") > 0).groupBy("class").agg(F.min("key").alias("key"), F.first("n").alias("n"))
    listed = written(_listed(sets, percent, need), "listed")
    release(docs.sparkSession)
    spreads = sets.where(F.col("spread").isNotNull()).groupBy("class").agg(F.first("spread").alias("spread"))

    proposed = (
        listed.where((F.col("leader") != F.col("class")) & (F.col("n") * percent <= F.col("leader_n") * 100) & (F.col("leader_n") * percent <= F.col("n") * 100))
        .groupBy("leader", "class")
        .agg(F.count("*").alias("shared"), F.first("n").alias("n"), F.first("leader_n").alias("leader_n"))
        .where(F.col("shared") >= _needed(percent, need, F.col("n"), F.col("leader_n")))
        .join(spreads.withColumnRenamed("spread", "own"), "class")
        .join(spreads.withColumnRenamed("class", "leader"), "leader")
        .where(_could_link(percent, F.col("own"), F.col("n"), F.col("spread"), F.col("leader_n")))
        .select(F.col("leader").alias("a"), F.col("class").alias("b"))
    )
    stars = _verified(docs, proposed, representatives, words, percent)
    groups = components(stars)
    release(docs.sparkSession)

    placed = written(
        listed.drop("leader", "leader_n").join(groups.select(F.col("node").alias("class"), F.col("component").alias("group")), "class", "left").withColumn(
            "group", F.coalesce("group", "class")
        ),
        "placed",
    )
    matrix = placed.groupBy("token", "group").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.max("reach").alias("reach"), F.max(F.col("reach") >= F.col("n")).alias("strong"))
    s, w = matrix.where("strong").alias("s"), matrix.alias("w")
    overlap = s.join(
        w,
        (F.col("s.token") == F.col("w.token"))
        & (F.col("s.group") != F.col("w.group"))
        & (F.col("s.reach") >= F.col("w.low"))
        & (F.col("w.reach") >= F.col("s.low"))
        & (F.col("s.low") <= F.col("w.high"))
        & (F.col("s.high") * 100 >= F.col("w.low") * percent),
    ).select(F.col("s.token").alias("token"), F.col("s.group").alias("small"), F.col("w.group").alias("large"), F.least("s.low", "w.low").alias("low"))
    qualify = overlap.groupBy("small", "large").agg(F.count("*").alias("shared"), F.min("low").alias("low")).where(F.col("shared") >= _needed(percent, need, F.col("low")))
    qualify = written(qualify.select("small", "large"), "qualifying")
    release(docs.sparkSession)

    across = _verified(docs, _opened(placed, qualify, spreads, percent, need), representatives, words, percent)
    return sets.select("doc_id", "n", "class", "key"), stars.unionAll(across)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text).

    Two documents link when 100 * intersection >= percent * union of their sets of ``words``-word n-grams; a
    component's id is its smallest doc_id. A document without words (or a null text) has an empty set and is
    alone. Rows with a null doc_id are kept, and are smallest only among themselves. Repeated rows stay.
    """
    classes, links = links_and_classes(docs, words, percent)
    found = components(links)
    of_class = classes.where(F.col("n") > 0).groupBy("class").agg(F.min("doc_id").alias("least"))
    grouped = of_class.join(found.select(F.col("node").alias("class"), "component"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = grouped.groupBy("component").agg(F.min("least").alias("component_id"))
    ids = grouped.select("class", "component").join(least, "component").select("class", "component_id")
    return classes.join(ids.hint("merge"), "class", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, with its own columns, less all but one of each group of linked documents.

    The row with the smallest doc_id stays; one with a null doc_id only where the group has no other. A doc_id with
    several texts is as many documents. Rows without words stay, one for each doc_id and text.
    """
    classes, links = links_and_classes(docs, words, percent)
    found = components(links).select(F.col("node").alias("class"), "component")
    best = classes.where(F.col("n") > 0).groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "key")).alias("best"))
    kept = best.join(found, "class", "left").groupBy(F.coalesce("component", "class").alias("component")).agg(F.min("best").alias("best")).select(F.col("best.key").alias("_row_key"))
    kept = kept.unionAll(classes.where(F.col("n") == 0).select(F.col("key").alias("_row_key")).distinct())
    return docs.withColumn("_row_key", row_key()).join(kept, "_row_key", "left_semi").dropDuplicates(["_row_key"]).select(*docs.columns)


ship(__name__)
