"""SentencePiece encoding and decoding with a relational lattice.

Text is made of units: a run of word marks with the run of letters, or of other signs, that follows; digits and line
feeds are units of their own. That holds for models none of whose pieces crosses these units (which is checked); for
others a unit is a run of marks and all up to the next mark or line feed. So a text's pieces are its units' pieces.
For the corpus's most frequent units the lattice is built by Spark: substrings of bounded length are exploded, equi-joined to the piece table, gathered by unit and
folded with a higher-order aggregate. The result is a dictionary of bounded size that encoders hold; units
outside it are folded in the task by the same rule.

The public model is a BPE model: its scores are the order of merges, and the best path by added scores is not what
the model's own encoder gives. The fold therefore takes, step by step, the best-ranked edge over two neighbouring
symbols (the leftmost of equals), where a unigram model would take the best path.
"""

from __future__ import annotations

import heapq
import re
import sys
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revstrata.llm.common import release, ship, small_batches, written

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNIT = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n+")
#: Numbers that are neither letters nor decimal digits stand with the other signs.
NUMERALS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not c.isalpha() and not c.isdecimal())
FINE = re.compile(f"{MARK}*(?:[^\\W\\d_{NUMERALS}]+|(?:[^{MARK}\\w\n]|[_{NUMERALS}])+)|\\d|{MARK}+|\n")
#: The same for texts without such numbers, in which it is faster.
FINE_PLAIN = re.compile(f"{MARK}*(?:[^\\W\\d_]+|(?:[^{MARK}\\w\n]|_)+)|\\d|{MARK}+|\n")
#: The same as Java patterns; where the two sides know other characters, units differ, but no piece is cut.
JAVA_UNIT = f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n+"
JAVA_FINE = f"{MARK}*(?:\\p{{L}}+|[^{MARK}\\p{{L}}\\p{{Nd}}\n]+)|\\p{{Nd}}|{MARK}+|\n"
DICTIONARY = 200_000
LONGEST = 48
HELD_UNITS = 300_000
SLICE = 1000


@dataclass(frozen=True)
class Pieces:
    """A piece model: text pieces with their ranks (smaller merges first), and the first of the 256 byte pieces."""

    texts: list[str]
    ranks: dict[str, tuple[float, int]]
    byte0: int
    length: int

    @cached_property
    def order(self) -> dict[str, float]:
        """Each piece's rank alone."""
        return {t: r for t, (r, _) in self.ranks.items()}

    @cached_property
    def fine(self) -> bool:
        """Whether no piece crosses the finer units."""
        return all(FINE.fullmatch(t) for t in self.ranks)


def load_pieces(path: str = MODEL) -> Pieces:
    import sentencepiece

    m = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [m.id_to_piece(k) for k in range(m.get_piece_size())]
    plain = [k for k in range(len(texts)) if not (m.is_control(k) or m.is_unknown(k) or m.is_byte(k) or m.is_unused(k))]
    return Pieces(texts, {texts[k]: (-m.get_score(k), k) for k in plain}, next(k for k in range(len(texts)) if m.is_byte(k)), max(len(texts[k]) for k in plain))


def marked(text: Column) -> Column:
    """A text with a leading word mark and marks for spaces; an empty text stays empty."""
    return F.when(text == "", "").otherwise(F.concat(F.lit(MARK), F.replace(text, F.lit(" "), F.lit(MARK))))


def lattice(units: DataFrame, pieces: Pieces) -> DataFrame:
    """(unit, ids) for distinct strings in the column ``unit``: explode, equi-join, gather, fold.

    The piece table is broadcast: it has as many rows as the model has pieces. Characters without a piece
    become byte pieces. An empty unit has no ids.
    """
    spark = units.sparkSession
    table = spark.createDataFrame([(t, float(r), k) for t, (r, k) in pieces.ranks.items()], "piece string, rank double, id int")
    starts = units.select("unit", F.length("unit").alias("n")).where("n > 0").select("unit", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("s"))
    spans = starts.select("unit", "n", "s", F.explode(F.sequence(F.col("s") + 1, F.least(F.col("n"), F.col("s") + pieces.length))).alias("e"))
    edges = spans.withColumn("piece", F.substring(F.col("unit"), F.col("s") + 1, F.col("e") - F.col("s"))).join(F.broadcast(table), "piece", "left")
    held = edges.where(F.col("id").isNotNull() | (F.col("e") == F.col("s") + 1))
    words = held.groupBy("unit", "n").agg(F.collect_list(F.struct("rank", "s", "e", "id")).alias("edges"))

    def inner(cuts: Column, e: Column) -> Column:
        return F.filter(cuts, lambda c: (c > e["s"]) & (c < e["e"]))

    def merge(cuts: Column, _: Column) -> Column:
        fits = F.filter("edges", lambda e: e["id"].isNotNull() & F.array_contains(cuts, e["s"]) & F.array_contains(cuts, e["e"]) & (F.size(inner(cuts, e)) == 1))
        best = F.array_min(F.transform(fits, lambda e: F.struct(e["rank"], e["s"], e["e"])))
        # a one-element array binds the best edge, so that it is looked for once
        return F.element_at(
            F.transform(F.array(best), lambda b: F.when(b.isNull(), cuts).otherwise(F.filter(cuts, lambda c: ~((c > b["s"]) & (c < b["e"]))))), 1
        )

    cuts = F.aggregate(F.sequence(F.lit(1), F.col("n")), F.sequence(F.lit(0), F.col("n")), merge)
    code = lambda s, e: F.element_at(F.filter("edges", lambda x: (x["s"] == s) & (x["e"] == e)), 1)["id"]

    def spelled(s: Column) -> Column:
        digits = F.hex(F.encode(F.substring(F.col("unit"), s + 1, F.lit(1)), "UTF-8"))
        return F.transform(F.sequence(F.lit(1), (F.length(digits) / 2).cast("int")), lambda i: F.conv(F.substring(digits, 2 * i - 1, F.lit(2)), 16, 10).cast("int") + pieces.byte0)

    folded = words.withColumn("cuts", cuts)
    ids = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.size("cuts") - 1),
            lambda k: F.transform(F.array(F.struct(F.element_at("cuts", k).alias("s"), F.element_at("cuts", k + 1).alias("e"))), lambda x: F.when(code(x["s"], x["e"]).isNotNull(), F.array(code(x["s"], x["e"]))).otherwise(spelled(x["s"])))[0],
        )
    )
    return folded.select("unit", ids.alias("ids"))


def best_paths(units: DataFrame, scores: DataFrame, length: int, unknown: float = -20.0) -> DataFrame:
    """(unit, pieces, score) by Viterbi, for unigram models: the path of the highest sum of scores through each unit's lattice.

    ``scores`` is the piece table (piece, score), of pieces of at most ``length`` characters. A character without a piece of
    its own is an edge with the score ``unknown``. Of equal paths the one whose last piece is longer wins. An empty unit
    has no pieces; repeated units are one row.
    """
    named = units.select("unit", F.length("unit").alias("n")).distinct()
    starts = named.where("n > 0").select("unit", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("s"))
    spans = starts.select("unit", "n", "s", F.explode(F.sequence(F.col("s") + 1, F.least(F.col("n"), F.col("s") + length))).alias("e"))
    edges = spans.withColumn("piece", F.substring(F.col("unit"), F.col("s") + 1, F.col("e") - F.col("s"))).join(scores.select("piece", F.col("score").cast("double").alias("score")), "piece", "left")
    held = edges.where(F.col("score").isNotNull() | (F.col("e") == F.col("s") + 1)).withColumn("score", F.coalesce("score", F.lit(unknown)))
    words = held.groupBy("unit", "n").agg(F.collect_list(F.struct("s", "e", "score")).alias("edges"))

    def further(best: Column, e: Column) -> Column:
        into = F.transform(F.filter("edges", lambda x: x["e"] == e), lambda x: F.struct((F.get(best, x["s"])["score"] + x["score"]).alias("score"), (-x["s"]).alias("back")))
        return F.concat(best, F.array(F.array_max(into)))

    root = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).alias("back")))
    folded = words.withColumn("best", F.aggregate(F.sequence(F.lit(1), F.col("n")), root, further))

    def back(cuts: Column, _: Column) -> Column:
        first = F.get(cuts, F.lit(0))
        return F.when(first > 0, F.concat(F.array(-F.get(F.col("best"), first)["back"]), cuts)).otherwise(cuts)

    cuts = F.aggregate(F.sequence(F.lit(1), F.col("n")), F.array(F.col("n")), back)
    found = folded.withColumn("cuts", cuts)
    pieces = F.transform(F.sequence(F.lit(1), F.size("cuts") - 1), lambda k: F.substring(F.col("unit"), F.element_at("cuts", k) + 1, F.element_at("cuts", k + 1) - F.element_at("cuts", k)))
    paths = found.select("unit", pieces.alias("pieces"), F.element_at("best", -1)["score"].alias("score"))
    return paths.unionByName(named.where("n = 0").select("unit", F.array().cast("array<string>").alias("pieces"), F.lit(0.0).alias("score")))


def units_of(text: str, pieces: Pieces) -> list[str]:
    """The units of a text that is not empty, in order."""
    return (FINE if pieces.fine else UNIT).findall(MARK + text.replace(" ", MARK))


def words_of(text: str) -> list[str]:
    """The units of a text in their coarser form, which hold whole finer ones."""
    if MARK in text or "  " in text or text[0] == " ":
        return UNIT.findall(MARK + text.replace(" ", MARK))
    words = (MARK + text.replace(" ", " " + MARK)).replace("\n", " \n ").split(" ")
    return [w for w in words if w]


def fold_unit(unit: str, pieces: Pieces) -> list[int]:
    """The same fold for one unit in a task: over a list for short units, else with a heap, in n log n of the unit's length."""
    if len(unit) > LONGEST:
        return _fold_long(unit, pieces)
    rank, never = pieces.order.get, float("inf")
    parts = list(unit)
    scores = [rank(a + b, never) for a, b in zip(parts, parts[1:], strict=False)]
    while scores:
        best = min(scores)
        if best == never:
            break
        i = scores.index(best)
        both = parts[i] + parts.pop(i + 1)
        parts[i] = both
        del scores[i]
        if i < len(scores):
            scores[i] = rank(both + parts[i + 1], never)
        if i:
            scores[i - 1] = rank(parts[i - 1] + both, never)
    return _ids_of(parts, pieces)


def _ids_of(parts: Iterable[str], pieces: Pieces) -> list[int]:
    """The identifiers of pieces; characters without one become byte pieces."""
    out: list[int] = []
    for part in parts:
        found = pieces.ranks.get(part)
        if found is not None:
            out.append(found[1])
        else:
            out.extend(pieces.byte0 + b for b in part.encode("utf-8", "surrogatepass"))
    return out


def _fold_long(unit: str, pieces: Pieces) -> list[int]:
    ranks = pieces.ranks
    n = len(unit)
    left, right, end = list(range(-1, n - 1)), list(range(1, n + 1)), list(range(1, n + 1))
    heap = [(*ranks[unit[i : i + 2]], i, i + 2) for i in range(n - 1) if unit[i : i + 2] in ranks]
    heap = [(r, i, j) for r, _, i, j in heap]
    heapq.heapify(heap)
    alive = [True] * n
    while heap:
        _, i, j = heapq.heappop(heap)
        if not alive[i] or right[i] >= n or end[right[i]] != j:
            continue
        k = right[i]
        alive[k] = False
        end[i] = j
        right[i] = right[k]
        if right[i] < n:
            left[right[i]] = i
            text = unit[i : end[right[i]]]
            if text in ranks:
                heapq.heappush(heap, (ranks[text][0], i, end[right[i]]))
        if left[i] >= 0:
            text = unit[left[i] : j]
            if text in ranks:
                heapq.heappush(heap, (ranks[text][0], left[i], j))
    parts, i = [], 0
    while i < n:
        parts.append(unit[i : end[i]])
        i = right[i]
    return _ids_of(parts, pieces)


def dictionary(docs: DataFrame, pieces: Pieces, size: int = DICTIONARY, longest: int = LONGEST) -> dict[str, bytes]:
    """Identifiers, as bytes of int32, of the ``size`` most frequent units of at most ``longest`` characters, counted over all texts."""
    pattern = JAVA_FINE if pieces.fine else JAVA_UNIT
    units = docs.select(F.explode(F.regexp_extract_all(marked(F.coalesce("text", F.lit(""))), F.lit(f"({pattern})"))).alias("unit"))
    counts = units.where(F.length("unit") <= longest).groupBy("unit").count().where("count > 1")
    frequent = written(counts.orderBy(F.desc("count"), "unit").limit(size).select("unit"), "units")
    release(docs.sparkSession)
    per = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = written(lattice(frequent.repartition(per, "unit"), pieces), "unit-pieces")
    return {r["unit"]: np.array(r["ids"], dtype=np.int32).tobytes() for r in known.toLocalIterator()}


def encode(docs: DataFrame, model: str = MODEL, size: int = DICTIONARY) -> DataFrame:
    """``docs`` with ids (array<int>), n_pieces (long) and lossless (the ids decode to the text).

    A null or empty text has no ids. A text that holds the word mark itself decodes to one with spaces, and so is not
    lossless. Other columns stay, but columns named ids, n_pieces or lossless are replaced; repeated rows have equal results.
    """
    spark: SparkSession = docs.sparkSession
    pieces = load_pieces(model)
    known, raw = dictionary(docs, pieces, size), raw_pieces(pieces)
    plain = (pieces.texts, pieces.ranks, pieces.byte0, pieces.length)
    held = spark.sparkContext.broadcast((plain, known, {u for u, ids in known.items() if not _decodes(u, ids, raw)}))
    small_batches(spark)

    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        parts, known, lossy = held.value
        pieces, lossy, wrong = Pieces(*parts), set(lossy), []
        raw = raw_pieces(pieces)
        met: dict[str, bytes] = {}  # other words met so far
        numerals = frozenset(NUMERALS)

        def fold(unit: str) -> bytes:
            ids = fold_unit(unit, pieces)
            if b"".join([raw[k] for k in ids]) != unit.replace(MARK, " ").encode("utf-8", "surrogatepass"):
                wrong.append(unit)
            return array("i", ids).tobytes()

        def learn(word: str) -> bytes:
            if len(met) >= HELD_UNITS:
                met.clear()
            if not pieces.fine or word.lstrip(MARK).isalpha():
                ids = fold(word)
            else:
                units = (FINE_PLAIN if numerals.isdisjoint(word) else FINE).findall(word)
                ids = b"".join([known.get(u) or fold(u) for u in units])
                wrong.extend(lossy.intersection(units) if lossy else ())
            if wrong:
                lossy.add(word)
                wrong.clear()
            met[word] = ids
            return ids

        for batch in (b.slice(k, SLICE) for b in batches for k in range(0, len(b), SLICE)):
            ids, lossless = [], []
            for text in batch.to_pylist():
                units = words_of(text) if text else ()
                found = [known.get(u) or met.get(u) or learn(u) for u in units]
                ids.append(b"".join(found))
                lossless.append(not text or (MARK not in text and (not lossy or lossy.isdisjoint(units))))
            offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), dtype=np.int32))
            yield pa.StructArray.from_arrays([pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(lossless, pa.bool_())], names=["ids", "lossless"])

    coded = docs.withColumn("_coded", F.arrow_udf(of, "ids array<int>, lossless boolean")("text"))
    return coded.withColumn("ids", F.col("_coded.ids")).withColumn("lossless", F.col("_coded.lossless")).withColumn("n_pieces", F.size("ids").cast("long")).drop("_coded")


def raw_pieces(pieces: Pieces) -> list[bytes]:
    """The bytes that every piece stands for; control pieces stand for none."""
    out = [t.replace(MARK, " ").encode() if t in pieces.ranks else b"" for t in pieces.texts]
    for b in range(256):
        out[pieces.byte0 + b] = bytes([b])
    return out


def _decodes(unit: str, ids: bytes, raw: list[bytes]) -> bool:
    """Whether a unit's identifiers decode to the unit."""
    return b"".join([raw[k] for k in np.frombuffer(ids, dtype=np.int32).tolist()]) == unit.replace(MARK, " ").encode("utf-8", "surrogatepass")


def joined(ids: np.ndarray, raw: list[bytes]) -> str:
    """The text of identifiers, less the leading space that encoding put there."""
    text = b"".join([raw[k] for k in ids.tolist()]).decode("utf-8", "replace")
    return text[1:] if text[:1] == " " else text


def decode(coded: DataFrame, model: str = MODEL, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``coded`` with the text of its column of identifiers; null identifiers have the text ""."""
    held = coded.sparkSession.sparkContext.broadcast(raw_pieces(load_pieces(model)))

    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([joined(np.array(x or [], dtype=np.int64), held.value) for x in batch.to_pylist()], pa.string())

    return coded.withColumn(out, F.arrow_udf(of, "string")(F.col(ids)))


ship(__name__)
