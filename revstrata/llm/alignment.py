"""Alignment of two tokenizers' tokens by interval coalescing.

Both tokenizers cut the same bytes. All tokens of either are sorted by start; the running maximum of their ends is accumulated,
and a group begins where a start reaches it. Within a group tokens whose byte ranges overlap are linked.

Neither tokenizer has a token over the end of a character that is no space and a space behind it. So texts are cut there into
units, equal units of a task are encoded and coalesced once, in bulk, and a text is the sum of its units.

Every text is encoded once. What the counts need of a text (its different links with how often each occurs) is written to the
shared folder; the counts over all texts are an aggregate over it. Counts go to the texts in one of two ways with equal
results: each task reads the table of counts while that has no more than ``LOOKUP`` rows, else the links are joined to it.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revstrata.llm.common import scratch, ship, small_batches, written

BYTE_BPE, PIECE_BPE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Characters of texts that are worked together, units and characters of units that a task remembers, and tokens aligned at once.
TOGETHER, UNITS, UNIT_CHARS, TOKENS = 1 << 21, 400_000, 1 << 25, 1 << 21
#: Rows of the table of counts that a task may hold; beyond it, links are joined.
LOOKUP = 8_000_000
CUT, RUN, ODD = re.compile(r"(?<=\S) "), re.compile(r" (?:[^ ]|(?<!\S) )*"), re.compile(r"\s ")


def byte_alphabet() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as: printable Latin-1 as itself, the others from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def pieces_of(text: str, step: int = TOGETHER) -> Iterator[str]:
    """A text that starts with a space in pieces of about ``step`` characters, each starting with a space where neither tokenizer joins."""
    at = 0
    while at < len(text):
        cut = CUT.search(text, at + step) if at + step < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def units_of(piece: str) -> list[str]:
    """The units of a piece, each less its leading space."""
    if ODD.search(piece) or piece.endswith(" "):
        return [u[1:] for u in RUN.findall(piece)]
    return piece[1:].split(" ")


def coalesce(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups and links of two tilings of one range of bytes by their ends: (a_group, b_group, group_starts, link_a, link_b).

    Groups are numbered from 0; links are indices of overlapping tokens.
    """
    a_starts, b_starts = np.concatenate([[0], a_ends[:-1]]), np.concatenate([[0], b_ends[:-1]])
    starts, ends = np.concatenate([a_starts, b_starts]), np.concatenate([a_ends, b_ends])
    side = np.repeat([0, 1], [len(a_ends), len(b_ends)])
    order = np.lexsort((side, starts))
    reach = np.maximum.accumulate(ends[order])
    opens = np.ones(len(order), dtype=bool)
    opens[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(opens) - 1
    first = np.searchsorted(b_ends, a_starts, side="right")
    behind = np.searchsorted(b_starts, a_ends, side="left")
    n = behind - first
    link_a = np.repeat(np.arange(len(a_ends)), n)
    link_b = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    return group[: len(a_ends)], group[len(a_ends) :], starts[order][opens], link_a, link_b


class Aligner:
    """Aligned units of a task, by both tokenizers; one unit's facts are the sums, group text and links that texts are made of."""

    def __init__(self, byte_bpe: str, piece_bpe: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_bpe)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_bpe)
        alphabet = byte_alphabet()
        names = {i: t for t, i in self.a.get_vocab().items()}
        # an added token's string is written as it is, not in the alphabet; it never comes out of a text
        self.a_bytes = [bytes(alphabet[c] for c in t) if all(c in alphabet for c in t) else t.encode() for t in (names.get(i, "") for i in range(max(names) + 1))]
        raw = [(self.b.id_to_piece(i), self.b.is_byte(i)) for i in range(self.b.vocab_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if byte else p.replace("▁", " ").encode() for p, byte in raw]
        self.a_len, self.b_len = (np.array([len(x) for x in table], dtype=np.int64) for table in (self.a_bytes, self.b_bytes))
        self.space = self.b.piece_to_id("▁")
        self.n_b = len(self.b_bytes)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.text: list[str] = []
        self.sums = np.zeros((0, 4), dtype=np.int64)  # tokens of A and B, groups, links
        self.sound = np.zeros(0, dtype=bool)
        self.at = np.zeros(1, dtype=np.int64)
        self.codes = np.zeros(0, dtype=np.int64)
        self.chars = 0

    def learn(self, units: set[str]) -> None:
        """Encode and align the units that are not known yet."""
        new = [u for u in units if u not in self.known]
        if not new:
            return
        parts = [(self.sums, self.sound, self.at, self.codes)]
        low = 0
        while low < len(new):
            high, size = low, 0
            while high < len(new) and (high == low or size + len(new[high]) < TOKENS):
                size += len(new[high]) + 1
                high += 1
            parts.append(self._aligned(new[low:high]))
            low = high
        for k, u in enumerate(new, len(self.known)):
            self.known[u] = k
            self.chars += len(u)
        self.sums = np.concatenate([p[0] for p in parts])
        self.sound = np.concatenate([p[1] for p in parts])
        self.codes = np.concatenate([p[3] for p in parts])
        steps = np.concatenate([np.diff(p[2]) for p in parts])
        self.at = np.concatenate([[0], np.cumsum(steps)])

    def _aligned(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        a = [e.ids for e in self.a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]
        b = [ids or [self.space] for ids in self.b.encode(units, num_threads=1)]  # the piece model adds the space itself, but to an empty text
        sound = np.array([(whole := b"".join(map(self.a_bytes.__getitem__, x))) == b"".join(map(self.b_bytes.__getitem__, y)) == (" " + u).encode() and bool(whole) for u, x, y in zip(units, a, b, strict=True)])
        good = np.flatnonzero(sound)
        sums = np.zeros((len(units), 4), dtype=np.int64)
        texts = [""] * len(units)
        if not len(good):
            self.text += texts
            return sums, sound, np.zeros(len(units) + 1, dtype=np.int64), np.zeros(0, dtype=np.int64)
        na, nb = (np.array([len(ids[k]) for k in good]) for ids in (a, b))
        a_ids, b_ids = (np.fromiter(chain.from_iterable(ids[k] for k in good), dtype=np.int64) for ids in (a, b))
        a_group, b_group, starts, link_a, link_b = coalesce(np.cumsum(self.a_len[a_ids]), np.cumsum(self.b_len[b_ids]))
        # units meet where both have a token's end, so each has whole groups
        a_unit = np.repeat(np.arange(len(good)), na)
        group_unit = np.zeros(len(starts), dtype=np.int64)
        group_unit[a_group] = a_unit
        links = a_unit[link_a]
        n_links = np.bincount(links, minlength=len(good))
        sums[good] = np.stack([na, nb, np.bincount(group_unit, minlength=len(good)), n_links], axis=1)
        groups = self._texts(a_ids, a_group, b_ids, b_group, len(starts))
        behind = np.cumsum(np.bincount(group_unit, minlength=len(good)))
        for k, low, high in zip(good, [0, *behind[:-1]], behind, strict=True):
            texts[k] = ";".join(groups[low:high])
        self.text += texts
        at = np.zeros(len(units) + 1, dtype=np.int64)
        at[good + 1] = n_links
        return sums, sound, np.cumsum(at), a_ids[link_a] * self.n_b + b_ids[link_b]

    @staticmethod
    def _texts(a_ids: np.ndarray, a_group: np.ndarray, b_ids: np.ndarray, b_group: np.ndarray, n: int) -> list[str]:
        """``a1,a2|b1`` of each group."""
        out: list[list[str]] = [[] for _ in range(n)]
        for g, i in zip(a_group.tolist(), map(str, a_ids.tolist()), strict=True):
            out[g].append(i)
        lefts = [",".join(x) for x in out]
        out = [[] for _ in range(n)]
        for g, i in zip(b_group.tolist(), map(str, b_ids.tolist()), strict=True):
            out[g].append(i)
        return [left + "|" + ",".join(x) for left, x in zip(lefts, out, strict=True)]

    def texts(self, texts: list[str | None]) -> Iterator[tuple[list[int], str, np.ndarray, np.ndarray]]:
        """(sums, digest of the groups, codes of the links, times) of each text; zeros and nothing where it has no tokens."""
        cut = [[units_of(p) for p in pieces_of(" " + t)] if t else [] for t in texts]
        if len(self.known) > UNITS or self.chars > UNIT_CHARS:
            self.forget()
        self.learn({u for pieces in cut for units in pieces for u in units})
        none = np.zeros(0, dtype=np.int64)
        for pieces in cut:
            sums, digest, found, sound = np.zeros(4, dtype=np.int64), hashlib.sha256(), [], bool(pieces)
            for k, units in enumerate(pieces):
                ids = np.fromiter(map(self.known.__getitem__, units), dtype=np.int64, count=len(units))
                if not self.sound[ids].all():
                    sound = False
                    break
                sums += self.sums[ids].sum(axis=0)
                digest.update((";" * (k > 0) + ";".join(map(self.text.__getitem__, ids.tolist()))).encode())
                each = self.at[ids + 1] - self.at[ids]
                where = np.arange(each.sum()) + np.repeat(self.at[ids] - np.cumsum(each) + each, each)
                found.append(np.unique(self.codes[where], return_counts=True))
            if not sound:
                yield [0, 0, 0, 0], "", none, none
            elif len(found) == 1:
                yield sums.tolist(), digest.hexdigest(), *found[0]
            else:
                codes, place = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
                times = np.bincount(place, weights=np.concatenate([n for _, n in found])).astype(np.int64)
                yield sums.tolist(), digest.hexdigest(), codes, times


def linked(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE) -> DataFrame:
    """(row, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links, times), written: each row's different links and how often each occurs.

    A link is numbered a * (pieces of B) + b; ``row`` is different for each row, so rows that share a doc_id stay apart.
    """
    small_batches(docs.sparkSession)
    schema = "row string, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links array<long>, times array<long>"

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, part, n = Aligner(byte_bpe, piece_bpe), TaskContext.get().partitionId(), 0
        for batch in batches:
            texts = batch.column(1).to_pylist()
            low = 0
            while low < len(texts):
                high, size = low, 0
                while high < len(texts) and (high == low or size + len(texts[high] or "") < TOGETHER):
                    size += len(texts[high] or "")
                    high += 1
                rows = list(aligner.texts(texts[low:high]))
                sums = np.array([r[0] for r in rows], dtype=np.int64)
                at = pa.array(np.concatenate([[0], np.cumsum([len(r[2]) for r in rows])]), pa.int32())
                arrays = [
                    pa.array([f"{part}-{n + k}" for k in range(len(rows))]), batch.column(0).slice(low, high - low).cast(pa.int64()), *[pa.array(sums[:, k]) for k in range(4)], pa.array([r[1] for r in rows]),
                    *[pa.ListArray.from_arrays(at, pa.array(np.concatenate([r[k] for r in rows]), pa.int64())) for k in (2, 3)],
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "times"])
                n += len(rows)
                low = high

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    cores = docs.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < cores:  # a few files that cannot be split would leave most cores idle
        rows = rows.repartition(cores)
    return written(rows.mapInArrow(of, schema), "links")


def counted(rows: DataFrame, pieces: int) -> DataFrame:
    """(link, count, best) of all links: in how many rows it occurs, and whether no other link of its A token has a higher count."""
    counts = rows.select(F.explode("links").alias("link")).groupBy("link").agg(F.count("*").alias("count"))
    counts = counts.withColumn("a", F.expr(f"link div {pieces}"))
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("link", "count", (F.col("count") == F.col("most")).alias("best"))


def align(docs: DataFrame, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE, lookup: int = LOOKUP) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of (doc_id, text).

    A is space and text by the byte-level vocabulary, B by the piece model, which adds the space; neither takes special tokens from texts.
    Texts that are null or empty, or that either tokenizer does not give back byte by byte, have zeros and ''. A link's count is
    the number of rows that hold it; rows that share a doc_id count each, and a null doc_id is kept. ``n_best`` are
    the occurrences of links whose count is the highest of their A token, ties included. Other columns are left out.
    """
    spark = docs.sparkSession
    import sentencepiece

    pieces = sentencepiece.SentencePieceProcessor(model_file=piece_bpe).vocab_size()
    rows = linked(docs, byte_bpe, piece_bpe)
    folder = scratch(spark, "link-counts")
    counted(rows, pieces).write.parquet(folder)
    counts = spark.read.schema("link long, count long, best boolean").parquet(folder)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    if counts.count() > lookup:
        each = rows.select("row", F.explode(F.arrays_zip("links", "times")).alias("l")).select("row", "l.links", "l.times")
        met = each.join(counts.hint("merge"), F.col("links") == F.col("link"))
        sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("count")).alias("count_sum"))
        whole = rows.drop("links", "times").join(sums, "row", "left")
        return whole.select(*names, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_best", "count_sum")], "groups_sha256")

    def table() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        store, path = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        found = [f.path for f in store.get_file_info(pafs.FileSelector(path)) if f.path.endswith(".parquet")]
        parts = [pq.read_table(store.open_input_file(p), columns=["link", "count", "best"]) for p in sorted(found)]
        link, count, best = (np.concatenate([np.zeros(0, kind), *[p.column(c).to_numpy().astype(kind) for p in parts]]) for c, kind in (("link", np.int64), ("count", np.int64), ("best", bool)))
        order = np.argsort(link)
        return link[order], count[order], best[order]

    def sums_of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        link, count, best = table()
        for links, times in batches:
            at = np.searchsorted(link, links.flatten().to_numpy())
            n = times.flatten().to_numpy()
            edge = np.concatenate([[0], np.cumsum(links.value_lengths().to_numpy())])
            upto = lambda x: np.concatenate([[0], np.cumsum(x)])
            out = [upto(x)[edge[1:]] - upto(x)[edge[:-1]] for x in (n * best[at], n * count[at])]
            yield pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in out], names=["n_best", "count_sum"])

    sums = F.arrow_udf(sums_of, "struct<n_best:long,count_sum:long>")
    return rows.select(*names, "groups_sha256", sums("links", "times").alias("s")).select(*names, "s.n_best", "s.count_sum", "groups_sha256")


ship(__name__)
