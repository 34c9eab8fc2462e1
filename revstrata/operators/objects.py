"""Stored objects: typed reads, commits, trees, files with their headers, and patches of changeset texts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revstrata.functions.identity import node_hash
from revstrata.functions.text import percent_decode
from revstrata.shipping import ship

#: The identifier of a file without content and parents, and what a file's header stands between.
EMPTY_FILE = "b80de5d138758541c5f05265ad144ab9fa86d1db"
HEADER_MARK = "\x01\n"
HUNKS = "array<struct<start:int,end:int,data:string>>"


def read_objects(wanted: DataFrame, objects: DataFrame, kind: str | None = None) -> DataFrame:
    """``wanted`` (oid, ...) with kind and content of ``objects`` (oid, kind, content); NULL where there is none, or none of ``kind``."""
    held = objects if kind is None else objects.where(F.col("kind") == kind)
    return wanted.join(held.select("oid", "kind", "content"), "oid", "left")


def parse_commit(raw: Column) -> Column:
    """STRUCT(tree, parents, author, committer, body) of a commit's text.

    NULL without an empty line behind the header, with a header line without a value, or without tree, author or committer.
    Of repeated lines but parents the last counts; unknown ones are passed over.
    """
    at = F.instr(raw, "\n\n")
    lines = F.filter(F.split(F.substring(raw, F.lit(1), at - 1), "\n"), lambda x: x != "")
    of = lambda key: F.transform(F.filter(lines, lambda x: F.substring_index(x, " ", 1) == key), lambda x: F.substring(x, F.instr(x, " ") + 1, F.length(x)))
    last = lambda key: F.try_element_at(of(key), F.lit(-1))
    sound = (at > 0) & F.forall(lines, lambda x: F.contains(x, F.lit(" "))) & last("tree").isNotNull() & last("author").isNotNull() & last("committer").isNotNull()
    body = F.substring(raw, at + 2, F.length(raw))
    return F.when(sound, F.struct(last("tree").alias("tree"), of("parent").alias("parents"), last("author").alias("author"), last("committer").alias("committer"), body.alias("body")))


def tree_entries(trees: DataFrame, tree: str = "tree", content: str = "content") -> DataFrame:
    """(tree, place, mode, path, oid) of raw trees: octal mode, space, path, NUL, 20 bytes, again and again. A malformed tree is an error."""

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, raw in zip(batch[tree], batch[content], strict=True):
                raw, at, place = bytes(raw if raw is not None else b""), 0, 0
                while at < len(raw):
                    gap, end = raw.find(b" ", at), raw.find(b"\0", at)
                    mode = raw[at:gap]
                    if gap < 0 or end < gap + 2 or end + 21 > len(raw) or not mode or mode.strip(b"01234567"):
                        raise ValueError(f"tree {key} is malformed at {at}")
                    out.append((key, place, mode.decode(), raw[gap + 1 : end].decode("utf-8", "replace"), raw[end + 1 : end + 21].hex()))
                    at, place = end + 21, place + 1
            yield pd.DataFrame(out, columns=[tree, "place", "mode", "path", "oid"])

    kind = dict(trees.dtypes)[tree]
    return trees.select(tree, content).mapInPandas(of, f"{tree} {kind}, place int, mode string, path string, oid string")


def copy_header(source: Column, source_node: Column) -> Column:
    """The header of a file that was copied from ``source`` as it was at ``source_node``."""
    return F.concat(F.lit("copy: "), source, F.lit("\ncopyrev: "), source_node, F.lit("\n"))


def file_text(header: Column, content: Column) -> Column:
    """A file's whole binary content: its header, if it has one, between marks, then the content."""
    mark = F.lit(HEADER_MARK).cast("binary")
    return F.when(header.isNull(), content.cast("binary")).otherwise(F.concat(mark, header.cast("binary"), mark, content.cast("binary")))


def copied_file_id(content: Column, source: Column, source_node: Column) -> Column:
    """The identifier of a copied file: it has no parents, its header says where it is from."""
    none = F.lit(None).cast("string")
    return node_hash(none, none, file_text(copy_header(source, source_node), content))


def full_files(wanted: DataFrame, files: DataFrame, headers: DataFrame) -> DataFrame:
    """``wanted`` (node, ...) with the whole ``content`` of ``files`` (node, content) and ``headers`` (node, header); EMPTY_FILE is empty."""
    met = wanted.join(files.select("node", F.col("content").cast("binary").alias("_c")), "node", "left").join(headers.select("node", "header"), "node", "left")
    return met.withColumn("content", F.when(F.col("node") == EMPTY_FILE, F.lit("").cast("binary")).otherwise(file_text(F.col("header"), F.col("_c")))).drop("_c", "header")


def patch_text(hunks: Column) -> Column:
    """Hunks (array of start, end, data) as ``start,end,data`` joined by NUL; all bytes of data but letters and digits are escaped."""

    def quoted(text: Column) -> Column:
        out = F.replace(F.url_encode(text), F.lit("+"), F.lit("%20"))
        for sign in "*-._":
            out = F.replace(out, F.lit(sign), F.lit(f"%{ord(sign):02X}"))
        return out

    return F.array_join(F.transform(hunks, lambda h: F.concat_ws(",", h["start"].cast("string"), h["end"].cast("string"), quoted(h["data"]))), "\x00")


def parse_patch(patch: Column) -> Column:
    """The hunks of :func:`patch_text`; NULL if any part has another number of fields or no numbers."""
    parts = F.split(patch, "\x00")
    sound = F.forall(parts, lambda p: p.rlike("^[0-9]{1,9},[0-9]{1,9},[^,]*$"))
    field = lambda p, k: F.element_at(F.split(p, ","), k)
    hunk = lambda p: F.struct(field(p, 1).cast("int").alias("start"), field(p, 2).cast("int").alias("end"), percent_decode(field(p, 3)).alias("data"))
    return F.when(sound, F.transform(parts, hunk))


def apply_patch(text: Column, hunks: Column) -> Column:
    """A text's bytes with hunks applied, as binary; NULL where hunks overlap, go back or pass the end."""
    raw = text.cast("binary")
    size = F.octet_length(raw)
    begin = F.struct(F.lit(0).alias("at"), F.lit("").cast("binary").alias("out"), F.lit(True).alias("ok"))

    def step(s: Column, h: Column) -> Column:
        kept = F.substring(raw, s["at"] + 1, F.greatest(h["start"] - s["at"], F.lit(0)))
        return F.struct(h["end"].alias("at"), F.concat(s["out"], kept, h["data"].cast("binary")).alias("out"), (s["ok"] & (h["start"] >= s["at"]) & (h["end"] >= h["start"]) & (h["end"] <= size)).alias("ok"))

    return F.aggregate(hunks, begin, step, lambda s: F.when(s["ok"], F.concat(s["out"], F.substring(raw, s["at"] + 1, size))))


def line_aligned(text: Column, hunks: Column) -> Column:
    """Whether all hunks start and end where lines of ``text`` do, as deltas of manifests must."""
    raw = F.hex(text.cast("binary"))
    edge = lambda at: (at == 0) | (F.substring(raw, 2 * at - 1, F.lit(2)) == "0A")
    return F.forall(hunks, lambda h: edge(h["start"]) & edge(h["end"]))


def without_fillers(raw: Column, node: Column, p1: Column, p2: Column) -> Column:
    """A changeset's text less NULs at its end: the fewest with which it has the hash ``node``, else all; as it is for a NULL node."""
    extra = F.length(raw) - F.length(F.rtrim(raw, F.lit("\x00")))
    cut = lambda k: F.substring(raw, F.lit(1), F.length(raw) - k)
    fits = F.filter(F.sequence(F.lit(0), extra), lambda k: (k == extra) | (node_hash(p1, p2, cut(k)) == node))
    return F.when(node.isNull(), raw).otherwise(cut(F.element_at(fits, 1)))


ship(__name__)
