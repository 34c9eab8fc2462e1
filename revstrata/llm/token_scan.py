"""Token counts by a separator scan over flat, unindexed token files.

A token file is nothing but token identifiers of two or four bytes, one document after another,
each ended by an end-of-document identifier. ``write_token_files`` makes such files from texts;
``scan`` finds the documents again without any index: files are cut into blocks, each block is
searched for the separator as one vector, and a prefix scan over a file's blocks (a window over one
small row a block) gives every block its first document's ordinal and the place of the last
separator before it, so that documents over several blocks are stitched.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from revstrata.llm.common import scratch, ship, written

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that this public vocabulary splits text by.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SEPARATOR = 50256
BLOCK_TOKENS = 1 << 20


def encoder(vocabulary: str):
    """The tokenizer of a rank file."""
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def write_token_files(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, separator: int = SEPARATOR, width: int = 2) -> DataFrame:
    """One token file a partition in ``folder`` (shared); returns (file, ordinal, doc_id), written beside them.

    A task that runs again writes another file; only files that the returned table names count.
    A null or empty text is a document of no tokens. Repeated doc_ids are documents of their own.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        store.create_dir(path, recursive=True)
        name, ordinal, tokens = f"{uuid.uuid4().hex}.bin", 0, encoder(vocabulary)
        end = np.array([separator], dtype=f"<u{width}").tobytes()
        with store.open_output_stream(f"{path}/{name}") as out:
            for batch in batches:
                for text in batch.column(1).to_pylist():
                    if text:
                        out.write(np.array(tokens.encode_ordinary(text), dtype=f"<u{width}").tobytes())
                    out.write(end)
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n), pa.array(np.arange(ordinal, ordinal + n)), batch.column(0).cast(pa.int64())], names=["file", "ordinal", "doc_id"]
                )
                ordinal += n

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return written(rows.mapInArrow(of, "file string, ordinal long, doc_id long"), "token-index")


def blocks_of(files: DataFrame, folder: str, block_tokens: int = BLOCK_TOKENS, width: int = 2) -> DataFrame:
    """(file, block, size in bytes) for the distinct names in the column ``file``; sizes come from the store."""

    def sizes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        store, path = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        for names in batches:
            yield pd.Series([store.get_file_info(f"{path}/{x}").size for x in names], dtype="int64")

    step = block_tokens * width
    return (
        files.select("file")
        .distinct()
        .withColumn("size", F.pandas_udf(sizes, "long")("file"))
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.floor((F.col("size") - 1) / step), F.lit(0)).cast("long"))))
    )


def scan(files: DataFrame, folder: str, separator: int = SEPARATOR, width: int = 2, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Every document of the named token files: (file, ordinal, start, n_tokens), start in tokens from the file's start.

    Tokens after a file's last separator are a last document. A file that ends inside a token is an
    error. An empty file has no documents. A block's separators are at most ``block_tokens`` numbers.
    """
    step = block_tokens * width

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = pafs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        for batch in batches:
            for name, size, block in zip(batch["file"], batch["size"], batch["block"], strict=True):
                if size % width:
                    raise ValueError(f"{name} ends inside a token")
                with store.open_input_file(f"{path}/{name}") as f:
                    f.seek(block * step)
                    tokens = np.frombuffer(f.read(step), dtype=f"<u{width}")
                ends = np.flatnonzero(tokens == separator) + block * block_tokens
                if len(tokens) and (block + 1) * step >= size and tokens[-1] != separator:
                    ends = np.append(ends, size // width)
                yield pd.DataFrame({"file": [name], "block": [block], "ends": [ends.astype("int64")]})

    found = blocks_of(files, folder, block_tokens, width).repartition("file", "block").mapInPandas(of, "file string, block long, ends array<long>")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.select(
        "file",
        "ends",
        F.coalesce(F.sum(F.size("ends").cast("long")).over(before), F.lit(0).cast("long")).alias("first"),
        F.coalesce(F.max(F.element_at(F.when(F.size("ends") > 0, F.col("ends")), -1)).over(before), F.lit(-1).cast("long")).alias("held"),
    )
    begun = F.concat(F.array(F.col("held")), F.expr("slice(ends, 1, size(ends) - 1)"))
    documents = F.arrays_zip(begun.alias("last"), F.col("ends").alias("end"))
    return stitched.where(F.size("ends") > 0).select("file", "first", F.posexplode(documents).alias("k", "d")).select(
        "file",
        (F.col("first") + F.col("k")).alias("ordinal"),
        (F.col("d.last") + 1).alias("start"),
        (F.col("d.end") - F.col("d.last") - 1).alias("n_tokens"),
    )


def count_tokens(docs: DataFrame, vocabulary: str = VOCABULARY, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(doc_id, n_tokens) of every document: texts to token files in the shared folder, then the scan, then ids by (file, ordinal)."""
    folder = scratch(docs.sparkSession, "tokens")
    index = write_token_files(docs, folder, vocabulary)
    # no broadcast: both sides grow with the documents
    return index.join(scan(index, folder, block_tokens=block_tokens).hint("merge"), ["file", "ordinal"]).select("doc_id", "n_tokens")


ship(__name__)
