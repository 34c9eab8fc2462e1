"""A corpus pipeline over the table ``documents``: each stage's output is written and read again by the next.

Language ID drops documents whose language cannot be told; the toxicity stage drops what scores as toxic; the n-gram
Jaccard join leaves one document of each group of near copies; mixing draws documents to target weights; the last
stage encodes what is left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from revstrata.llm import jaccard, langid, mixing, sentencepiece_lattice, toxicity
from revstrata.llm.common import release, written
from revstrata.tables import load


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; null and empty texts and texts without letters go."""
    release(spark)
    return langid.accepted(docs, langid.fit(docs))


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not score as toxic; empty texts are kept."""
    release(spark)
    return toxicity.clean(docs, toxicity.fit(docs, load(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of documents whose sets of 5-word n-grams have a likeness of 0.8 or more."""
    release(spark)
    return jaccard.deduplicated(docs, words=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn once each, with their calibrated weight cut at one as probability."""
    release(spark)
    return mixing.sample(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, lang, n_pieces, ids, lossless) of every document that is left."""
    release(spark)
    return sentencepiece_lattice.encode(docs).select("doc_id", "source", "lang", "n_pieces", "ids", "lossless")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("toxicity", toxicity_filter),
    ("ngram_jaccard_join", near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", encode_pieces),
]

#: The learned stages have no SQL form. Tests hold the operators to brute force one by one, and run() to its defined results on odd rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents of ``sf_dir``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
