"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

N-grams of 1 to 3 letters are hashed to 2**BITS features. Document frequencies are counted over all
learning rows; the weights are learned by FTRL with an elastic net from a bounded sample of them
(``per_class`` rows of each language), and a temperature is fitted on a part of that sample that
the weights have not seen. Prediction works on whole texts, row by row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revstrata.llm import ftrl
from revstrata.llm.common import fold_of, ship, small_batches
from revstrata.llm.textfeat import Letters, char_ngrams

BITS, ORDERS = 16, (1, 2, 3)
PENALTY = ftrl.Penalty(alpha=2.0, beta=1.0, l1=0.05, l2=0.1)
UNDETERMINED = "und"


@dataclass(frozen=True)
class Model:
    langs: list[str]
    weights: np.ndarray
    idf: np.ndarray
    temperature: float


def vector(letters: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features and TF-IDF values of unit length of one text."""
    tf = np.bincount(char_ngrams(letters, ORDERS, BITS), minlength=1 << BITS)
    at = np.flatnonzero(tf)
    x = (1.0 + np.log(tf[at])) * idf[at]
    norm = np.sqrt((x * x).sum())
    return at, x / norm if norm else x


def document_frequencies(rows: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of ``rows`` each feature occurs, and the number of rows; 2**BITS numbers reach the driver."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters, df, n = Letters(), np.zeros((1 << BITS) + 1, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                df[np.unique(char_ngrams(letters(text or ""), ORDERS, BITS))] += 1
                n += 1
        df[-1] = n
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["feature", "n"])

    sums = rows.select("text").mapInArrow(of, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toPandas()
    df = np.zeros((1 << BITS) + 1)
    df[sums["feature"].to_numpy(dtype=np.int64)] = sums["n"].to_numpy(dtype=np.float64)
    return df[:-1], int(df[-1])


def fit(docs: DataFrame, per_class: int = 1500, rounds: int = 3, epochs: int = 2, shard_rows: int = 2000) -> Model:
    """Learn from the rows of ``docs`` (doc_id, text, lang) that are not held out and whose lang is not null.

    ``per_class`` bounds the rows of each language that the weights are fitted on; they are chosen by a hash
    of doc_id. With no such rows the model has no languages and predicts ``und``.
    """
    known = docs.select("doc_id", "text", "lang").where((fold_of(F.col("doc_id")) != 2) & F.col("lang").isNotNull())
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    langs = sorted(counts)
    if not langs:
        return Model([], np.zeros((0, (1 << BITS) + 1)), np.zeros(1 << BITS), 1.0)
    df, n = document_frequencies(known)
    idf = np.log((1.0 + n) / (1.0 + df)) + 0.1
    places = 1_000_000
    rank = F.pmod(F.xxhash64("doc_id"), F.lit(places))
    share = F.coalesce(*[F.when(F.col("lang") == x, F.lit(min(places, int(places * per_class / counts[x]) + 1))) for x in langs])
    label = F.coalesce(*[F.when(F.col("lang") == x, F.lit(k)) for k, x in enumerate(langs)])
    shards = max(1, -(-sum(min(per_class, c) for c in counts.values()) // shard_rows))
    sample = known.where(rank < share).select(
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(shards)).alias("shard"),
        F.xxhash64("doc_id", F.lit(2)).alias("rank"),
        F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(5)).alias("part"),
        label.alias("label"),
        "text",
    ).persist()

    def examples(group: pd.DataFrame) -> list:
        letters = Letters()
        return [(*vector(letters(t or ""), idf), y, None) for t, y in zip(group["text"], group["label"], strict=True)]

    w = ftrl.fit(sample.where(F.col("part") != 0), examples, len(langs), 1 << BITS, PENALTY, rounds, epochs, shards)

    def logits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame([{"label": y, "logits": (w[:, at] @ x + w[:, -1]).tolist()} for at, x, y, _ in examples(batch)], columns=["label", "logits"])

    held = sample.where(F.col("part") == 0).mapInPandas(logits, "label long, logits array<double>").toPandas()
    sample.unpersist()
    t = ftrl.temperature(np.array(held["logits"].tolist()).reshape(len(held), -1), held["label"].to_numpy(dtype=int)) if len(held) >= 20 and len(langs) > 1 else 1.0
    return Model(langs, w, idf, t)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score (columns of these names are replaced), from the column ``text`` alone.

    A null text and one without a letter have ``und`` and 0.0, as has every text under a model without
    languages. Equal texts have equal results; the model is the same for any number of rows.
    """
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast((model.langs, model.weights, model.idf, model.temperature))

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m, letters = Model(*held.value), Letters()
        for batch in batches:
            out = []
            for text in batch:
                x = letters(text) if text else None
                if x is None or not m.langs or len(x) < 2 or not (x != 32).any():
                    out.append((UNDETERMINED, 0.0))
                    continue
                at, v = vector(x, m.idf)
                q = ftrl.probabilities((m.weights[:, at] @ v + m.weights[:, -1]) / m.temperature) if len(m.langs) > 1 else np.ones(1)
                k = int(q.argmax())
                out.append((m.langs[k], float(q[k])))
            yield pd.DataFrame(out, columns=["lang_pred", "score"])

    kept = docs.withColumn("_language", F.pandas_udf(of, "lang_pred string, score double")("text"))
    return kept.withColumn("lang_pred", F.col("_language.lang_pred")).withColumn("score", F.col("_language.score")).drop("_language")


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, with its own columns, whose language is determined with a score of at least ``least``."""
    names = {c: f"_own_{k}" for k, c in enumerate(docs.columns) if c.lower() in ("lang_pred", "score")}
    kept = predict(docs.withColumnsRenamed(names), model).where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return kept.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def identify(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; a null doc_id is not held out and not learned from."""
    rows = docs.select("doc_id", "text", "lang")
    return predict(rows.select("doc_id", "text"), fit(rows, **how)).select(
        "doc_id", F.coalesce(fold_of(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


ship(__name__)
