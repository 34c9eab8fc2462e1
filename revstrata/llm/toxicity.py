"""Toxicity: a sparse logistic classifier, regularised by counterfactual swaps of identity terms.

Features are a text's distinct words and the beginnings of its words. Weights are learned by FTRL with an
elastic net from a bounded sample of labelled rows. For a labelled text that names a group, a copy is made
in which each sentence's identity terms are swapped for others; the squared change of the score between the
two is added to the loss, so that the mention of a group alone does not raise a score.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revstrata.llm import ftrl
from revstrata.llm.common import fold_of, ship, small_batches
from revstrata.llm.textfeat import Letters, word_features

BITS, PREFIXES = 18, (4, 5, 6)
PENALTY = ftrl.Penalty(alpha=1.0, beta=1.0, l1=2.0, l2=0.1, counterfactual=4.0)
THRESHOLD = 0.3
#: Identity terms by kind: a term is swapped for others of its kind.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "ladies", "gentlemen", "mothers", "fathers"),
    ("woman", "man", "girl", "boy", "lady", "gentleman", "mother", "father"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "catholic", "protestant", "atheist", "sikh"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "catholics", "protestants", "atheists", "sikhs"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer", "homosexual", "heterosexual"),
    ("black", "white", "asian", "african", "european", "american", "mexican", "latino", "arab", "chinese", "indian", "indigenous"),
    ("immigrants", "refugees", "foreigners", "citizens", "natives", "migrants"),
    ("old", "young", "elderly", "deaf", "blind", "disabled"),
    ("frauen", "männer", "juden", "muslime", "christen", "ausländer", "flüchtlinge"),
    ("femmes", "hommes", "juifs", "musulmans", "chrétiens", "étrangers", "réfugiés"),
    ("mujeres", "hombres", "judíos", "musulmanes", "cristianos", "extranjeros", "refugiados"),
)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    temperature: float
    shift: float


def swapped(text: str, terms: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> str | None:
    """The text with the identity terms of every sentence swapped for the next of their kind; None if it has none."""
    following = {t: kind[(k + 1) % len(kind)] for kind in terms for k, t in enumerate(kind)}
    changed = False

    def other(m: re.Match) -> str:
        nonlocal changed
        new = following.get(m[0].lower())
        changed |= new is not None
        return m[0] if new is None else new

    sentences = [re.sub(r"\w+", other, s) for s in re.split(r"(?<=[.!?\n])", text)]
    return "".join(sentences) if changed else None


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = 12_000, rounds: int = 3, epochs: int = 4, shard_rows: int = 3000) -> Model:
    """Learn from the labelled rows that are not held out; at most about ``fit_rows`` of them, chosen by a hash of doc_id.

    A third of the sample at most is toxic rows (all of them, if there are fewer); the scores are shifted back to the share
    of toxic rows among all labelled ones. Null labels, texts and doc_ids are not learned from. A doc_id with several labels is
    toxic if one of them says so. Without labels of both kinds every score is the share of toxic labels (0 if none).
    """
    marks = labels.where(F.col("toxic").isNotNull() & (fold_of(F.col("doc_id")) != 2)).groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("label"))
    counts = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}
    positive, negative = counts.get(1, 0), counts.get(0, 0)
    if not positive or not negative:
        return Model(np.zeros((1, (1 << BITS) + 1)), 1.0, 40.0 if positive else -40.0)
    take = min(positive, fit_rows // 3)
    shares = (min(1.0, (fit_rows - take) / negative), take / positive)
    places = 1_000_000
    rank = F.pmod(F.xxhash64("doc_id"), F.lit(places))
    chosen = marks.where(rank < F.when(F.col("label") == 1, int(places * shares[1])).otherwise(int(places * shares[0])))
    shards = max(1, -(-int(take + shares[0] * negative) // shard_rows))
    sample = docs.select("doc_id", "text").where(F.col("text").isNotNull()).join(F.broadcast(chosen), "doc_id").select(  # about fit_rows numbers
        F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(shards)).alias("shard"),
        F.xxhash64("doc_id", F.lit(2)).alias("rank"),
        F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(5)).alias("part"),
        "label",
        "text",
    ).persist()

    def examples(group: pd.DataFrame) -> list:
        letters, out = Letters(), []
        for text, y in zip(group["text"], group["label"], strict=True):
            at = word_features(letters(text), PREFIXES, BITS)
            other = swapped(text)
            out.append((at, np.ones(len(at)), int(y), None if other is None else word_features(letters(other), PREFIXES, BITS)))
        return out

    def logits(w: np.ndarray):
        def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                yield pd.DataFrame([{"label": y, "logit": float(w[0, at].sum() + w[0, -1])} for at, _, y, _ in examples(batch)], columns=["label", "logit"])

        return of

    part = ftrl.fit(sample.where(F.col("part") != 0), examples, 1, 1 << BITS, PENALTY, rounds, epochs, shards)
    held = sample.where(F.col("part") == 0).mapInPandas(logits(part), "label long, logit double").toPandas()
    w = ftrl.fit(sample, examples, 1, 1 << BITS, PENALTY, rounds, epochs, shards)
    sample.unpersist()
    t = ftrl.temperature(held[["logit"]].to_numpy(), held["label"].to_numpy(dtype=int)) if len(held) >= 50 and held["label"].nunique() == 2 else 1.0
    return Model(w, float(np.clip(t, 0.5, 2.0)), float(np.log(shares[0] / shares[1])))


def predict(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score and predicted (columns of these names are replaced), from the column ``text`` alone; a null text is scored as an empty one."""
    small_batches(docs.sparkSession)
    held = docs.sparkSession.sparkContext.broadcast((model.weights, model.temperature, model.shift))

    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m, letters = Model(*held.value), Letters()
        w, bias = m.weights[0, :-1], m.weights[0, -1]
        for batch in batches:
            logit = np.array([w[word_features(letters(t or ""), PREFIXES, BITS)].sum() for t in batch], dtype=np.float64) + bias
            yield pd.Series(ftrl.probabilities((logit / m.temperature + m.shift)[:, None])[:, 0])

    scored = docs.withColumn("score", F.pandas_udf(of, "double")("text"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, with its own columns, that score below the threshold."""
    names = {c: f"_own_{k}" for k, c in enumerate(docs.columns) if c.lower() in ("predicted", "score")}
    kept = predict(docs.withColumnsRenamed(names), model, threshold).where(F.col("predicted") == 0)
    return kept.select(*[F.col(names.get(c, c)).alias(c) for c in docs.columns])


def score(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; a null doc_id is not held out."""
    rows = docs.select("doc_id", "text")
    return predict(rows, fit(rows, labels, **how)).select(
        "doc_id", F.coalesce(fold_of(F.col("doc_id")) == 2, F.lit(False)).alias("held_out"), "score", "predicted"
    )


ship(__name__)
