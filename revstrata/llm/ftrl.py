"""Follow-the-regularised-leader with elastic-net penalties for sparse linear models, trained on Spark.

Examples are dealt to shards; in each round every shard runs FTRL-proximal over its examples from the
present state, and the shards' states are averaged (iterative parameter mixing). A state is two arrays
of classes x features, whatever the number of rows, so the driver and each task hold a bounded model.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame

from revstrata.llm.common import ship


@dataclass(frozen=True)
class Penalty:
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.5
    l2: float = 1.0
    counterfactual: float = 0.0


def weights(z: np.ndarray, n: np.ndarray, p: Penalty) -> np.ndarray:
    """The model's weights: zero where |z| is at most the L1 penalty."""
    return np.where(np.abs(z) <= p.l1, 0.0, -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2))


def probabilities(logits: np.ndarray) -> np.ndarray:
    """Softmax over the last axis; one logit is taken for a sigmoid."""
    if logits.shape[-1] == 1:
        return 1.0 / (1.0 + np.exp(-np.clip(logits, -40, 40)))
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def run(examples: list, z: np.ndarray, n: np.ndarray, p: Penalty, epochs: int) -> None:
    """FTRL-proximal over (features, values, label, swapped features or None), in order, changing z and n.

    For an example with swapped identity terms, the penalty p.counterfactual * (score - swapped score)**2 is
    added to the loss. The last feature is the bias.
    """
    classes = len(z)
    bias = z.shape[1] - 1
    plain = Penalty(p.alpha, p.beta, 0.0, 0.0)

    def step(at: np.ndarray, g: np.ndarray, w: np.ndarray) -> None:
        old = n[:, at]
        new = old + g * g
        z[:, at] += g - (np.sqrt(new) - np.sqrt(old)) / p.alpha * w
        n[:, at] = new

    for _ in range(epochs):
        for at, x, y, swapped in examples:
            w = weights(z[:, at], n[:, at], p)
            b = weights(z[:, [bias]], n[:, [bias]], plain)
            q = probabilities(w @ x + b[:, 0])
            error = q - (y if classes == 1 else np.arange(classes) == y)
            step(at, error[:, None] * x, w)
            step(np.array([bias]), error[:, None], b)
            if swapped is not None and p.counterfactual:
                both = np.union1d(at, swapped)
                here, there = np.isin(both, at).astype(float), np.isin(both, swapped).astype(float)
                w = weights(z[:, both], n[:, both], p)
                q1, q2 = probabilities(w @ here + b[:, 0]), probabilities(w @ there + b[:, 0])
                pull = 2 * p.counterfactual * (q1 - q2)
                step(both, (pull * q1 * (1 - q1))[:, None] * here - (pull * q2 * (1 - q2))[:, None] * there, w)


def _shard(state: Broadcast, featurise: Callable[[pd.DataFrame], list], p: Penalty, epochs: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """One shard's part of a round, from the broadcast state."""

    def of(group: pd.DataFrame) -> pd.DataFrame:
        z, n = (x.astype(np.float64) for x in state.value)
        run(featurise(group.sort_values("rank")), z, n, p, epochs)
        return pd.DataFrame({"rows": [len(group)], "z": [z.astype(np.float32).tobytes()], "n": [n.astype(np.float32).tobytes()]})

    return of


def fit(train: DataFrame, featurise: Callable[[pd.DataFrame], list], classes: int, features: int, p: Penalty, rounds: int, epochs: int, shards: int) -> np.ndarray:
    """The weights (classes x (features + 1), the last column the bias) learned from ``train``.

    ``train`` has the columns shard (0 to shards - 1) and rank, and what ``featurise`` makes examples of. It must
    be a bounded sample or be dealt to as many shards as make each group bounded.
    """
    spark = train.sparkSession
    z, n = np.zeros((classes, features + 1)), np.zeros((classes, features + 1))
    for _ in range(rounds):
        state = spark.sparkContext.broadcast((z.astype(np.float32), n.astype(np.float32)))

        parts = train.groupBy("shard").applyInPandas(_shard(state, featurise, p, epochs), "rows long, z binary, n binary").collect()
        if not parts:
            break
        total = sum(r.rows for r in parts)
        z, n = (sum(np.frombuffer(r[k], dtype=np.float32).reshape(classes, features + 1).astype(np.float64) * (r.rows / total) for r in parts) for k in ("z", "n"))
        state.unpersist()
    w = weights(z, n, p)
    w[:, -1] = weights(z[:, -1], n[:, -1], Penalty(p.alpha, p.beta, 0.0, 0.0))
    return w


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature (0.05 to 20) that makes calibration rows likeliest, by golden section on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        q = probabilities(logits / np.exp(t))
        picked = np.where(labels == 1, q[:, 0], 1 - q[:, 0]) if logits.shape[1] == 1 else q[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(picked, 1e-12)).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


ship(__name__)
