"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

The tokens of every cell (source, language, topic) are raked in turn to the target shares of the three
margins until a sweep changes no margin by more than a tolerance. A document's probability is its cell's
calibrated weight over the cell's tokens, scaled so that none exceeds one; a hash of doc_id draws. For a sample
the weights are cut at one instead of scaled, so that no rare cell thins all others: a cell over its target is
thinned to it, a cell under its target is kept whole, and what such cells lack is logged.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from revstrata.llm.common import release, written

MARGINS = ("source", "lang", "topic")
BROADCAST_CELLS = 50_000
SALTS = 64
SWEEPS_A_JOB = 3
LOG = logging.getLogger(__name__)


def topic_of(text: Column) -> Column:
    """A document's topic by what its text looks like."""
    return (
        F.when(text.isNull() | (text == ""), "empty")
        .when(F.contains(text, F.lit(" | ")), "tables")
        .when(F.contains(text, F.lit("***")), "symbols")
        .when(F.contains(text, F.lit("!! ")), "shouting")
        .otherwise("prose")
    )


def tempered(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Target shares of a margin: its tokens' shares to ``power``, made to sum to one; powers below 1 lift small categories."""
    mass = cells.groupBy(margin).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("share")).where(F.col("share") > 0)
    total = mass.agg(F.sum("share")).first()[0] or 1.0
    return mass.select(margin, (F.col("share") / F.lit(total)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = 30, tolerance: float = 1e-6) -> DataFrame:
    """``cells`` (margins, tokens) with a column ``weight`` whose margins are the targets' shares of all tokens.

    A target table has its margin's column and ``share``. Categories without a target get the weight 0. An empty
    table stays empty. A few sweeps are one plan of windows over the cells, one after another, and
    end in a small written table, of which the driver sees one number. Where ``sweeps`` end before no margin moves by more than ``tolerance`` (relative), that is logged.
    """
    total = F.lit(cells.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0] or 0)
    start = cells.withColumn("weight", F.col("tokens").cast("double"))
    for m, target in targets.items():
        goal = target.select(F.col(m).alias("_to"), F.col("share").alias(f"_share_{m}"))
        start = start.join(goal, F.col(m).eqNullSafe(F.col("_to")), "left").drop("_to")
    now, worst = written(start, "cells"), None
    for _ in range(0, sweeps, SWEEPS_A_JOB):
        for _ in range(SWEEPS_A_JOB):
            now = now.withColumn("_off", F.lit(0.0))
            for m in targets:
                mass = F.sum("weight").over(Window.partitionBy(m))
                now = now.withColumn("_ratio", F.when(mass > 0, F.coalesce(f"_share_{m}", F.lit(0.0)) * total / mass).otherwise(0.0))
                now = now.withColumn("_off", F.greatest("_off", F.when(F.col("weight") > 0, F.abs(F.col("_ratio") - 1)).otherwise(0.0))).withColumn("weight", F.col("weight") * F.col("_ratio"))
        now = written(now.drop("_ratio"), "cells")
        release(cells.sparkSession)
        worst = now.agg(F.max("_off")).first()[0]
        now = now.drop("_off")
        if worst is None or worst <= tolerance:
            break
    else:
        LOG.warning("mixing: not converged after %d sweeps; a margin still moved by a factor of 1 +- %g", sweeps, worst or 0.0)
    return now.drop(*[f"_share_{m}" for m in targets])


def capped_rate(raked: DataFrame, budget: float = 1.0) -> float:
    """The rate, at most 1, at which the sum of min(1, _weight * rate) * tokens is ``budget`` of all tokens; cells that fall short are logged.

    At 1 every cell's expected tokens are its target, or all it has. The rate rises to the solution by steps over the
    cells that are kept whole so far; the driver sees three numbers a step.
    """
    tokens, weight = F.col("tokens"), F.col("_weight")
    rate = 0.0
    for _ in range(100):  # a step keeps one more cell whole, or is the last
        whole = weight * F.lit(rate) >= 1
        total, kept, slope = raked.agg(F.sum(tokens), F.sum(F.when(whole, tokens).otherwise(0)), F.sum(F.when(whole, 0.0).otherwise(weight * tokens))).first()
        now = min(1.0, (budget * total - kept) / slope) if slope else rate or 1.0
        if now <= rate * (1 + 1e-12):
            break
        rate = now
    wanted, got = weight * F.lit(rate) * tokens, F.least(F.lit(1.0), weight * F.lit(rate)) * tokens
    cells, short, lacking, expected = raked.agg(F.count("*"), F.count_if(weight * F.lit(rate) > 1), F.sum(wanted - got), F.sum(got)).first()
    LOG.warning("mixing: rate %.4f keeps %.0f of %s tokens; %d of %d cells fall short of their targets, by %.0f tokens", rate, expected or 0, total, short, cells, lacking or 0)
    return rate


def short_cells(drawn: DataFrame) -> DataFrame:
    """(source, lang, topic, tokens, wanted) of the cells in calibrate()'s output whose targets at the rate 1 exceed what they have."""
    cells = drawn.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens"), F.sum(F.col("weight") * F.col("n_tokens")).alias("wanted"))
    return cells.where(F.col("wanted") > F.col("tokens") * (1 + 1e-9))


def calibrate(
    docs: DataFrame, topic: Column | None = None, power: float = 0.7, targets: dict[str, DataFrame] | None = None, budget: float = 1.0, seed: int = 17, capped: bool = False
) -> DataFrame:
    """``docs`` with the columns topic, n_tokens, weight, probability and sampled; columns of these names are replaced.

    Tokens are words between white space. ``targets`` replaces tempered targets for the margins it names.
    ``budget`` bounds the expected share of tokens that is drawn. With ``capped`` probabilities are the weights cut at
    one, at the rate of capped_rate(); else all are scaled by the largest weight. Null sources and languages are a category of
    their own; a null or empty text has no tokens, and weighs what its cell weighs (0, if the cell has no
    tokens); equal doc_ids, and all null ones, share a draw.
    """
    spark = docs.sparkSession
    marked = docs.withColumn("topic", topic_of(F.col("text")) if topic is None else topic).withColumn("n_tokens", F.coalesce(F.regexp_count("text", F.lit(r"\S+")), F.lit(0)).cast("long"))
    cells = written(marked.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("tokens")), "cells")
    goals = {m: (targets or {}).get(m, None) for m in MARGINS}
    goals = {m: tempered(cells, m, power) if t is None else t for m, t in goals.items()}
    raked = rake(cells, goals).withColumn("_weight", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0))
    most, n = raked.agg(F.max("_weight"), F.count("*")).first()
    rate = F.lit((capped_rate(raked, budget) if capped else min(budget, 1.0 / most)) if most else 0.0)
    ratios = raked.select(*[F.col(m).alias(f"_{m}") for m in MARGINS], "_weight")
    same = [F.col(m).eqNullSafe(F.col(f"_{m}")) for m in MARGINS]
    if n <= BROADCAST_CELLS:  # at most a few MB
        joined = marked.join(F.broadcast(ratios), same, "left")
    else:  # each cell once a salt, as one cell may hold a third of all documents
        salted = ratios.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = marked.withColumn("_at", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(salted, [*same, F.col("_at") == F.col("_salt")], "left").drop("_at", "_salt")
    draw = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) / F.lit(float(1 << 53))
    return (
        joined.withColumn("weight", F.coalesce("_weight", F.lit(0.0)))
        .withColumn("probability", F.least(F.lit(1.0), F.col("weight") * rate))
        .withColumn("sampled", draw < F.col("probability"))
        .drop("_weight", *[f"_{m}" for m in MARGINS])
    )


def sample(docs: DataFrame, **how) -> DataFrame:
    """The drawn documents, each once, with capped weights and the columns of ``docs``; columns with the names that calibrate() adds are kept as they were."""
    names: Sequence[str] = docs.columns
    clash = {c: f"_own_{k}" for k, c in enumerate(names) if c.lower() in ("topic", "n_tokens", "weight", "probability", "sampled")}
    apart = docs.withColumnsRenamed(clash)
    return calibrate(apart, **{"capped": True} | how).where("sampled").select(*[F.col(clash.get(c, c)).alias(c) for c in names])
