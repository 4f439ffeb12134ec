"""Scoring expressions: forecast formulas, labels, step baselines, bins."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinkcast.schemas import THRESHOLDS

BINARY_TARGETS = tuple(f"c2_{k}" for k in THRESHOLDS) + ("c3", "c4")
PROB_COLUMNS = tuple(f"{t}_prob" for t in BINARY_TARGETS)


def sigmoid(x: Column) -> Column:
    """Logistic function; saturates at 0 and 1."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def clip(x: Column, lo: float, hi: float) -> Column:
    return F.least(F.lit(hi), F.greatest(F.lit(lo), x))


def features_to_probs(df: DataFrame) -> DataFrame:
    """Add the seven forecast columns of the simple predictor.

    Fixed values: the slopes, offsets and clip limits of the formulas.
    """
    eco, own = F.col("eco_mean_6h"), F.col("primary_mean_24h")
    posts = F.col("primary_posts_6h").cast("double")
    rate = posts / F.lit(6.0)
    probs = {"c1_value": clip(F.lit(0.55) * eco + F.lit(0.45) * own, 0.0, 6.0)}
    for k in THRESHOLDS:
        z = F.lit(1.1) * (eco - F.lit(k - 0.75)) + F.lit(0.35) * (own - F.lit(k - 1.25))
        probs[f"c2_{k}_prob"] = clip(sigmoid(z), 0.01, 0.99)
    probs["c3_prob"] = clip(
        sigmoid((eco - own) - F.lit(1.25) + F.lit(0.1) * (posts - F.lit(2.0))), 0.01, 0.99
    )
    probs["c4_prob"] = clip(
        F.lit(1.0) - F.exp(F.lit(-2.0) * F.greatest(rate, F.lit(0.01))), 0.02, 0.95
    )
    return df.withColumns(probs)


def window_targets() -> dict[str, Column]:
    """Observed label per target, from ``v_max``, ``had_jump``, ``n_posts``."""
    labels = {f"c2_{k}": (F.col("v_max") >= k).cast("int") for k in THRESHOLDS}
    labels["c3"] = F.col("had_jump").cast("int")
    labels["c4"] = (F.col("n_posts") > 0).cast("int")
    labels["c1"] = F.greatest(F.col("v_max"), F.lit(0)).cast("int")
    return labels


def had_jump(n_posts: Column, v_max: Column, v_recent: Column) -> Column:
    """A jump: some post, a label, and a maximum at least two above the recent mean."""
    return (n_posts > 0) & (v_max >= 0) & (v_max >= v_recent + F.lit(2.0))


def step_baseline(x: Column, k: int) -> Column:
    """1.0 once the value reaches the threshold, else 0.0 (NULL counts as not reached)."""
    return F.when(x >= F.lit(float(k)), 1.0).otherwise(0.0)


def bin_edges(bins: int) -> list[float]:
    """Evenly spaced edges over [0, 1], the products i * (1 / bins)."""
    width = 1.0 / bins
    return [i * width for i in range(bins)] + [1.0]


def bin_of(x: Column, edges: list[float]) -> Column:
    """Index of the half-open bin holding ``x``, the last one closed; NULL outside.

    Counts the inner edges at or below ``x``: plain comparisons, so a value
    equal to an edge is judged against that very double.
    """
    lo, hi = edges[0], edges[-1]
    count = reduce(
        lambda acc, e: acc + (x >= F.lit(e)).cast("int"), edges[1:-1], F.lit(0)
    )
    inside = F.lit(True)
    if lo != -math.inf:
        inside = inside & (x >= F.lit(lo))
    if hi != math.inf:
        inside = inside & (x <= F.lit(hi))
    return F.when(inside & x.isNotNull() & ~F.isnan(x.cast("double")), count)
