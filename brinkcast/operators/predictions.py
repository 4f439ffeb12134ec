"""Forecast rows: writing, listing, due windows, alignment with outcomes."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinkcast.functions.keys import (
    FEATURE_COLUMNS,
    feature_hash,
    outcome_context,
    prediction_payload,
)
from brinkcast.functions.scores import PROB_COLUMNS, features_to_probs
from brinkcast.functions.times import time_literal
from brinkcast.operators.ordered import ts_type

# Names under which the simple predictor's forecasts are stored.
MODEL_VERSION = "trailing-mix-1"
FEATURE_SET_VERSION = "trailing-5"


def prediction_rows(
    features: DataFrame,
    made_at: Column | None = None,
    model_version: str = MODEL_VERSION,
    hours: int = 2,
) -> DataFrame:
    """One forecast row per feature row, for the window starting at ``h``."""
    scored = features_to_probs(features)
    made = F.col("h") if made_at is None else made_at
    return scored.select(
        made.alias("made_at"),
        F.col("h").alias("window_start"),
        (F.col("h") + F.make_dt_interval(hours=F.lit(hours))).alias("window_end"),
        F.lit(model_version).alias("model_version"),
        F.lit(FEATURE_SET_VERSION).alias("feature_set_version"),
        feature_hash(F.col("h")).alias("feature_hash"),
        "c1_value",
        *PROB_COLUMNS,
        prediction_payload(("h", *FEATURE_COLUMNS), ("c1_value", *PROB_COLUMNS)).alias("payload"),
    )


def latest_predictions(predictions: DataFrame, n: int = 40) -> DataFrame:
    """The newest forecasts for a listing, rounded, with a short hash."""

    def shown(name: str) -> Column:
        return F.round(F.coalesce(name, F.lit(0.0)), 3).alias(name)

    return (
        predictions.orderBy(F.desc("made_at"), F.desc("window_start"), "model_version").limit(n)
        .select(
            "made_at", "window_start", "window_end", "model_version",
            shown("c2_4_prob"), shown("c2_5_prob"), shown("c4_prob"),
            F.substring(F.coalesce("feature_hash", F.lit("")), 1, 16).alias("feature_hash"),
        )
    )


def due_windows(
    predictions: DataFrame,
    outcomes: DataFrame,
    now: datetime | str,
    limit: int | None = None,
    dedupe: bool = True,
) -> DataFrame:
    """Forecast windows that ended before ``now`` and have no outcome, oldest first.

    All of them, unless a limit is asked for.  It counts distinct windows; with ``dedupe=False`` it counts forecast
    rows, so windows forecast by several models use it up sooner.
    """
    key = ["window_start", "window_end"]
    closed = predictions.where(
        F.col("window_end") < time_literal(now, ts_type(predictions, "window_end"))
    ).select(*key)
    if dedupe:
        closed = closed.distinct()
    due = closed.join(outcomes.select(*key).distinct(), key, "left_anti").orderBy(
        "window_end", "window_start"
    )
    return due if limit is None else due.limit(limit)


def align_predictions(windows: DataFrame, predictions: DataFrame) -> DataFrame:
    """Outcome windows joined to forecasts; a missing probability counts as 0."""
    probs = [F.coalesce(c, F.lit(0.0)).alias(c) for c in ("c1_value", *PROB_COLUMNS)]
    return windows.join(
        predictions.select("window_start", "window_end", "model_version", *probs),
        ["window_start", "window_end"],
    )


def in_period(df: DataFrame, since: datetime | str, until: datetime | str) -> DataFrame:
    """Windows that start at or after ``since`` and end by ``until``."""
    dtype = ts_type(df, "window_start")
    return df.where(
        (F.col("window_start") >= time_literal(since, dtype))
        & (F.col("window_end") <= time_literal(until, dtype))
    )


def with_outcome_context(outcomes: DataFrame) -> DataFrame:
    """Stored outcomes with ``v_recent`` read back from their JSON column."""
    if "v_recent" in outcomes.columns:
        return outcomes
    return outcomes.withColumn("v_recent", outcome_context(F.col("targets_observed")))


def outcomes_in_order(outcomes: DataFrame, since: datetime | str, until: datetime | str) -> DataFrame:
    """Outcomes of a period by window start."""
    return in_period(outcomes, since, until).orderBy("window_start", "window_end")
