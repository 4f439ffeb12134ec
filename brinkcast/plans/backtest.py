"""Backtest: outcomes and forecasts of a period against the baselines."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brinkcast.functions.scores import PROB_COLUMNS, window_targets
from brinkcast.functions.times import from_micros, micros, time_literal
from brinkcast.operators.baselines import (
    baseline_probs,
    chronological_split,
    default_split_point,
)
from brinkcast.operators.metrics import target_array, target_metrics
from brinkcast.operators.ordered import stored, ts_type
from brinkcast.operators.predictions import (
    align_predictions,
    in_period,
    with_outcome_context,
)
from brinkcast.operators.windows import ecosystem_at, ecosystem_from_panes

BASELINES = ("B1", "B2", "B3", "B4")


def _long(rows: DataFrame) -> DataFrame:
    """One row per forecast and target; targets a score set lacks (NULL) drop out."""
    labels = window_targets()
    cells = [
        F.struct(
            F.lit(c.removesuffix("_prob")).alias("target"),
            F.col(c).alias("prob"),
            labels[c.removesuffix("_prob")].alias("label"),
        )
        for c in PROB_COLUMNS
    ]
    if "c1_value" in rows.columns:
        cells.append(
            F.struct(F.lit("c1").alias("target"), F.col("c1_value").alias("prob"), labels["c1"].alias("label"))
        )
    return (
        rows.select("score_set", F.explode(F.array(*cells)).alias("t"))
        .select("score_set", "t.*")
        .where(F.col("prob").isNotNull())
    )


def score_sets(windows: DataFrame, predictions: DataFrame, bounded: bool = True) -> DataFrame:
    """All baselines and models by target: n_test, n, auc_pr, ece, mae, base_rate.

    ``windows`` has ``is_test``.  Targets without forecasts keep a row with n = 0.
    The scored rows of a model and target number as many as windows, bounded by the
    calendar, so each is ranked in one window; pass ``bounded=False`` otherwise.
    """
    base = baseline_probs(windows)
    test = windows.where("is_test")
    models = align_predictions(test, predictions).withColumnRenamed("model_version", "score_set")
    scored = _long(base).unionByName(_long(models))
    metrics = target_metrics(scored, ["score_set"], bounded=bounded)

    spark = windows.sparkSession
    names = F.array(*[F.lit(b) for b in BASELINES])
    base_spine = spark.range(1).select(
        F.explode(names).alias("score_set"), F.lit(False).alias("is_model")
    )
    model_spine = predictions.select(
        F.col("model_version").alias("score_set"), F.lit(True).alias("is_model")
    ).distinct()
    spine = base_spine.unionByName(model_spine).select(
        "score_set",
        F.explode(F.when(F.col("is_model"), target_array(True)).otherwise(target_array(False))).alias("target"),
    )
    out = spine.join(metrics, ["score_set", "target"], "left")
    empty_rate = F.when(F.col("target") != "c1", F.lit(0.0))
    # Every aligned row has c2_3, whatever else it lacks.
    aligned = F.max(F.when(F.col("target") == "c2_3", F.col("n"))).over(W.partitionBy("score_set"))
    return out.select(
        "score_set",
        F.coalesce(aligned, F.lit(0)).alias("n_test"),
        "target",
        F.coalesce("n", F.lit(0)).alias("n"),
        "auc_pr",
        "ece",
        "mae",
        F.coalesce("base_rate", empty_rate).alias("base_rate"),
    )


@dataclass
class BacktestReport:
    """Header (one row), metrics (one row per score set and target)."""

    header: DataFrame
    metrics: DataFrame

    def nested(self) -> DataFrame:
        """Both in one row, ready to be written as JSON.  Bounded by score sets."""
        one = F.lit(0).alias("k")
        fields = ["target", "n", "auc_pr", "ece", "mae", "base_rate"]
        sets = self.metrics.groupBy("score_set", "n_test").agg(
            F.sort_array(F.collect_list(F.struct(*fields))).alias("metrics")
        )
        packed = sets.agg(
            F.sort_array(F.collect_list(F.struct("score_set", "n_test", "metrics"))).alias("score_sets"), one
        )
        return self.header.withColumn("k", F.lit(0)).join(packed, "k").drop("k")


def split_windows(windows: DataFrame, train_until: datetime | str | None) -> DataFrame:
    """Windows with ``train_until`` and ``is_test``; by default split in the middle.

    The middle is looked up first (one value), so that both sides are plain
    comparisons with a constant afterwards.
    """
    dtype = ts_type(windows, "window_end")
    if train_until is not None:
        border: Column = time_literal(train_until, dtype)
    else:
        found = default_split_point(windows).select(micros(F.col("train_until"))).first()[0]
        border = from_micros(F.lit(found).cast("long"), dtype)
    return chronological_split(windows.withColumn("train_until", border), border)


def report_header(
    windows: DataFrame, since: datetime | str, until: datetime | str, train_until: datetime | str | None
) -> DataFrame:
    """Counts and notes of a period; one row also when the period is empty."""
    dtype = ts_type(windows, "window_start")
    n, test = F.count("*"), F.count_if("is_test")
    fallback = time_literal(since if train_until is None else train_until, dtype)
    counts = windows.agg(
        F.coalesce(F.max("train_until"), fallback).alias("train_until"),
        n.alias("n_windows_total"),
        (n - test).alias("n_windows_train"),
        test.alias("n_windows_test"),
        F.coalesce(F.sum(F.when(F.col("is_test"), F.col("eco_n_6h"))), F.lit(0)).alias("ecosystem_posts_test"),
    )
    notes = F.array_compact(
        F.array(
            F.when(F.col("n_windows_test") == 0, F.lit("empty_test_set")),
            F.when(F.col("n_windows_train") == 0, F.lit("empty_train_set_b1_zero")),
            F.when(F.col("ecosystem_posts_test") == 0, F.lit("no_ecosystem_data_b4_degenerate")),
        )
    )
    none = F.col("n_windows_total") == 0
    return counts.select(
        time_literal(since, dtype).alias("period_start"),
        time_literal(until, dtype).alias("period_end"),
        "train_until",
        "n_windows_total",
        "n_windows_train",
        "n_windows_test",
        "ecosystem_posts_test",
        F.when(none, F.array(F.lit("no_outcomes_in_period"))).otherwise(notes).alias("notes"),
    )


def backtest_report(
    outcomes: DataFrame,
    predictions: DataFrame,
    posts: DataFrame | None,
    since: datetime | str,
    until: datetime | str,
    train_until: datetime | str | None = None,
    panes: DataFrame | None = None,
) -> BacktestReport:
    """The full report.  ``posts`` are all posts with their newest level; a pane
    table may stand in for them when windows start on the grid.

    Header, baselines and metrics all start from the same scored windows.  These
    are few (the calendar bounds them) but costly to derive, so they are
    checkpointed: later passes read the stored rows, not the posts.
    """
    windows = in_period(with_outcome_context(outcomes), since, until)
    if panes is not None:
        windows = ecosystem_from_panes(windows, panes)
    elif posts is not None:
        windows = ecosystem_at(windows, posts)
    else:
        raise ValueError("give posts or panes")
    forecasts = in_period(predictions, since, until)
    windows = stored(windows)
    empty = windows.isEmpty()
    windows = split_windows(windows, train_until)
    header = report_header(windows, since, until, train_until)
    metrics = score_sets(windows, forecasts)
    # A period without outcomes has a header and no score sets.
    return BacktestReport(header, metrics.limit(0) if empty else metrics)
