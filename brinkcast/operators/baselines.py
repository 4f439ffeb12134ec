"""Chronological split and the four baselines a forecast is held against."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinkcast.functions.scores import step_baseline
from brinkcast.operators.ordered import last_at_or_before, previous_value, time_rank
from brinkcast.schemas import THRESHOLDS

ORDER = ("window_start", "window_end")


def marginal_rates(train: DataFrame) -> DataFrame:
    """B1, one row: share of windows reaching each threshold, with a jump, with a
    post; zeros without windows."""

    def share(cond: Column) -> Column:
        return F.coalesce(F.avg(cond.cast("double")), F.lit(0.0))

    return train.agg(
        *[share(F.col("v_max") >= k).alias(f"rate_{k}") for k in THRESHOLDS],
        share(F.col("had_jump")).alias("jump_rate"),
        share(F.col("n_posts") > 0).alias("posts_rate"),
    )


def previous_v_max(windows: DataFrame, min_gap: bool = False) -> DataFrame:
    """Add ``prev_v_max``: the maximum of the window just before in start order.

    On a fine grid neighbouring windows overlap, which flatters this baseline;
    ``min_gap`` takes the newest window that had ended by the start instead.
    """
    if not min_gap:
        return previous_value(windows, "window_start", ["window_end"], "v_max", "prev_v_max")
    ended = windows.select(
        "window_end", F.col("window_start").alias("from_start"), F.col("v_max").alias("prev_v_max")
    )
    seen = last_at_or_before(windows, "window_start", ended, "window_end", ["from_start", "prev_v_max"])
    return windows.join(seen.select("window_start", "prev_v_max"), "window_start").select(
        *windows.columns, "prev_v_max"
    )


def default_split_point(windows: DataFrame) -> DataFrame:
    """One row ``train_until``: the end of window number n div 2 in start order
    (of the first one when there is a single window)."""
    ranked = time_rank(windows.select(*ORDER), "window_start", ["window_end"])
    wanted = F.greatest(F.floor(F.col("n_total") / 2), F.lit(1))
    return ranked.where(F.col("rank") == wanted).agg(F.max("window_end").alias("train_until"))


def chronological_split(windows: DataFrame, train_until: Column) -> DataFrame:
    """Add ``is_test``: windows ending after ``train_until``."""
    return windows.withColumn("is_test", F.col("window_end") > train_until)


def baseline_probs(windows: DataFrame) -> DataFrame:
    """B1 to B4 for every test window, long: ``score_set`` with a column per target.

    ``windows`` has ``is_test``, outcomes, ``v_recent`` and ``eco_mean_6h``.  B1
    enters as a scalar subquery.  Targets a baseline does not cover are NULL.
    """
    rates = marginal_rates(windows.where("not is_test"))
    b1 = rates.select(F.struct("*").alias("b1")).scalar()
    test = previous_v_max(windows).where("is_test").withColumn("b1", b1)
    none = F.lit(None).cast("double")

    def entry(name: str, cells: list[Column], c3: Column, c4: Column) -> Column:
        return F.struct(
            F.lit(name).alias("score_set"),
            *[c.alias(f"c2_{k}_prob") for k, c in zip(THRESHOLDS, cells)],
            c3.alias("c3_prob"),
            c4.alias("c4_prob"),
        )

    def rate(k: int) -> Column:
        return F.col("b1")[f"rate_{k}"]

    prev = F.col("prev_v_max")
    sets = F.array(
        entry("B1", [rate(k) for k in THRESHOLDS], F.col("b1")["jump_rate"], F.col("b1")["posts_rate"]),
        entry("B2", [step_baseline(F.col("v_recent"), k) for k in THRESHOLDS], none, none),
        entry(
            "B3",
            [F.when(prev.isNull(), rate(k)).otherwise(step_baseline(prev, k)) for k in THRESHOLDS],
            none,
            none,
        ),
        entry("B4", [step_baseline(F.col("eco_mean_6h"), k) for k in THRESHOLDS], none, none),
    )
    keep = [c for c in windows.columns if c != "is_test"]
    return test.select(*keep, F.explode(sets).alias("s")).select(*keep, "s.*")


def month_split(
    windows: DataFrame, now: Column, train: int = 24, validation: int = 6, test: int = 2
) -> DataFrame:
    """Add ``split`` by whole months back from ``now``: train from 24 to 6 months,
    validation from 6 to 2, test the last 2; other windows are left out."""

    def back(months: int) -> Column:
        return F.expr(f"interval {months} months")

    start = F.col("window_start")
    split = (
        F.when((start >= now - back(train)) & (start < now - back(validation)), "train")
        .when((start >= now - back(validation)) & (start < now - back(test)), "validation")
        .when((start >= now - back(test)) & (start < now), "test")
    )
    return windows.withColumn("split", split).where("split is not null")


def chrono_holdout(df: DataFrame, ts: str, tie: list[str], fraction: float = 0.2) -> DataFrame:
    """Add ``is_holdout``: the last ceil(fraction * n) rows in time order."""
    ranked = time_rank(df, ts, tie, "_rank", "_n")
    held = F.ceil(F.col("_n") * F.lit(fraction))
    return ranked.select(*df.columns, (F.col("_rank") > F.col("_n") - held).alias("is_holdout"))
