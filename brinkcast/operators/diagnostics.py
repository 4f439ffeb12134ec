"""Reading a backtest closely: lead time, strata, errors, promotion, live monitoring."""

from __future__ import annotations

from math import exp, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brinkcast.functions.times import MINUTE, micros, pane_floor
from brinkcast.operators.metrics import metrics_of_counts, score_counts, target_metrics
from brinkcast.operators.ordered import lookback_stats


def lead_times(hits: DataFrame, primary: DataFrame, minutes: int = 15) -> DataFrame:
    """Minutes from forecast to the first post that makes the jump, per hit.

    ``hits``: forecasts that announced a jump in a window that had one, with
    ``made_at``, the window and ``v_recent``.  Posts are cut to the earliest per
    pane and level, at most seven per pane, before windows meet them.
    """
    step = minutes * MINUTE
    us = micros(F.col("published_at"))
    first = primary.where(F.col("valence_level").isNotNull()).groupBy(
        pane_floor(us, step).alias("pane"), "valence_level"
    ).agg(F.min(us).alias("first_us"))
    ws, we = micros(F.col("window_start")), micros(F.col("window_end"))
    panes = hits.select("*", F.explode(F.sequence(ws, we - F.lit(step), F.lit(step))).alias("pane"))
    key = hits.columns
    found = panes.join(first, "pane").where(F.col("valence_level") >= F.col("v_recent") + F.lit(2.0))
    out = found.groupBy(*key).agg(F.min("first_us").alias("first_us"))
    return out.select(
        *key, ((F.col("first_us") - micros(F.col("made_at"))).cast("double") / MINUTE).alias("lead_minutes")
    )


def mean_lead_time(hits: DataFrame, primary: DataFrame, by: list[str], minutes: int = 15) -> DataFrame:
    return lead_times(hits, primary, minutes).groupBy(*by).agg(
        F.count("*").alias("n_hits"), F.avg("lead_minutes").alias("mean_lead_minutes")
    )


def evaluation_strata(
    windows: DataFrame,
    events: DataFrame,
    decisions: DataFrame,
    topics: DataFrame | None = None,
    zone: str = "America/New_York",
) -> DataFrame:
    """Windows with the strata they fall in, as an array ``strata``.

    normal / event: no event or some event in the six hours before the start;
    morning: start between 6 and 9 local time on a working day; decision: a
    decision within 48 hours either side; emerging: a topic's first sign in the
    30 days before (``topics``: topic, published_at).  Events and decisions have
    ``ts``.
    """
    one = F.lit(1)

    def near(df: DataFrame, ts: str, at: str, hours: int, name: str) -> DataFrame:
        return lookback_stats(rows, at, df.withColumn("one", one), ts, "one", hours, "_m", name).drop("_m")

    rows = windows.withColumn("_late", F.col("window_start") + F.expr("interval 48 hours"))
    out = rows.join(near(events, "ts", "window_start", 6, "_events"), "window_start")
    out = out.join(near(decisions, "ts", "_late", 96, "_decisions"), "_late")
    local = F.from_utc_timestamp(F.col("window_start").cast("timestamp"), zone)
    morning = F.hour(local).between(6, 8) & (F.weekday(local) < 5)
    tags = [
        F.when(F.col("_events") > 0, "event").otherwise("normal"),
        F.when(morning, F.lit("morning")),
        F.when(F.col("_decisions") > 0, F.lit("decision")),
    ]
    if topics is not None:
        first = topics.groupBy("topic").agg(F.min("published_at").alias("first_seen"))
        out = out.join(near(first, "first_seen", "window_start", 30 * 24, "_topics"), "window_start")
        tags.append(F.when(F.col("_topics") > 0, F.lit("emerging")).otherwise("evergreen"))
    return out.select(*windows.columns, F.array_compact(F.array(*tags)).alias("strata"))


def metrics_by_stratum(scored: DataFrame, by: list[str], bounded: bool = True) -> DataFrame:
    """Target metrics per stratum; a forecast counts in each stratum of its window."""
    rows = scored.select(*by, "target", "prob", "label", F.explode("strata").alias("stratum"))
    return target_metrics(rows, [*by, "stratum"], bounded=bounded)


def confident_errors(scored: DataFrame, n: int = 20, prob: float = 0.8) -> DataFrame:
    """The surest forecasts that did not come true."""
    wrong = scored.where((F.col("prob") >= prob) & (F.col("label") == 0))
    return wrong.orderBy(F.desc("prob"), "window_start", "score_set", "target").limit(n)


def surprises(aligned: DataFrame, n: int = 20, gap: float = 2.0) -> DataFrame:
    """Windows whose maximum exceeded the expected level most."""
    rows = aligned.withColumn("gap", F.col("v_max") - F.col("c1_value"))
    return rows.where(F.col("gap") >= gap).orderBy(F.desc("gap"), "window_start", "model_version").limit(n)


# Distribution function of a Poisson variable with mean 1.
POISSON_STEPS = [exp(-1) * sum(1 / factorial(j) for j in range(k + 1)) for k in range(13)]


def poisson_weight(key: Column, replicate: Column) -> Column:
    """Number of times a row enters a bootstrap replicate, from a hash of both."""
    digits = F.substring(F.md5(F.concat_ws(":", key, replicate.cast("string"))), 1, 8)
    u = F.conv(digits, 16, 10).cast("double") / F.lit(4294967296.0)
    weight = F.lit(0)
    for step in POISSON_STEPS:
        weight = weight + (u >= F.lit(step)).cast("int")
    return weight


def bootstrap_gain(pairs: DataFrame, replicates: int = 200, key: str = "window_start") -> DataFrame:
    """Mean gain over a rival and the share of replicates without gain.

    ``pairs`` has ``prob``, ``rival`` and ``label`` per window; the gain is the
    rival's squared error minus the forecast's.  Rows are weighted per replicate,
    so a replicate is one group of a plain aggregation.
    """
    y = F.col("label").cast("double")
    gain = (F.col("rival") - y) * (F.col("rival") - y) - (F.col("prob") - y) * (F.col("prob") - y)
    name = F.date_format(F.col(key), "yyyy-MM-dd HH:mm:ss")
    rows = pairs.select(
        gain.alias("gain"), name.alias("k"), F.explode(F.sequence(F.lit(0), F.lit(replicates))).alias("r")
    )
    # Replicate 0 is the data itself.
    weight = F.when(F.col("r") == 0, F.lit(1)).otherwise(poisson_weight(F.col("k"), F.col("r")))
    means = rows.withColumn("w", weight).groupBy("r").agg(
        (F.sum(F.col("w") * F.col("gain")) / F.sum("w")).alias("gain")
    )
    return means.agg(
        F.max(F.when(F.col("r") == 0, F.col("gain"))).alias("mean_gain"),
        F.avg(F.when(F.col("r") > 0, (F.col("gain") <= 0).cast("double"))).alias("p_no_gain"),
    )


def promotion_gate(
    scored: DataFrame,
    candidate: str,
    current: str,
    gain: DataFrame,
    max_regression: float = 0.05,
    max_ece: float = 0.10,
    alpha: float = 0.05,
    bounded: bool = True,
) -> DataFrame:
    """One row: may the candidate replace the current model?

    Four figures are compared: MAE of c1, mean AUC-PR over the thresholds, AUC-PR
    of c3, Brier score of c4.  It must be at least as good on three, lose no more
    than 5 % on any, keep every calibration error within 0.10, and beat the
    rival in the bootstrap (``gain``, see :func:`bootstrap_gain`).
    """
    rows = scored.where(F.col("score_set").isin(candidate, current))
    counts = score_counts(rows, ["score_set", "target"])
    m = metrics_of_counts(counts, ["score_set", "target"], bounded=bounded)

    def figure(model: str, cond: Column, column: str) -> Column:
        return F.avg(F.when((F.col("score_set") == model) & cond, F.col(column)))

    t = F.col("target")
    parts = {"c1": (t == "c1", "mae"), "c2": (t.startswith("c2"), "auc_pr"), "c3": (t == "c3", "auc_pr"), "c4": (t == "c4", "brier")}
    wide = m.agg(
        *[figure(candidate, c, col).alias(f"new_{k}") for k, (c, col) in parts.items()],
        *[figure(current, c, col).alias(f"old_{k}") for k, (c, col) in parts.items()],
        F.max(F.when(F.col("score_set") == candidate, F.col("ece"))).alias("worst_ece"),
        F.lit(0).alias("k"),
    )
    # Relative improvement, positive is better, whichever way the figure points.
    better = {
        k: ((F.col(f"new_{k}") - F.col(f"old_{k}")) * (1 if col == "auc_pr" else -1)) / F.nullif(F.abs(F.col(f"old_{k}")), F.lit(0.0))
        for k, (_, col) in parts.items()
    }
    row = wide.select("*", *[F.coalesce(e, F.lit(0.0)).alias(f"gain_{k}") for k, e in better.items()])
    row = row.join(gain.withColumn("k", F.lit(0)), "k").drop("k")
    n_better = sum(((F.col(f"gain_{k}") >= 0).cast("int") for k in parts), F.lit(0))
    worst = F.least(*[F.col(f"gain_{k}") for k in parts])
    row = row.select("*", n_better.alias("n_not_worse"), worst.alias("worst_gain"))
    promote = (
        (F.col("n_not_worse") >= 3)
        & (F.col("worst_gain") >= -max_regression)
        & (F.coalesce("worst_ece", F.lit(0.0)) <= max_ece)
        & (F.col("mean_gain") > 0)
        & (F.col("p_no_gain") <= alpha)
    )
    return row.withColumn("promote", promote)


def rolling_metrics(
    scored: DataFrame, by: list[str], horizons: tuple[int, int] = (7, 30), bounded: bool = True
) -> DataFrame:
    """Per day and target: n, ECE, AUC-PR and Brier over the last 7 and 30 days.

    Scores are counted per day first; each day's counts feed the days ahead.
    ``scored`` has ``window_end``.
    """
    key = [*by, "target"]
    daily = score_counts(scored.withColumn("day", F.to_date("window_end")), [*key, "day"])
    last = scored.agg(F.max(F.to_date("window_end")).alias("d"))
    out = None
    short, long = horizons
    ahead = F.explode(F.sequence(F.lit(0), F.lit(long - 1))).alias("age")
    rows = daily.select("*", ahead).withColumn("day", F.date_add("day", F.col("age")))
    rows = rows.where(F.col("day") <= last.scalar())
    spans = F.when(F.col("age") < short, F.array(F.lit(short), F.lit(long))).otherwise(F.array(F.lit(long)))
    rows = rows.withColumn("span", F.explode(spans))
    summed = rows.groupBy(*key, "day", "span", "score").agg(
        *[F.sum(c).alias(c) for c in ("n", "pos", "label_sum", "abs_err", "sq_err")]
    )
    m = metrics_of_counts(summed, [*key, "day", "span"], bounded=bounded)
    out = m.groupBy(*key, "day").agg(
        *[
            F.max(F.when(F.col("span") == s, F.col(c))).alias(f"{c}_{s}d")
            for s in horizons
            for c in ("n", "ece", "auc_pr", "brier")
        ]
    )
    return out


def drift_alerts(rolling: DataFrame, by: list[str]) -> DataFrame:
    """Alert flags per day.  Fixed values: ECE over 7 days above 0.15 on two days in a
    row; AUC-PR over 7 days below 0.85 of that over 30; Brier above 1.25 times."""
    order = W.partitionBy(*by, "target").orderBy("day")
    high = F.coalesce(F.col("ece_7d") > 0.15, F.lit(False))
    rows = rolling.withColumn("_high", high)
    yesterday = (F.lag("_high").over(order)) & (F.lag("day").over(order) == F.date_sub("day", 1))
    return rows.select(
        *by,
        "target",
        "day",
        F.coalesce(F.col("_high") & yesterday, F.lit(False)).alias("ece_alert"),
        F.coalesce(F.col("auc_pr_7d") < F.lit(0.85) * F.col("auc_pr_30d"), F.lit(False)).alias("auc_pr_alert"),
        F.coalesce(F.col("brier_7d") > F.lit(1.25) * F.col("brier_30d"), F.lit(False)).alias("brier_alert"),
    )
