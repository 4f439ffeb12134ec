"""Scores of probabilistic forecasts.

Frames are long: one row per forecast with ``prob`` and ``label`` and any group
columns.  Forecasts are first counted per distinct score, before the shuffle;
rankings then run over distinct scores in ranges (see ``ordered``), or within the group
where the caller knows it is ``bounded``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinkcast.functions.scores import BINARY_TARGETS, bin_edges, bin_of
from brinkcast.operators.ordered import running_totals, stored


def score_counts(df: DataFrame, by: list[str], prob: str = "prob", label: str = "label") -> DataFrame:
    """Per group and distinct score: forecasts, positives and absolute error."""
    p, y = F.col(prob).cast("double"), F.col(label)
    return df.groupBy(*by, p.alias("score")).agg(
        F.count("*").alias("n"),
        F.count_if(y > 0).alias("pos"),
        F.sum(y.cast("double")).alias("label_sum"),
        F.sum(F.abs(p - y.cast("double"))).alias("abs_err"),
        F.sum((p - y.cast("double")) * (p - y.cast("double"))).alias("sq_err"),
    )


def _ranked(df: DataFrame, by: list[str], prob: str, label: str, parts: int | None) -> DataFrame:
    """Distinct scores with true and all positives at or above each (inclusive)."""
    counts = stored(score_counts(df, by, prob, label).select(*by, "score", "n", "pos"))
    return running_totals(counts, by, "score", ["n", "pos"], descending=True, parts=parts)


def _precision() -> Column:
    return F.col("cum_pos").cast("double") / F.col("cum_n")


def average_precision(
    df: DataFrame,
    by: list[str] | None = None,
    prob: str = "prob",
    label: str = "label",
    parts: int | None = None,
) -> DataFrame:
    """Step-sum average precision over distinct scores; 0 for a single class.

    The counts per score are stored once and cut into ranges (``parts``: how many).
    """
    by = by or []
    ranked = _ranked(df, by, prob, label, parts)
    step = F.col("pos").cast("double") / F.col("total_pos") * _precision()
    mixed = (F.col("total_pos") > 0) & (F.col("total_pos") < F.col("total_n"))
    return ranked.groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(mixed, step)), F.lit(0.0)).alias("auc_pr"),
    )


def pr_curve(
    df: DataFrame,
    by: list[str] | None = None,
    prob: str = "prob",
    label: str = "label",
    parts: int | None = None,
) -> DataFrame:
    """Precision and recall per threshold, plus the end point (1, 0) without one.

    The end point comes from the row with the largest score (no other score is
    above it), so the curve needs no second pass.
    """
    by = by or []
    ranked = _ranked(df, by, prob, label, parts)
    recall = F.when(F.col("total_pos") > 0, F.col("cum_pos").cast("double") / F.col("total_pos")).otherwise(1.0)
    point = F.struct(F.col("score").alias("threshold"), _precision().alias("precision"), recall.alias("recall"))
    end = F.struct(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    top = F.col("cum_n") == F.col("n")
    points = F.explode(F.when(top, F.array(point, end)).otherwise(F.array(point))).alias("p")
    return ranked.select(*by, points).select(*by, "p.*")


def reliability_table(
    df: DataFrame, by: list[str] | None = None, bins: int = 10, prob: str = "prob", label: str = "label"
) -> DataFrame:
    """Per group and bin: count, mean forecast and observed rate (bins that occur)."""
    by = by or []
    p, y = F.col(prob).cast("double"), F.col(label).cast("double")
    return (
        df.select(*by, bin_of(p, bin_edges(bins)).alias("bin"), p.alias("_p"), y.alias("_y"))
        .groupBy(*by, "bin")
        .agg(F.count("*").alias("n"), F.avg("_p").alias("confidence"), F.avg("_y").alias("accuracy"))
    )


def _ece(bin_name: str = "bin", n: str = "n", conf: str = "confidence", acc: str = "accuracy") -> Column:
    gap = F.col(n) * F.abs(F.col(acc) - F.col(conf))
    return F.coalesce(
        F.sum(F.when(F.col(bin_name).isNotNull(), gap)).cast("double") / F.sum(n), F.lit(0.0)
    )


def expected_calibration_error(
    df: DataFrame, by: list[str] | None = None, bins: int = 10, prob: str = "prob", label: str = "label"
) -> DataFrame:
    """Weighted gap between forecast and rate; forecasts outside [0, 1] are in no
    bin but count in the total; 0 without rows."""
    by = by or []
    return reliability_table(df, by, bins, prob, label).groupBy(*by).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), _ece().alias("ece")
    )


def brier_score(df: DataFrame, by: list[str] | None = None, prob: str = "prob", label: str = "label") -> DataFrame:
    """Mean squared difference of forecast and label."""
    gap = F.col(prob).cast("double") - F.col(label).cast("double")
    return df.groupBy(*(by or [])).agg(F.count("*").alias("n"), F.avg(gap * gap).alias("brier"))


def target_metrics(
    scored: DataFrame,
    by: list[str],
    bins: int = 10,
    bounded: bool = False,
) -> DataFrame:
    """Per group and ``target``: n, auc_pr, ece, mae, base_rate.

    Ranking figures need both classes, else NULL; ``c1`` has MAE and mean label
    only.  ``scored`` has the group columns, ``target``, ``prob``, ``label``.
    One pass counts per distinct score; all figures come from those counts.
    """
    key = [*by, "target"]
    return metrics_of_counts(score_counts(scored, key), key, bins, bounded).drop("brier")


def metrics_of_counts(
    counts: DataFrame, key: list[str], bins: int = 10, bounded: bool = False
) -> DataFrame:
    """The same from score counts (see :func:`score_counts`), plus ``brier``."""
    if not bounded:
        counts = stored(counts)
    ranked = running_totals(counts, key, "score", ["n", "pos"], descending=True, bounded=bounded)
    step = F.when(F.col("total_pos") > 0, F.col("pos").cast("double") / F.col("total_pos") * _precision())
    binned = ranked.groupBy(*key, bin_of(F.col("score"), bin_edges(bins)).alias("bin")).agg(
        F.sum("n").alias("n"),
        F.sum("pos").alias("pos"),
        F.sum("label_sum").alias("label_sum"),
        F.sum("abs_err").alias("abs_err"),
        F.sum("sq_err").alias("sq_err"),
        (F.sum(F.col("score") * F.col("n")) / F.sum("n")).alias("confidence"),
        (F.sum("pos").cast("double") / F.sum("n")).alias("accuracy"),
        F.sum(step).alias("ap"),
    )
    whole = binned.groupBy(*key).agg(
        F.sum("n").alias("n"),
        F.sum("pos").alias("pos"),
        F.sum("ap").alias("ap"),
        _ece().alias("ece_all"),
        (F.sum("abs_err") / F.sum("n")).alias("mae_all"),
        (F.sum("label_sum") / F.sum("n")).alias("base_rate"),
        (F.sum("sq_err") / F.sum("n")).alias("brier"),
    )
    binary = F.col("target") != "c1"
    mixed = binary & (F.col("pos") > 0) & (F.col("pos") < F.col("n"))
    return whole.select(
        *key,
        "n",
        F.when(mixed, F.col("ap")).alias("auc_pr"),
        F.when(mixed, F.col("ece_all")).alias("ece"),
        F.when(~binary, F.col("mae_all")).alias("mae"),
        "base_rate",
        "brier",
    )


def ranking_metrics(
    df: DataFrame,
    by: list[str] | None = None,
    prob: str = "prob",
    label: str = "label",
    min_precision: float = 0.8,
    parts: int | None = None,
) -> DataFrame:
    """Area under ROC, best F1 with its threshold, and the largest recall whose
    precision is at least ``min_precision``; NULL or 0 where undefined."""
    by = by or []
    ranked = _ranked(df, by, prob, label, parts)
    pos, neg = F.col("total_pos"), F.col("total_n") - F.col("total_pos")
    own_neg = F.col("n") - F.col("pos")
    above = (F.col("cum_n") - F.col("n")) - (F.col("cum_pos") - F.col("pos"))
    below = neg - above - own_neg
    wins = F.col("pos") * (below.cast("double") + own_neg.cast("double") / 2)
    f1 = F.lit(2.0) * F.col("cum_pos") / (F.col("cum_n") + pos)
    recall = F.col("cum_pos").cast("double") / pos
    return ranked.groupBy(*by).agg(
        F.sum("n").alias("n"),
        (F.sum(F.when((pos > 0) & (neg > 0), wins / pos / neg))).alias("auc_roc"),
        F.coalesce(F.max(f1), F.lit(0.0)).alias("best_f1"),
        F.max_by("score", F.struct(f1, "score")).alias("best_threshold"),
        F.coalesce(F.max(F.when((pos > 0) & (_precision() >= min_precision), recall)), F.lit(0.0)).alias(
            "recall_at_precision"
        ),
    )


def spearman(
    df: DataFrame, x: str, y: str, by: list[str] | None = None, parts: int | None = None
) -> DataFrame:
    """Rank correlation with mean ranks for ties.

    Ranks are found per distinct value and brought back to the distinct pairs.
    """
    by = by or []
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    pairs = stored(
        rows.groupBy(*by, F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y")).agg(
            F.count("*").alias("n")
        )
    )

    def ranks(column: str, name: str) -> DataFrame:
        counts = pairs.groupBy(*by, column).agg(F.sum("n").alias("n"))
        out = running_totals(counts, by, column, ["n"], parts=parts)
        rank = F.col("cum_n") - F.col("n") + (F.col("n") + 1).cast("double") / 2
        return out.select(*by, column, rank.alias(name))

    ranked = pairs.join(ranks("_x", "rx"), [*by, "_x"]).join(ranks("_y", "ry"), [*by, "_y"])
    n = F.col("n").cast("double")

    def total(c: Column) -> Column:
        return F.sum(n * c)

    sums = ranked.groupBy(*by).agg(
        F.sum("n").alias("n"),
        total(F.col("rx")).alias("sx"),
        total(F.col("ry")).alias("sy"),
        total(F.col("rx") * F.col("rx")).alias("sxx"),
        total(F.col("ry") * F.col("ry")).alias("syy"),
        total(F.col("rx") * F.col("ry")).alias("sxy"),
    )
    cov = F.col("n") * F.col("sxy") - F.col("sx") * F.col("sy")
    vx = F.col("n") * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = F.col("n") * F.col("syy") - F.col("sy") * F.col("sy")
    return sums.select(*by, "n", F.when((vx > 0) & (vy > 0), cov / F.sqrt(vx) / F.sqrt(vy)).alias("rho"))


def histogram(
    df: DataFrame, value: str, edges: list[float], by: list[str] | None = None
) -> DataFrame:
    """Counts per half-open bin, the last closed; empty bins kept, outside dropped."""
    by = by or []
    bins = len(edges) - 1
    found = (
        df.select(*by, bin_of(F.col(value), edges).alias("bin")).where("bin is not null")
        .groupBy(*by, "bin").agg(F.count("*").alias("n"))
    )
    filled = found.groupBy(*by).agg(
        *[F.coalesce(F.sum(F.when(F.col("bin") == i, F.col("n"))), F.lit(0)).alias(f"_{i}") for i in range(bins)]
    )
    cells = F.array(
        *[
            F.struct(
                F.lit(i).alias("bin"),
                F.lit(float(edges[i])).alias("lo"),
                F.lit(float(edges[i + 1])).alias("hi"),
                F.col(f"_{i}").alias("n"),
            )
            for i in range(bins)
        ]
    )
    return filled.select(*by, F.explode(cells).alias("c")).select(*by, "c.*")


def target_array(include_c1: bool) -> Column:
    names = [*BINARY_TARGETS, "c1"] if include_c1 else list(BINARY_TARGETS)
    return F.array(*[F.lit(t) for t in names])
