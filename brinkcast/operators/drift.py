"""Distribution drift."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brinkcast.operators.ordered import quantiles_of_counts, stored


def psi(
    expected: DataFrame,
    actual: DataFrame,
    value: str,
    by: list[str] | None = None,
    bins: int = 10,
    parts: int | None = None,
) -> DataFrame:
    """Population stability index per group.

    Bin borders are exact quantiles of ``expected`` with open ends; equal
    borders leave empty bins; one is added to every count.  0 when either side
    is empty.  Both sides are counted per distinct value before they meet the
    borders, and the result is one wide aggregate per group.
    """
    by = by or []

    def side(df: DataFrame, name: str) -> DataFrame:
        return (
            df.where(F.col(value).isNotNull())
            .groupBy(*by, F.col(value).cast("double").alias("x"))
            .agg(F.count("*").alias("n"))
            .withColumn("side", F.lit(name))
        )

    probs = [i * (1.0 / bins) for i in range(1, bins)]
    own = stored(side(expected, "e"))
    borders = quantiles_of_counts(own.drop("side"), "x", probs, by, "q", parts).drop("n")
    rows = own.unionByName(side(actual, "a"))
    if by:
        rows = rows.join(borders, by, "left")
    else:
        rows = rows.withColumn("q", borders.scalar())
    index = reduce(
        lambda acc, i: acc + (F.col("x") >= F.col("q")[i]).cast("int"), range(bins - 1), F.lit(0)
    )
    rows = rows.select(*by, "side", "n", index.alias("bin"))
    counts = rows.groupBy(*by).agg(
        F.sum(F.when(F.col("side") == "e", F.col("n"))).alias("ne"),
        F.sum(F.when(F.col("side") == "a", F.col("n"))).alias("na"),
        *[
            F.sum(F.when((F.col("side") == s) & (F.col("bin") == i), F.col("n")).otherwise(0)).alias(f"{s}{i}")
            for s in "ea"
            for i in range(bins)
        ],
    )
    terms = []
    for i in range(bins):
        pe = (F.col(f"e{i}") + 1).cast("double") / (F.col("ne") + bins)
        pa = (F.col(f"a{i}") + 1).cast("double") / (F.col("na") + bins)
        terms.append((pa - pe) * F.ln(pa / pe))
    total = reduce(lambda a, b: a + b, terms)
    return counts.select(
        *by,
        F.coalesce("ne", F.lit(0)).alias("n_expected"),
        F.coalesce("na", F.lit(0)).alias("n_actual"),
        F.coalesce(total, F.lit(0.0)).alias("psi"),
    )


def feature_psi(
    expected: DataFrame, actual: DataFrame, features: list[str], bins: int = 10, parts: int | None = None
) -> DataFrame:
    """Covariate drift: the index of every feature, one row per ``feature``."""

    def long(df: DataFrame) -> DataFrame:
        cells = [F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features]
        return df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")

    return psi(long(expected), long(actual), "value", ["feature"], bins, parts)


def label_drift(labels: DataFrame, ts: str, level: str, levels: tuple[int, ...] = (0, 1, 2, 3, 4, 5, 6)) -> DataFrame:
    """Per month: share of each level, and the stability index of the month against
    all months before it (NULL for the first).  Counts are cut to months first."""
    counts = labels.groupBy(F.trunc(F.col(ts).cast("date"), "MM").alias("month")).agg(
        F.count(level).alias("n"), *[F.count_if(F.col(level) == k).alias(f"n_{k}") for k in levels]
    )
    before = W.orderBy("month").rowsBetween(W.unboundedPreceding, -1)
    rows = counts.select(
        "*", F.sum("n").over(before).alias("h"), *[F.sum(f"n_{k}").over(before).alias(f"h_{k}") for k in levels]
    )
    size = len(levels)
    terms = []
    for k in levels:
        now = (F.col(f"n_{k}") + 1).cast("double") / (F.col("n") + size)
        past = (F.col(f"h_{k}") + 1).cast("double") / (F.col("h") + size)
        terms.append((now - past) * F.ln(now / past))
    return rows.select(
        "month",
        "n",
        *[(F.col(f"n_{k}").cast("double") / F.col("n")).alias(f"share_{k}") for k in levels],
        reduce(lambda a, b: a + b, terms).alias("psi"),
    )
