"""Calendar months of a backfill."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brinkcast.functions.times import month_bounds


def month_spine(spark: SparkSession, since: date | str, until: date | str) -> DataFrame:
    """First and last day of each month from ``since`` to ``until``, both included;
    empty when they are the wrong way round."""
    lo, hi = (date.fromisoformat(str(d)[:10]) for d in (since, until))
    n = (hi.year - lo.year) * 12 + hi.month - lo.month + 1
    first = F.lit(lo.replace(day=1).isoformat()).cast("date")
    months = spark.range(max(0, n)).select(F.add_months(first, F.col("id").cast("int")).alias("month_start"))
    return months.select("month_start", month_bounds(F.col("month_start"))[1].alias("month_end"))


def backfill_months(
    payloads: DataFrame, new_raw: DataFrame, since: date | str, until: date | str
) -> DataFrame:
    """Payloads seen and new raw rows per month, with a total row (NULL month)."""
    month = F.trunc(F.col("published_at").cast("date"), "MM").alias("month_start")

    def counted(df: DataFrame, name: str) -> DataFrame:
        return df.select(month).groupBy("month_start").agg(F.count("*").alias(name))

    spine = month_spine(payloads.sparkSession, since, until)
    rows = (
        spine.join(counted(payloads, "payloads_seen"), "month_start", "left")
        .join(counted(new_raw, "new_raw"), "month_start", "left")
    )
    return rows.rollup("month_start").agg(
        F.grouping("month_start").cast("int").alias("is_total"),
        F.count("*").alias("months"),
        F.sum(F.coalesce("payloads_seen", F.lit(0))).alias("payloads_seen"),
        F.sum(F.coalesce("new_raw", F.lit(0))).alias("new_raw"),
    )
