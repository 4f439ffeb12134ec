"""Grid and calendar arithmetic.

Times are UTC.  Boundaries are computed on epoch microseconds with ``pmod``:
integers throughout, so a post exactly on a boundary lands on the right side.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MINUTE = 60_000_000
HOUR = 60 * MINUTE
DAY = 24 * HOUR


def micros(ts: Column) -> Column:
    """Epoch microseconds of a timestamp, with or without zone."""
    return F.unix_micros(ts.cast("timestamp"))


def from_micros(us: Column, dtype: str = "timestamp_ntz") -> Column:
    """The timestamp of epoch microseconds, in the wanted timestamp type."""
    return F.timestamp_micros(us).cast(dtype)


def pane_floor(us: Column, step: int, anchor: int = 0) -> Column:
    """Largest grid point at or before the time."""
    return us - F.pmod(us - F.lit(anchor), F.lit(step))


def pane_ceil(us: Column, step: int, anchor: int = 0) -> Column:
    """Smallest grid point at or after the time."""
    return us + F.pmod(F.lit(anchor) - us, F.lit(step))


def _span(us: Column) -> Column:
    """A day-time interval of that many microseconds."""
    return F.make_dt_interval(secs=(us / F.lit(1_000_000)).cast("decimal(18,6)"))


def floor_to_grid(ts: Column, minutes: int = 15) -> Column:
    """Floor to the UTC grid; the timestamp type is kept."""
    return ts - _span(F.pmod(micros(ts), F.lit(minutes * MINUTE)))


def prediction_window(ts: Column, hours: int = 2, minutes: int = 15) -> tuple[Column, Column]:
    """Start and end of the window a forecast made at ``ts`` covers."""
    start = floor_to_grid(ts, minutes)
    return start, start + F.make_dt_interval(hours=F.lit(hours))


def month_bounds(day: Column) -> tuple[Column, Column]:
    """First and last day of the month."""
    return F.trunc(day, "MM"), F.last_day(day)


def epoch_micros(t: datetime | str) -> int:
    """Epoch microseconds of a Python time; a naive one is UTC."""
    if isinstance(t, str):
        t = datetime.fromisoformat(t)
    if t.tzinfo is None:
        t = t.replace(tzinfo=timezone.utc)
    delta = t - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (delta.days * 86_400 + delta.seconds) * 1_000_000 + delta.microseconds


def from_epoch(us: int) -> datetime:
    """The UTC time of epoch microseconds."""
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=us)


def time_literal(t: datetime | str, dtype: str = "timestamp_ntz") -> Column:
    return from_micros(F.lit(epoch_micros(t)), dtype)


def grid_spine(
    spark: SparkSession,
    start: datetime | str,
    end: datetime | str,
    minutes: int = 15,
    name: str = "h",
    dtype: str = "timestamp_ntz",
) -> DataFrame:
    """Every grid point in [start, end], generated on the executors."""
    step = minutes * MINUTE
    lo, hi = epoch_micros(start), epoch_micros(end)
    first = lo + (-lo) % step
    n = max(0, (hi - first) // step + 1)
    return spark.range(n).select(from_micros(F.lit(first) + F.col("id") * step, dtype).alias(name))


def window_spine(
    spark: SparkSession,
    start: datetime | str,
    end: datetime | str,
    hours: int = 2,
    minutes: int = 15,
    dtype: str = "timestamp_ntz",
) -> DataFrame:
    """Every window whose start lies on the grid in [start, end]."""
    return grid_spine(spark, start, end, minutes, "window_start", dtype).withColumn(
        "window_end", F.col("window_start") + F.make_dt_interval(hours=F.lit(hours))
    )


# Zone names of RFC 822.
ZONES = {
    "EST": "-0500",
    "EDT": "-0400",
    "CST": "-0600",
    "CDT": "-0500",
    "MST": "-0700",
    "MDT": "-0600",
    "PST": "-0800",
    "PDT": "-0700",
}


def parse_feed_time(raw: Column, fallback: Column) -> Column:
    """RFC 822 or ISO text to a UTC timestamp; unreadable gives ``fallback``.

    The weekday is dropped first (Spark's parser rejects it), zone names used
    by feeds become offsets, years of two digits lie in 1969 to 2068, and a text
    without a zone counts as UTC.
    """
    text = F.regexp_replace(F.trim(raw), r"^[A-Za-z]+,\s*", "")
    text = F.regexp_replace(text, r"\s+(GMT|UTC|UT|Z)$", " +0000")
    for name, offset in ZONES.items():
        text = F.regexp_replace(text, rf"\s+{name}$", f" {offset}")
    for years, century in (("[0-5][0-9]|6[0-8]", "20"), ("69|[7-9][0-9]", "19")):
        text = F.regexp_replace(text, rf"^(\d+ [A-Za-z]{{3}}) ({years})(?= )", f"$1 {century}$2")
    zoned = F.coalesce(
        F.try_to_timestamp(text, F.lit("d MMM yyyy H:mm:ss Z")),
        F.try_to_timestamp(text, F.lit("d MMM yyyy H:mm Z")),
    )
    naive = F.try_to_timestamp(F.concat(text, F.lit(" +0000")), F.lit("d MMM yyyy H:mm:ss Z"))
    iso = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))
    return F.coalesce(zoned, naive, iso, fallback.cast("timestamp"))
