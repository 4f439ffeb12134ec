"""Order-dependent sums, ranks and quantiles that never put a whole group in one task.

A plain window function over a few large groups, or over none, sends each group
to a single task.  Here rows are cut into ranges of their total order first
(``ranged``: a group gets as many ranges as its rows need): each range is worked on
by itself, and what a range needs from those before it comes from a table of
at most two rows a range.  The results do not depend on where the ranges end.

Ranges are stored, as later passes must meet the same ones; so is what is costly to
derive (reduced to one row per distinct value first): the input is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brinkcast.functions.times import DAY, HOUR, from_micros, micros, pane_floor
from brinkcast.session import ensure_checkpoint_dir

SECOND = 1_000_000

def ts_type(df: DataFrame, column: str) -> str:
    """``timestamp`` or ``timestamp_ntz``: results keep the caller's type."""
    return df.schema[column].dataType.simpleString()


def stored(df: DataFrame) -> DataFrame:
    """Checkpoint: later passes read the rows back instead of deriving them again."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def ranged(df: DataFrame, order: list[Column], parts: int | None = None) -> DataFrame:
    """Stored ``df`` in ranges of ``order``; ``_part`` numbers them in that order.

    By default the session's shuffle partitions, small neighbours joined by
    adaptive execution.
    """
    cut = df.repartitionByRange(parts, *order) if parts else df.repartitionByRange(*order)
    return stored(cut.withColumn("_part", F.spark_partition_id()))


def _carried(rows: DataFrame, carried: DataFrame, key: list[str]) -> DataFrame:
    """``rows`` with what ``carried`` says of their range (left join, NULL keys included).

    Groups that cross ranges have at most two rows a range: small enough to send.
    """
    named = carried.select(*[F.col(c).alias(f"_key_{c}") for c in key], *[c for c in carried.columns if c not in key])
    same = [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in key]
    return rows.join(F.broadcast(named), same, "left")


def running_totals(
    df: DataFrame,
    by: list[str],
    order: str,
    sums: list[str],
    descending: bool = False,
    bounded: bool = False,
    parts: int | None = None,
) -> DataFrame:
    """Running sums along ``order`` within ``by``: adds ``cum_*`` and ``total_*``.

    ``df`` holds one row per (by, order): aggregate before calling.  Rows without
    ``order`` are left out.  ``bounded``: each group is known to be small (the calendar
    bounds it), so a plain window is enough and nothing is stored.
    """
    along = F.col(order).desc() if descending else F.col(order).asc()
    rows = df.where(F.col(order).isNotNull())
    if not bounded:
        rows = ranged(rows, [*[F.col(c).asc() for c in by], along], parts)
    key = by if bounded else ["_part", *by]
    upto = W.partitionBy(*key).orderBy(along).rowsBetween(W.unboundedPreceding, 0)
    local = rows.select(
        "*",
        *[F.sum(s).over(upto).alias(f"cum_{s}") for s in sums],
        *[F.sum(s).over(W.partitionBy(*key)).alias(f"total_{s}") for s in sums],
    )
    if bounded:
        return local
    group = W.partitionBy(*by)
    before = group.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    pieces = rows.groupBy(*key).agg(*[F.sum(s).alias(s) for s in sums])
    crossing = pieces.select(
        *key,
        F.count("*").over(group).alias("_pieces"),
        *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"_before_{s}") for s in sums],
        *[F.sum(s).over(group).alias(f"_all_{s}") for s in sums],
    ).where("_pieces > 1")
    return _carried(local, crossing, key).select(
        *df.columns,
        *[(F.col(f"cum_{s}") + F.coalesce(f"_before_{s}", F.lit(0))).alias(f"cum_{s}") for s in sums],
        *[F.coalesce(f"_all_{s}", f"total_{s}").alias(f"total_{s}") for s in sums],
    )


def time_rank(
    df: DataFrame, ts: str, tie: list[str], rank: str = "rank", total: str = "n_total", parts: int | None = None
) -> DataFrame:
    """Position (from 1) in time order over all rows, and the number of rows.

    Rows without a time are left out of both.
    """
    order = [F.col(c).asc() for c in (ts, *tie)]
    rows = ranged(df.where(F.col(ts).isNotNull()), order, parts)
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(W.partitionBy()).alias(total),
    )
    local = rows.withColumn("_pos", F.row_number().over(W.partitionBy("_part").orderBy(*order)))
    return _carried(local, sizes, ["_part"]).select(*df.columns, (F.col("_pos") + F.col("_before")).alias(rank), total)


def previous_value(
    df: DataFrame, ts: str, tie: list[str], value: str, name: str, parts: int | None = None
) -> DataFrame:
    """``value`` of the row just before in time order over all rows; NULL for the first.

    Rows without a time are left out.
    """
    order = [F.col(c).asc() for c in (ts, *tie)]
    rows = ranged(df.where(F.col(ts).isNotNull()), order, parts)
    last = rows.groupBy("_part").agg(F.max_by(value, F.struct(ts, *tie)).alias("_last"))
    last = last.select("_part", F.lag("_last").over(W.orderBy("_part")).alias("_carry"))
    local = W.partitionBy("_part").orderBy(*order)
    rows = rows.withColumn("_pos", F.row_number().over(local)).withColumn("_prev", F.lag(value).over(local))
    return _carried(rows, last, ["_part"]).select(
        *df.columns,
        F.when(F.col("_pos") == 1, F.col("_carry")).otherwise(F.col("_prev")).alias(name),
    )


def lookback_stats(
    points: DataFrame,
    at: str,
    values: DataFrame,
    ts: str,
    value: str,
    hours: float,
    mean: str = "mean",
    n: str = "n",
) -> DataFrame:
    """Mean and count of values in (at - hours, at], for arbitrary times.

    An interval is put together from five parts, which are only ever added, so a
    large value outside leaves no trace, whatever the type: the rest of the second
    in which it begins, the rest of that second's block, the whole blocks between, what its last
    block holds before the last second, and the last second up to ``at``.  Blocks
    are a quarter of the interval, a week at most.

    Values are first summed per microsecond.  A task holds one second (at most a
    million distinct times) or the seconds of one block; no value meets every
    point of its interval.  Returns one row per distinct ``at``; no value gives 0
    and 0, NULL times give no row.
    """
    dtype = ts_type(points, at)
    width = int(hours * HOUR)
    unit = SECOND if width >= SECOND else 1
    block = max(1, min(width // 4, 7 * DAY) // unit) * unit
    own = (
        values.where(F.col(value).isNotNull() & F.col(ts).isNotNull())
        .groupBy(micros(F.col(ts)).alias("us"))
        .agg(F.count("*").alias("n"), F.sum(value).alias("s"))
        .select("us", F.lit(None).cast("long").alias("at_us"), F.lit(None).cast("boolean").alias("ends"), "n", "s")
    )
    stype = own.schema["s"].dataType
    probes = (
        points.select(micros(F.col(at)).alias("at_us")).where("at_us is not null").distinct()
        .select("at_us", F.explode(F.array(F.lit(True), F.lit(False))).alias("ends"))
        .select(
            F.when(F.col("ends"), F.col("at_us")).otherwise(F.col("at_us") - width).alias("us"),
            "at_us",
            "ends",
            F.lit(0).cast("long").alias("n"),
            F.lit(None).cast(stype).alias("s"),
        )
    )
    rows = stored(own.unionByName(probes).withColumn("sec", pane_floor(F.col("us"), unit)).repartition("sec"))

    in_second = W.partitionBy("sec").orderBy("us")
    upto, after = in_second.rangeBetween(W.unboundedPreceding, 0), in_second.rangeBetween(1, W.unboundedFollowing)
    local = rows.select(
        "sec",
        "at_us",
        "ends",
        *[F.when(F.col("ends"), F.sum(c).over(upto)).otherwise(F.sum(c).over(after)).alias(f"{c}_near") for c in ("n", "s")],
    ).where("at_us is not null")

    secs = rows.groupBy("sec").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    secs = secs.withColumn("block", pane_floor(F.col("sec"), block))
    in_block = W.partitionBy("block").orderBy("sec")
    earlier, later = in_block.rowsBetween(W.unboundedPreceding, -1), in_block.rowsBetween(1, W.unboundedFollowing)
    beside = secs.select(
        "sec",
        "block",
        *[F.sum(c).over(earlier).alias(f"{c}_before") for c in ("n", "s")],
        *[F.sum(c).over(later).alias(f"{c}_after") for c in ("n", "s")],
    )
    # An interval that ends in a block began ``back`` blocks before it or one more.
    back = width // block
    blocks = secs.groupBy("block").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).where("n > 0")
    ahead = blocks.select("n", "s", "block", F.explode(F.sequence(F.lit(1), F.lit(back))).alias("age"))
    between = ahead.groupBy((F.col("block") + F.col("age").cast("long") * block).alias("block")).agg(
        *[F.sum(F.when(F.col("age") < back, F.col(c))).alias(f"{c}_short") for c in ("n", "s")],
        *[F.sum(c).alias(f"{c}_long") for c in ("n", "s")],
    )
    beside = beside.join(between, "block", "left").drop("block")
    shorter = F.col("at_us") - pane_floor(F.col("at_us"), block) >= width - back * block

    def ended(c: str) -> Column:
        whole = F.when(shorter, F.col(f"{c}_short")).otherwise(F.col(f"{c}_long"))
        return _added(_added(F.col(f"{c}_near"), F.col(f"{c}_before")), whole)

    ends = local.join(beside, "sec").select(
        "at_us",
        *[F.when(F.col("ends"), ended(c)).otherwise(_added(F.col(f"{c}_near"), F.col(f"{c}_after"))).alias(c) for c in ("n", "s")],
    )
    out = ends.groupBy("at_us").agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias(n), F.sum("s").cast("double").alias("_s")
    )
    return out.select(
        from_micros(F.col("at_us"), dtype).alias(at),
        F.when(F.col(n) > 0, F.col("_s") / F.col(n)).otherwise(0.0).alias(mean),
        n,
    )


def _added(a: Column, b: Column) -> Column:
    """``a + b`` where either may be missing."""
    return F.coalesce(a + b, a, b)


def last_at_or_before(
    points: DataFrame, at: str, values: DataFrame, ts: str, payload: list[str], found: str = "last_at"
) -> DataFrame:
    """The newest value at or before each distinct time, with its own time.

    Values sharing a time count once (the largest payload).  Looked up within a
    second; what a second lacks is carried from the seconds before it in the
    day, and from the days before.
    """
    dtype = ts_type(points, at)
    own = values.where(F.col(ts).isNotNull()).select(micros(F.col(ts)).alias("us"), F.struct(*payload).alias("p"))
    own = own.groupBy("us").agg(F.max("p").alias("p")).select("us", F.lit(0).alias("kind"), F.struct("us", "p").alias("v"))
    probes = points.select(micros(F.col(at)).alias("us")).distinct().select(
        "us", F.lit(1).alias("kind"), F.lit(None).cast(own.schema["v"].dataType).alias("v")
    )
    rows = stored(own.unionByName(probes).withColumn("sec", pane_floor(F.col("us"), SECOND)))
    upto = W.partitionBy("sec").orderBy("us", "kind").rowsBetween(W.unboundedPreceding, 0)
    local = rows.withColumn("here", F.last("v", ignorenulls=True).over(upto)).where("kind = 1")
    secs = rows.groupBy("sec").agg(F.max("v").alias("v")).withColumn("day", pane_floor(F.col("sec"), DAY))
    earlier = W.partitionBy("day").orderBy("sec").rowsBetween(W.unboundedPreceding, -1)
    by_sec = secs.select("sec", "day", F.last("v", ignorenulls=True).over(earlier).alias("in_day"))
    days = secs.groupBy("day").agg(F.max("v").alias("v"))
    before = W.orderBy("day").rowsBetween(W.unboundedPreceding, -1)
    by_day = days.select("day", F.last("v", ignorenulls=True).over(before).alias("carried"))
    hit = F.coalesce("here", "in_day", "carried")
    return local.join(by_sec, "sec").join(by_day, "day").select(
        from_micros(F.col("us"), dtype).alias(at),
        from_micros(hit["us"], dtype).alias(found),
        *[hit["p"][c].alias(c) for c in payload],
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: list[float],
    by: list[str] | None = None,
    name: str = "quantiles",
    parts: int | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles per group, exact, as one array per group.

    Distinct values are counted, ranked through running totals, and each wanted
    rank picks its value; no group's values are gathered in one place.
    """
    by = by or []
    clean = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("x"))
    counts = stored(clean.groupBy(*by, "x").agg(F.count("*").alias("n")))
    return quantiles_of_counts(counts, "x", probs, by, name, parts)


def quantiles_of_counts(
    counts: DataFrame,
    value: str,
    probs: list[float],
    by: list[str] | None = None,
    name: str = "quantiles",
    parts: int | None = None,
) -> DataFrame:
    """The same from distinct values with their count ``n``; ``counts`` is read twice
    (to find the ranges, to cut them): give a stored one."""
    by = by or []
    ranked = running_totals(counts, by, value, ["n"], parts=parts)

    def pick(rank):
        hit = (F.col("cum_n") - F.col("n") <= rank) & (rank < F.col("cum_n"))
        return F.max(F.when(hit, F.col(value)))

    aggs = [F.max("total_n").alias("_n")]
    for i, q in enumerate(probs):
        pos = (F.col("total_n") - 1) * F.lit(float(q))
        aggs += [pick(F.floor(pos)).alias(f"_lo{i}"), pick(F.ceil(pos)).alias(f"_hi{i}")]
    found = ranked.groupBy(*by).agg(*aggs)
    cells = []
    for i, q in enumerate(probs):
        pos = (F.col("_n") - 1) * F.lit(float(q))
        frac = pos - F.floor(pos)
        cells.append(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * frac)
    return found.select(*by, F.array(*cells).alias(name), F.col("_n").alias("n"))
