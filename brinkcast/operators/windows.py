"""Trailing-window features and window outcomes on the 15-minute grid.

Posts are summed once into panes: one row per grid step, split by whether the
posts lie exactly on the border.  That single table (bounded by the calendar,
not by the posts) serves both kinds of interval: open-left lookbacks
(H - x, H] and outcome windows [start, end).  Each grid time or window then
lists the panes it needs and meets them by equality.
"""

from __future__ import annotations

from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinkcast.functions.scores import had_jump
from brinkcast.functions.times import (
    HOUR,
    MINUTE,
    epoch_micros,
    from_micros,
    micros,
    pane_floor,
)
from brinkcast.operators.ordered import lookback_stats, ts_type

PANE_COLUMNS = (
    "eco_n",
    "eco_sum",
    "primary_n",
    "primary_sum",
    "primary_max",
    "primary_posts",
    "primary_items",
)


def valence_panes(posts: DataFrame, minutes: int = 15) -> DataFrame:
    """Sums per grid step: ``pane`` (start, micros), ``on_edge`` and the measures.

    ``posts`` has ``published_at``, ``is_primary`` and ``valence_level`` (NULL
    when not labelled).  A raw post without an item (NULL ``item_id``, where
    that column is given) is a post but not an item.  Partial sums are formed
    before the shuffle.
    """
    us = micros(F.col("published_at"))
    pane = pane_floor(us, minutes * MINUTE)
    return (
        posts.where(F.col("published_at").isNotNull())
        .groupBy(pane.alias("pane"), (us == pane).alias("on_edge"))
        .agg(*pane_measures(posts))
    )


def pane_measures(posts: DataFrame) -> list[Column]:
    """The additive measures of a pane (and one maximum)."""
    own, level = F.col("is_primary"), F.col("valence_level")
    labelled = level.isNotNull()
    item = F.col("item_id").isNotNull() if "item_id" in posts.columns else F.lit(True)
    return [
        F.count_if(~own & labelled).alias("eco_n"),
        F.coalesce(F.sum(F.when(~own, level.cast("long"))), F.lit(0)).alias("eco_sum"),
        F.count_if(own & labelled).alias("primary_n"),
        F.coalesce(F.sum(F.when(own, level.cast("long"))), F.lit(0)).alias("primary_sum"),
        F.max(F.when(own, level)).cast("int").alias("primary_max"),
        F.count_if(own).alias("primary_posts"),
        F.count_if(own & item).alias("primary_items"),
    ]


def _closing(minutes: int) -> Column:
    """Grid point that closes the pane in (point - step, point]."""
    step = F.lit(minutes * MINUTE)
    return F.when(F.col("on_edge"), F.col("pane")).otherwise(F.col("pane") + step)


def _mean(total: Column, n: Column) -> Column:
    return F.when(n > 0, total.cast("double") / n).otherwise(0.0)


def lookback_from_panes(
    panes: DataFrame,
    spine: DataFrame,
    at: str,
    measures: dict[str, tuple[str, int]],
    minutes: int = 15,
) -> DataFrame:
    """Sums over (at - hours, at] for each distinct ``at`` of the spine.

    ``measures`` maps a result name to (pane column, hours).  The longest
    lookback sets how many panes a grid time lists.
    """
    step = minutes * MINUTE
    longest = max(hours for _, hours in measures.values()) * HOUR // step
    closed = panes.withColumn("pane", _closing(minutes)).groupBy("pane").agg(
        *[F.sum(c).alias(c) for c in sorted({c for c, _ in measures.values()})]
    )
    wanted = (
        spine.select(micros(F.col(at)).alias("at_us")).distinct()
        .select("at_us", F.explode(F.sequence(F.lit(0), F.lit(longest - 1))).alias("age"))
        .select("at_us", "age", (F.col("at_us") - F.col("age").cast("long") * F.lit(step)).alias("pane"))
    )
    aggs = []
    for name, (column, hours) in measures.items():
        recent = F.col("age") < hours * HOUR // step
        aggs.append(F.coalesce(F.sum(F.when(recent, F.col(column))), F.lit(0)).alias(name))
    return (
        wanted.join(closed, "pane", "left").groupBy("at_us").agg(*aggs)
        .withColumn(at, from_micros(F.col("at_us"), ts_type(spine, at)))
        .drop("at_us")
    )


def features_from_panes(panes: DataFrame, spine: DataFrame, minutes: int = 15) -> DataFrame:
    """The five features at each grid time ``h``."""
    sums = lookback_from_panes(
        panes,
        spine,
        "h",
        {
            "eco_sum": ("eco_sum", 6),
            "eco_n": ("eco_n", 6),
            "own_sum": ("primary_sum", 24),
            "own_n": ("primary_n", 24),
            "own_posts": ("primary_posts", 6),
        },
        minutes,
    )
    return sums.select(
        "h",
        _mean(F.col("eco_sum"), F.col("eco_n")).alias("eco_mean_6h"),
        F.col("eco_n").alias("eco_n_6h"),
        _mean(F.col("own_sum"), F.col("own_n")).alias("primary_mean_24h"),
        F.col("own_n").alias("primary_n_24h"),
        F.col("own_posts").alias("primary_posts_6h"),
    )


def features_at(posts: DataFrame, spine: DataFrame, minutes: int = 15) -> DataFrame:
    """Features known at each grid time; only posts up to ``h`` count."""
    return features_from_panes(valence_panes(posts, minutes), spine, minutes)


def ecosystem_stats(posts: DataFrame, spine: DataFrame, hours: int = 6, minutes: int = 15) -> DataFrame:
    """Mean level and count of labelled posts outside the primary source in (h - 6h, h]."""
    return _stats(posts.where("not is_primary"), spine, hours, minutes, "eco")


def primary_stats(posts: DataFrame, spine: DataFrame, hours: int = 24, minutes: int = 15) -> DataFrame:
    """Mean level and count of labelled primary posts in (h - 24h, h]."""
    return _stats(posts.where("is_primary"), spine, hours, minutes, "primary")


def _stats(posts: DataFrame, spine: DataFrame, hours: int, minutes: int, kind: str) -> DataFrame:
    sums = lookback_from_panes(
        valence_panes(posts, minutes),
        spine,
        "h",
        {"s": (f"{kind}_sum", hours), "n": (f"{kind}_n", hours)},
        minutes,
    )
    return sums.select(
        "h",
        _mean(F.col("s"), F.col("n")).alias(f"{kind}_mean_{hours}h"),
        F.col("n").alias(f"{kind}_n_{hours}h"),
    )


def primary_post_count(posts: DataFrame, spine: DataFrame, hours: int = 6, minutes: int = 15) -> DataFrame:
    """Number of primary posts, labelled or not, in (h - 6h, h]."""
    sums = lookback_from_panes(
        valence_panes(posts.where("is_primary"), minutes),
        spine,
        "h",
        {f"primary_posts_{hours}h": ("primary_posts", hours)},
        minutes,
    )
    return sums.select("h", f"primary_posts_{hours}h")


def outcomes_from_panes(
    panes: DataFrame, windows: DataFrame, recent_hours: int = 24, minutes: int = 15
) -> DataFrame:
    """Observed outcome per window: posts and maximum over [start, end), the mean
    of the preceding day over (start - 24h, start], and the jump flag.

    Borders must lie on the grid; windows may differ in length.
    """
    step = minutes * MINUTE
    back = recent_hours * HOUR
    dtype = ts_type(windows, "window_start")
    keys = windows.select(
        micros(F.col("window_start")).alias("ws"), micros(F.col("window_end")).alias("we")
    ).distinct()
    wanted = keys.select(
        "ws",
        "we",
        F.explode(F.sequence(F.col("ws") - F.lit(back), F.col("we") - F.lit(step), F.lit(step))).alias("pane"),
    )
    # A pane table row belongs to the window by its start, and to the preceding
    # day by the grid point that closes it; both are judged in one pass.
    inside = F.col("pane") >= F.col("ws")
    close = _closing(minutes)
    recent = (close > F.col("ws") - F.lit(back)) & (close <= F.col("ws"))
    sums = (
        wanted.join(panes.select("pane", "on_edge", "primary_items", "primary_max", "primary_sum", "primary_n"), "pane", "left")
        .groupBy("ws", "we")
        .agg(
            F.coalesce(F.sum(F.when(inside, F.col("primary_items"))), F.lit(0)).alias("n_posts"),
            F.coalesce(F.max(F.when(inside, F.col("primary_max"))), F.lit(-1)).alias("v_max"),
            F.sum(F.when(recent, F.col("primary_sum"))).alias("s"),
            F.coalesce(F.sum(F.when(recent, F.col("primary_n"))), F.lit(0)).alias("n"),
        )
    )
    return sums.select(
        from_micros(F.col("ws"), dtype).alias("window_start"),
        from_micros(F.col("we"), dtype).alias("window_end"),
        "v_max",
        "n_posts",
        _mean(F.col("s"), F.col("n")).alias("v_recent"),
    ).withColumn("had_jump", had_jump(F.col("n_posts"), F.col("v_max"), F.col("v_recent")))


def window_outcomes(
    posts: DataFrame, windows: DataFrame, recent_hours: int = 24, minutes: int = 15
) -> DataFrame:
    """Outcomes straight from posts; see :func:`outcomes_from_panes`."""
    return outcomes_from_panes(
        valence_panes(posts.where("is_primary"), minutes), windows, recent_hours, minutes
    )


def ecosystem_at(windows: DataFrame, posts: DataFrame, hours: int = 6) -> DataFrame:
    """Windows with the ecosystem mean and count in (start - hours, start].

    Starts may be any times, on the grid or not.
    """
    eco = posts.where(~F.col("is_primary") & F.col("valence_level").isNotNull())
    stats = lookback_stats(
        windows, "window_start", eco, "published_at", "valence_level", hours,
        f"eco_mean_{hours}h", f"eco_n_{hours}h",
    )
    return windows.join(stats, "window_start")


def ecosystem_from_panes(
    windows: DataFrame, panes: DataFrame, hours: int = 6, minutes: int = 15
) -> DataFrame:
    """The same for windows that start on the grid, from a pane table."""
    sums = lookback_from_panes(
        panes, windows, "window_start", {"s": ("eco_sum", hours), "n": ("eco_n", hours)}, minutes
    ).select(
        "window_start",
        _mean(F.col("s"), F.col("n")).alias(f"eco_mean_{hours}h"),
        F.col("n").alias(f"eco_n_{hours}h"),
    )
    return windows.join(sums, "window_start")


def rolling_mean(
    values: DataFrame, cutoffs: DataFrame, hours: float, ts: str = "published_at",
    value: str = "valence_level", at: str = "cutoff",
) -> DataFrame:
    """Mean of values in (cutoff - hours, cutoff]; 0 when there is none."""
    return lookback_stats(cutoffs, at, values, ts, value, hours, "rolling_mean", "n")


def tumbling_labels(
    posts: DataFrame,
    start,
    end,
    window_hours: int = 2,
    recent_hours: int = 24,
) -> DataFrame:
    """Labels of back-to-back windows from ``start`` while they end by ``end``.

    Maximum (-1 if none) and count over the window, mean level over the half-open
    preceding hours [start - recent, start), posts without a level left out; no row at
    all without posts.
    ``posts`` has ``published_at`` and ``valence``.
    """
    lo, hi = epoch_micros(start), epoch_micros(end)
    width = window_hours * HOUR
    step = gcd(window_hours, recent_hours) * HOUR
    dtype = ts_type(posts, "published_at")
    us = micros(F.col("published_at"))
    panes = posts.groupBy(pane_floor(us, step, lo).alias("pane")).agg(
        F.count("*").alias("n"),
        F.count("valence").alias("labelled"),
        F.sum(F.col("valence").cast("long")).alias("s"),
        F.max("valence").alias("top"),
    )
    count = max(0, (hi - lo) // width)
    spine = posts.sparkSession.range(count).select((F.lit(lo) + F.col("id") * width).alias("ws"))
    some = posts.select(F.lit(0).alias("k")).limit(1)
    spine = spine.withColumn("k", F.lit(0)).join(some, "k", "left_semi").drop("k")
    before, inside = recent_hours * HOUR // step, width // step
    ages = F.explode(F.sequence(F.lit(-before), F.lit(inside - 1)))
    wanted = spine.select("ws", ages.alias("age")).select(
        "ws", "age", (F.col("ws") + F.col("age").cast("long") * F.lit(step)).alias("pane")
    )
    past, current = F.col("age") < 0, F.col("age") >= 0
    out = wanted.join(panes, "pane", "left").groupBy("ws").agg(
        F.coalesce(F.max(F.when(current, F.col("top"))), F.lit(-1)).alias("v_max"),
        F.coalesce(F.sum(F.when(current, F.col("n"))), F.lit(0)).alias("n_posts"),
        F.sum(F.when(past, F.col("s"))).alias("s"),
        F.coalesce(F.sum(F.when(past, F.col("labelled"))), F.lit(0)).alias("rn"),
    )
    return out.select(
        from_micros(F.col("ws"), dtype).alias("window_start"),
        from_micros(F.col("ws") + width, dtype).alias("window_end"),
        "v_max",
        _mean(F.col("s"), F.col("rn")).alias("v_recent"),
        "n_posts",
    )
