"""Further feature families on the same grid: statistics over several lookbacks,
trend, decay, text markers, entities, gaps between posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brinkcast.functions.times import HOUR, MINUTE, from_micros, micros, pane_ceil, time_literal
from brinkcast.operators.annotations import items_with_latest
from brinkcast.operators.ordered import last_at_or_before, lookback_stats, stored, ts_type
from brinkcast.operators.windows import features_at

SPANS = (1, 6, 24)


def _wanted(spine: DataFrame, at: str, hours: int, step: int) -> DataFrame:
    """Each grid time with the closing points of the panes in its lookback."""
    ages = F.explode(F.sequence(F.lit(0), F.lit(hours * HOUR // step - 1)))
    return spine.select(micros(F.col(at)).alias("at_us")).distinct().select("at_us", ages.alias("age")).select(
        "at_us", "age", (F.col("at_us") - F.col("age").cast("long") * F.lit(step)).alias("pane")
    )


def level_statistics(
    posts: DataFrame, spine: DataFrame, spans: tuple[int, ...] = SPANS, minutes: int = 15
) -> DataFrame:
    """Count, mean, maximum and deviation of levels in (h - span, h] for each span,
    the slope of level against hours, and the difference of the slopes over the
    second and the longest span (acceleration).

    Sums of t and t*t are kept relative to the pane's closing point and moved to
    ``h`` by the pane's age, so they stay small numbers.
    """
    step = minutes * MINUTE
    us = micros(F.col("published_at"))
    close = pane_ceil(us, step)
    t = (us - close).cast("double") / HOUR
    y = F.col("valence_level").cast("double")
    panes = posts.where(F.col("valence_level").isNotNull()).groupBy(close.alias("pane")).agg(
        F.count("*").cast("double").alias("n"),
        F.sum(y).alias("s"),
        F.sum(y * y).alias("ss"),
        F.max("valence_level").alias("top"),
        F.sum(t).alias("t"),
        F.sum(t * t).alias("tt"),
        F.sum(t * y).alias("ty"),
    )
    rows = _wanted(spine, "h", max(spans), step).join(panes, "pane", "left")
    shift = F.col("age") * F.lit(-float(step) / HOUR)
    moved = {
        "mt": F.col("t") + shift * F.col("n"),
        "mtt": F.col("tt") + F.lit(2.0) * shift * F.col("t") + shift * shift * F.col("n"),
        "mty": F.col("ty") + shift * F.col("s"),
    }
    rows = rows.withColumns(moved)
    aggs: list[Column] = []
    for span in spans:
        near = F.col("age") < span * HOUR // step
        for c in ("n", "s", "ss", "mt", "mtt", "mty"):
            aggs.append(F.coalesce(F.sum(F.when(near, F.col(c))), F.lit(0.0)).alias(f"{c}_{span}"))
        aggs.append(F.max(F.when(near, F.col("top"))).alias(f"top_{span}"))
    sums = rows.groupBy("at_us").agg(*aggs)
    out: list[Column] = [from_micros(F.col("at_us"), ts_type(spine, "h")).alias("h")]

    def slope(span: int) -> Column:
        n, s, mt = F.col(f"n_{span}"), F.col(f"s_{span}"), F.col(f"mt_{span}")
        spread = n * F.col(f"mtt_{span}") - mt * mt
        return F.when((n > 1) & (spread > 0), (n * F.col(f"mty_{span}") - mt * s) / spread)

    for span in spans:
        n, mean = F.col(f"n_{span}"), F.col(f"s_{span}") / F.col(f"n_{span}")
        spread = F.greatest(F.col(f"ss_{span}") / n - mean * mean, F.lit(0.0))
        out += [
            n.cast("long").alias(f"n_{span}h"),
            F.when(n > 0, mean).otherwise(0.0).alias(f"mean_{span}h"),
            F.coalesce(F.col(f"top_{span}"), F.lit(-1)).alias(f"max_{span}h"),
            F.when(n > 0, F.sqrt(spread)).otherwise(0.0).alias(f"std_{span}h"),
        ]
    second, longest = sorted(spans)[-2:]
    out += [
        slope(second).alias(f"slope_{second}h"),
        (slope(second) - slope(longest)).alias("acceleration"),
    ]
    return sums.select(*out)


def calendar_features(spine: DataFrame, primary: DataFrame) -> DataFrame:
    """Hour, weekday (Monday 1) and minutes since the last primary post at ``h``."""
    last = last_at_or_before(spine, "h", primary.select("published_at"), "published_at", ["published_at"], "last_post")
    return last.select(
        "h",
        F.hour("h").alias("hour"),
        (F.weekday("h") + 1).alias("weekday"),
        ((micros(F.col("h")) - micros(F.col("last_post"))).cast("double") / MINUTE).alias("minutes_since_post"),
    )


def decayed_mean(
    posts: DataFrame, spine: DataFrame, half_life: float = 2.0, hours: int = 6, minutes: int = 15
) -> DataFrame:
    """Mean level in (h - hours, h], each post weighted by half per ``half_life``
    hours of age; 0 without posts."""
    step = minutes * MINUTE
    us = micros(F.col("published_at"))
    close = pane_ceil(us, step)
    rate = F.lit(0.6931471805599453 / half_life)
    w = F.exp(rate * ((us - close).cast("double") / HOUR))
    panes = posts.where(F.col("valence_level").isNotNull()).groupBy(close.alias("pane")).agg(
        F.sum(w).alias("w"), F.sum(w * F.col("valence_level")).alias("wy")
    )
    rows = _wanted(spine, "h", hours, step).join(panes, "pane", "left")
    aged = F.exp(-rate * F.col("age") * F.lit(float(step) / HOUR))
    sums = rows.groupBy("at_us").agg(F.sum(aged * F.col("w")).alias("w"), F.sum(aged * F.col("wy")).alias("wy"))
    return sums.select(
        from_micros(F.col("at_us"), ts_type(spine, "h")).alias("h"),
        F.when(F.col("w") > 0, F.col("wy") / F.col("w")).otherwise(0.0).alias("decayed_mean"),
    )


def text_markers_at(posts: DataFrame, spine: DataFrame, measures: list[str], hours: int = 6, minutes: int = 15) -> DataFrame:
    """Mean of per-post text measures (columns of ``posts``) in (h - hours, h]."""
    step = minutes * MINUTE
    panes = posts.groupBy(pane_ceil(micros(F.col("published_at")), step).alias("pane")).agg(
        F.count("*").alias("n"), *[F.sum(m).alias(m) for m in measures]
    )
    sums = _wanted(spine, "h", hours, step).join(panes, "pane", "left").groupBy("at_us").agg(
        F.sum("n").alias("n"), *[F.sum(m).alias(m) for m in measures]
    )
    return sums.select(
        from_micros(F.col("at_us"), ts_type(spine, "h")).alias("h"),
        *[F.when(F.col("n") > 0, F.col(m) / F.col("n")).otherwise(0.0).alias(f"{m}_{hours}h") for m in measures],
    )


def _counted(mentions: DataFrame, key: list[str], spine: DataFrame, spans: tuple[int, ...], minutes: int) -> DataFrame:
    """Counts per key at each grid time, from panes; times without a mention have no row."""
    step = minutes * MINUTE
    panes = mentions.groupBy(pane_ceil(micros(F.col("published_at")), step).alias("pane"), *key).agg(
        F.count("*").alias("n")
    )
    ages = F.explode(F.sequence(F.lit(0), F.lit(max(spans) * HOUR // step - 1))).alias("age")
    rows = panes.select("*", ages).withColumn("at_us", F.col("pane") + F.col("age").cast("long") * F.lit(step))
    counts = rows.groupBy("at_us", *key).agg(
        *[F.sum(F.when(F.col("age") < s * HOUR // step, F.col("n")).otherwise(0)).alias(f"n_{s}h") for s in spans]
    )
    grid = spine.select("h", micros(F.col("h")).alias("at_us"))
    return grid.join(counts, "at_us").drop("at_us")


def entity_counts(posts: DataFrame, spine: DataFrame, spans: tuple[int, ...] = (6, 24), minutes: int = 15) -> DataFrame:
    """Posts naming each entity in (h - span, h]; ``posts`` has an ``entities`` array."""
    mentions = posts.select("published_at", F.explode("entities").alias("entity"))
    return _counted(mentions, ["entity"], spine, spans, minutes)


def entity_pairs(posts: DataFrame, spine: DataFrame, spans: tuple[int, ...] = (6, 24), minutes: int = 15) -> DataFrame:
    """Posts naming two entities together.  Pairs arise within one post's own list of
    watched entities, which the caller's dictionary bounds."""
    pairs = F.flatten(
        F.transform(
            "entities",
            lambda a: F.transform(
                F.filter("entities", lambda b: b > a), lambda b: F.struct(a.alias("entity_a"), b.alias("entity_b"))
            ),
        )
    )
    mentions = posts.select("published_at", F.explode(pairs).alias("p")).select("published_at", "p.*")
    return _counted(mentions, ["entity_a", "entity_b"], spine, spans, minutes)


def post_gaps(primary: DataFrame) -> DataFrame:
    """Distinct post times with the time since the one before, in microseconds and
    minutes (NULL for the first)."""
    times = primary.select("published_at").where(F.col("published_at").isNotNull()).distinct()
    just_before = times.select((F.col("published_at") - F.expr("interval 1 microsecond")).alias("at"))
    prev = last_at_or_before(just_before, "at", times, "published_at", ["published_at"], "previous")
    own = F.col("at") + F.expr("interval 1 microsecond")
    gap = micros(own) - micros(F.col("previous"))
    return prev.select(
        own.alias("published_at"), gap.alias("gap_us"), (gap.cast("double") / MINUTE).alias("gap_minutes")
    )


def hazard_rows(primary: DataFrame, spine: DataFrame, hours: int = 2) -> DataFrame:
    """Discrete-time rows for the presence target: minutes since the last post, mean
    gap and posts of the last day, and whether a post follows in [h, h + hours)."""
    primary = stored(primary.select("published_at").where(F.col("published_at").isNotNull()).distinct())
    gaps = post_gaps(primary).where(F.col("gap_us").isNotNull())
    recent = lookback_stats(spine, "h", gaps, "published_at", "gap_us", 24, "mean_gap_24h", "n_gaps_24h")
    recent = recent.withColumn("mean_gap_24h", F.col("mean_gap_24h") / MINUTE)
    since = calendar_features(spine, primary)
    # Posts in [h, h + hours) are those in (h - 1us, h + hours - 1us].
    edge = F.expr("interval 1 microsecond")
    ends = spine.select((F.col("h") + F.make_dt_interval(hours=F.lit(hours)) - edge).alias("end"))
    ahead = lookback_stats(ends, "end", primary.withColumn("one", F.lit(1)), "published_at", "one", hours, "m", "n_ahead")
    ahead = ahead.select((F.col("end") - F.make_dt_interval(hours=F.lit(hours)) + edge).alias("h"), "n_ahead")
    return since.join(recent, "h").join(ahead, "h").select(
        "h", "minutes_since_post", "mean_gap_24h", "n_gaps_24h", (F.col("n_ahead") > 0).cast("int").alias("label")
    )


def features_as_of(
    raw: DataFrame, items: DataFrame, sources: DataFrame, ann: DataFrame, h, spine: DataFrame
) -> DataFrame:
    """Features from the state of the tables at time ``h``: rows captured and labels
    given by then.  A stored feature row must come out again."""
    at = time_literal(h, ts_type(raw, "captured_at"))
    posts = items_with_latest(
        raw.where(F.col("captured_at") <= at), items, sources, ann.where(F.col("annotated_at") <= at)
    )
    return features_at(posts, spine)


def not_reproduced(stored: DataFrame, again: DataFrame) -> DataFrame:
    """Stored rows that the recomputation does not give, and the other way round."""
    cols = stored.columns
    again = again.select(*cols)
    return (
        stored.exceptAll(again).withColumn("side", F.lit("stored"))
        .unionByName(again.exceptAll(stored).withColumn("side", F.lit("again")))
    )
