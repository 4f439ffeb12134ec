"""Continuous panes, features and outcomes.

One stateful aggregation: fifteen-minute panes, emitted once when the watermark
has passed them.  Its state is a few open panes, whatever the lookback.  Closed
panes are stored; features and outcomes are read off the stored panes in the
same micro-batch.  A post that comes after its pane has closed is dropped by the
watermark, so a written outcome never changes.

What has closed is judged by event time, not by the newest pane that has posts: the
watermark a micro-batch runs under follows from the progress of those before it and
is stored (table ``progress``, one row a grid step at most).  So a quiet stretch
closes with the next post, wherever that is.  Where no post comes at all, event time
stands still; ``close_until`` then takes the caller's word.
"""

from __future__ import annotations

from datetime import datetime
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brinkcast.functions.keys import observed_json
from brinkcast.functions.times import (
    DAY,
    HOUR,
    MINUTE,
    from_epoch,
    grid_spine,
    micros,
)
from brinkcast.operators.predictions import MODEL_VERSION, prediction_rows
from brinkcast.operators.windows import (
    features_from_panes,
    outcomes_from_panes,
    pane_measures,
)
from brinkcast.operators.writes import insert_absent, new_outcomes, new_predictions
from brinkcast.sources.tables import TableStore


def streaming_panes(posts: DataFrame, delay: str = "0 seconds", minutes: int = 15) -> DataFrame:
    """Closed panes of a stream of labelled posts (append mode)."""
    pane = F.window("published_at", f"{minutes} minutes")
    us = micros(F.col("published_at"))
    on_edge = F.pmod(us, F.lit(minutes * MINUTE)) == 0
    return (
        posts.withWatermark("published_at", delay)
        .groupBy(pane.alias("w"), on_edge.alias("on_edge"))
        .agg(*pane_measures(posts))
        .withColumn("pane", micros(F.col("w.start")))
        .drop("w")
    )


def _bounds(df: DataFrame, column) -> tuple[int | None, int | None]:
    row = df.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    return row["lo"], row["hi"]


def _micros_of(moment: str) -> int:
    """Micros of a time as progress reports it (whole milliseconds, UTC)."""
    return round(datetime.fromisoformat(moment.replace("Z", "+00:00")).timestamp() * 1000) * 1000


def _delay(spark: SparkSession, delay: str) -> int:
    return spark.sql(f"select unix_micros(timestamp_micros(0) + interval {delay}) as us").first()["us"]


def reached(query: StreamingQuery | None, delay: int) -> int | None:
    """The watermark that the present micro-batch runs under: the newest event time of
    the batches before, less the delay (micros)."""
    marks = [0]
    for progress in query.recentProgress if query is not None else ():
        times = progress["eventTime"] or {}
        marks += [_micros_of(times["watermark"])] if "watermark" in times else []
        marks += [_micros_of(times["max"]) - delay] if "max" in times else []
    return max(marks) or None


def _advance(store: TableStore, mark: int | None, step: int) -> None:
    """Store a watermark that has passed a grid step."""
    if mark is None:
        return
    mark -= mark % step
    known = _bounds(store.read("progress"), F.col("watermark"))[1]
    if known is None or mark > known:
        store.append("progress", store.spark.createDataFrame([(mark,)], "watermark long"))


def closed_starts(store: TableStore, stored: DataFrame, step: int, lag: int) -> tuple[int, DataFrame] | None:
    """Grid starts with closed panes that ``stored`` lacks, with the first of them.

    The grid is bounded by the calendar.  What is missing is found by an anti-join,
    so a gap that fills late is closed too.
    """
    first, last = _bounds(store.read("panes"), F.col("pane"))
    mark = _bounds(store.read("progress"), F.col("watermark"))[1]
    if last is not None and mark is not None:
        last = max(last, mark - mark % step - step)
    if last is None or first > last - lag:
        return None
    minutes = step // MINUTE
    spine = grid_spine(store.spark, from_epoch(first), from_epoch(last - lag), minutes, "h", "timestamp")
    missing = spine.join(stored.select(F.col("window_start").alias("h")), "h", "left_anti")
    lo = _bounds(missing, micros(F.col("h")))[0]
    return None if lo is None else (lo, missing)


def _recent_panes(store: TableStore, lo: int) -> DataFrame:
    return store.read("panes").where(F.col("pane") >= lo - DAY - HOUR)


def write_features(store: TableStore, minutes: int = 15) -> int:
    """Forecasts for every grid time whose lookback is complete and that has none.

    A time is complete when the pane that starts there has closed: a post exactly
    on the grid time belongs to its lookback.
    """
    own = store.read("predictions").where(F.col("model_version") == MODEL_VERSION)
    todo = closed_starts(store, own, minutes * MINUTE, 0)
    if todo is None:
        return 0
    rows = prediction_rows(features_from_panes(_recent_panes(store, todo[0]), todo[1], minutes))
    return store.append("predictions", new_predictions(store.read("predictions"), rows))


def write_outcomes(store: TableStore, hours: int = 2, minutes: int = 15) -> int:
    """Outcomes of every grid window that has closed, empty ones included."""
    step = minutes * MINUTE
    todo = closed_starts(store, store.read("outcomes"), step, hours * HOUR - step)
    if todo is None:
        return 0
    end = F.col("h") + F.make_dt_interval(hours=F.lit(hours))
    windows = todo[1].select(F.col("h").alias("window_start"), end.alias("window_end"))
    rows = outcomes_from_panes(_recent_panes(store, todo[0]), windows, minutes=minutes)
    rows = rows.select(
        "window_start", "window_end", "v_max", "n_posts", "had_jump",
        observed_json(F.col("v_recent")).alias("targets_observed"),
        F.col("window_end").alias("computed_at"),
    )
    return store.append("outcomes", new_outcomes(store.read("outcomes"), rows))


def close_until(store: TableStore, until: datetime, hours: int = 2, minutes: int = 15) -> tuple[int, int]:
    """Close all grid times and windows up to ``until`` (UTC) though no post has come.

    For the quiet end of a stream: the caller knows that nothing older is on its
    way.  Returns the forecasts and outcomes written; a post that comes after all
    changes none of them.
    """
    _advance(store, _micros_of(until.isoformat() + ("" if until.tzinfo else "+00:00")), minutes * MINUTE)
    return write_features(store, minutes), write_outcomes(store, hours, minutes)


def _stream(posts, store, checkpoint, delay, minutes, then, trigger) -> StreamingQuery:
    name, late = f"panes-{uuid4().hex}", _delay(store.spark, delay)

    def close(batch: DataFrame, _: int) -> None:
        own = next((q for q in posts.sparkSession.streams.active if q.name == name), None)
        _advance(store, reached(own, late), minutes * MINUTE)
        batch = batch.persist()  # read twice, and the state must not be
        store.append("panes", insert_absent(store.read("panes"), batch, ["pane", "on_edge"], ["pane"]))
        batch.unpersist()
        for step in then:
            step(store)

    return (
        streaming_panes(posts, delay, minutes)
        .writeStream.outputMode("append")
        .queryName(name)
        .foreachBatch(close)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_features(
    posts: DataFrame, store: TableStore, checkpoint: str, delay: str = "0 seconds", minutes: int = 15, **trigger
) -> StreamingQuery:
    """Forecasts at each grid time as soon as its lookback is complete."""
    return _stream(posts, store, checkpoint, delay, minutes, [write_features], trigger)


def stream_outcomes(
    posts: DataFrame, store: TableStore, checkpoint: str, delay: str = "0 seconds", minutes: int = 15, **trigger
) -> StreamingQuery:
    """Outcome of each grid window once it has closed; written once."""
    return _stream(posts, store, checkpoint, delay, minutes, [write_outcomes], trigger)


def stream_both(
    posts: DataFrame, store: TableStore, checkpoint: str, delay: str = "0 seconds", minutes: int = 15, **trigger
) -> StreamingQuery:
    """Forecasts and outcomes off the same panes."""
    return _stream(posts, store, checkpoint, delay, minutes, [write_features, write_outcomes], trigger)
