"""Streams over the given events, run to the end of what is there.

Each query streams the whole table into a fresh store and returns what was
written, so the SQL of the batch form checks it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from brinkcast.catalog.bridge import SHARED, given, table
from brinkcast.catalog.core import PHRASES, case, posts_of, r9, r9sql
from brinkcast.catalog.storing import scratch
from brinkcast.functions.keys import outcome_context
from brinkcast.functions.times import MINUTE, micros
from brinkcast.session import pin_utc
from brinkcast.sources.tables import TableStore
from brinkcast.streaming.ingest import stream_ingest, stream_ticks
from brinkcast.streaming.panes import stream_features, stream_outcomes


def _store(spark, name: str) -> tuple[TableStore, str]:
    root = scratch(spark, name)
    return TableStore(spark, f"{root}/store"), f"{root}/progress"


def _stream(spark, folder: str, schema):
    return pin_utc(spark).readStream.schema(schema).parquet(folder)


def _events_stream(spark, d):
    schema = given(spark, d, "events").schema
    return pin_utc(spark).readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


def _raw_stream(spark, d):
    """Posts as they come in, captured an hour after publication."""
    feed = F.regexp_extract("props", "[0-9]+", 0)
    at = F.col("ts").cast("timestamp")
    return _events_stream(spark, d).select(
        F.col("event_id").cast("string").alias("raw_item_id"),
        feed.alias("source_id"),
        F.concat(F.lit("e"), F.col("event_id")).alias("external_id"),
        at.alias("published_at"),
        (at + F.expr("interval 1 hour")).alias("captured_at"),
        F.col("event_type").alias("author"),
        F.col("props").alias("raw_content"),
        F.array().cast("array<string>").alias("media_urls"),
        F.create_map().cast("map<string,string>").alias("raw_metadata"),
    )


@case("r01_stream_ingest", "select source_id::varchar as source_id, external_id, published_at from raw_items")
def _(spark, d):
    store, progress = _store(spark, "ingest")
    for _ in range(2):  # the second run finds nothing new
        stream_ingest(_raw_stream(spark, d), store, progress).awaitTermination()
    rows = store.read("raw_items")
    return rows.select("source_id", "external_id", F.col("published_at").cast("timestamp_ntz").alias("published_at"))


def _labelled_posts_stream(spark, d):
    """All posts with their newest level, landed as files and streamed."""
    folder = scratch(spark, "posts")
    posts = posts_of(spark, d).withColumn("published_at", F.col("published_at").cast("timestamp"))
    posts.write.parquet(folder)
    return _stream(spark, folder, posts.schema)


# Panes that end by the newest post's time, the watermark, have closed.
_CLOSED = """select min(time_bucket(interval 15 minutes, published_at)) as first_pane,
       time_bucket(interval 15 minutes, max(published_at)) - interval 15 minutes as last_pane from raw_items"""


@case(
    "r02_stream_features",
    """select h, round(coalesce(avg(valence_level::double) filter (not is_primary and published_at > h - interval 6 hours), 0.0), 9) as eco_mean_6h,
         count(valence_level) filter (not is_primary and published_at > h - interval 6 hours) as eco_n_6h,
         round(coalesce(avg(valence_level::double) filter (is_primary), 0.0), 9) as primary_mean_24h,
         count(valence_level) filter (is_primary) as primary_n_24h,
         count(raw_item_id) filter (is_primary and published_at > h - interval 6 hours) as primary_posts_6h
       from grid left join posts on published_at > h - interval 24 hours and published_at <= h group by h""",
    closed=_CLOSED,
    grid="select unnest(generate_series(first_pane, last_pane, interval 15 minutes)) as h from closed",
)
def _(spark, d):
    store, progress = _store(spark, "features")
    stream_features(_labelled_posts_stream(spark, d), store, progress).awaitTermination()
    stored = F.from_json(
        F.get_json_object("payload", "$.features"),
        "eco_mean_6h double, eco_n_6h long, primary_mean_24h double, primary_n_24h long, primary_posts_6h long",
    )
    rows = store.read("predictions").select(
        F.col("window_start").cast("timestamp_ntz").alias("h"), stored.alias("f")
    )
    return r9(rows.select("h", "f.*"), "eco_mean_6h", "primary_mean_24h")


def _outcome_rows(store: TableStore):
    times = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")]
    rows = store.read("outcomes").select(
        *times, "v_max", "n_posts", outcome_context(F.col("targets_observed")).alias("v_recent"), "had_jump"
    )
    return r9(rows, "v_recent")


@case(
    "r03_stream_outcomes_quiet",
    f"""select window_start, window_end, v_max, n_posts, {r9sql('v_recent')}, n_posts > 0 and v_max >= 0 and v_max >= v_recent + 2 as had_jump
        from (select ws as window_start, ws + interval 2 hours as window_end,
                coalesce(max(valence_level) filter (published_at >= ws), -1)::int as v_max,
                count(item_id) filter (published_at >= ws) as n_posts,
                coalesce(avg(valence_level::double) filter (published_at <= ws), 0.0) as v_recent
              from grid left join (select posts.* from posts, cut where is_primary and published_at < pause) p
                on published_at > ws - interval 24 hours and published_at < ws + interval 2 hours group by ws)""",
    cut="""select time_bucket(interval 15 minutes, min(published_at) + (max(published_at) - min(published_at)) / 2) as pause,
          max(published_at) as last_post from raw_items""",
    grid="""select unnest(generate_series((select min(time_bucket(interval 15 minutes, published_at)) from raw_items),
          time_bucket(interval 15 minutes, last_post) - interval 2 hours, interval 15 minutes)) as ws from cut""",
)
def _(spark, d):
    """Posts end halfway; those of the very last instant close all windows between."""
    store, progress = _store(spark, "quiet")
    folder = scratch(spark, "posts")
    posts = posts_of(spark, d).withColumn("published_at", F.col("published_at").cast("timestamp"))
    us = micros(F.col("published_at"))
    first, last = posts.agg(F.min(us), F.max(us)).first()
    pause = (first + last) // 2
    posts.where((us < pause - pause % (15 * MINUTE)) | (us == last)).write.parquet(folder)
    stream_outcomes(_stream(spark, folder, posts.schema), store, progress).awaitTermination()
    return _outcome_rows(store)


@case(
    "r03_stream_outcomes",
    f"""select window_start, window_end, v_max, n_posts, {r9sql('v_recent')}, n_posts > 0 and v_max >= 0 and v_max >= v_recent + 2 as had_jump
        from (select ws as window_start, ws + interval 2 hours as window_end,
                coalesce(max(valence_level) filter (published_at >= ws), -1)::int as v_max,
                count(item_id) filter (published_at >= ws) as n_posts,
                coalesce(avg(valence_level::double) filter (published_at <= ws), 0.0) as v_recent
              from grid left join (select * from posts where is_primary) p
                on published_at > ws - interval 24 hours and published_at < ws + interval 2 hours group by ws)""",
    closed=_CLOSED,
    grid="""select unnest(generate_series(first_pane, last_pane + interval 15 minutes - interval 2 hours, interval 15 minutes)) as ws
        from closed""",
)
def _(spark, d):
    store, progress = _store(spark, "outcomes")
    stream_outcomes(_labelled_posts_stream(spark, d), store, progress).awaitTermination()
    return _outcome_rows(store)


@case(
    "r05_tick",
    "select 'raw_items' as name, count(*) as n from events union all select 'items', count(*) from events union all select 'annotations', count(*) from events union all select 'sources', count(distinct event_type) from events union all select 'predictions', count(*) from ticks union all select 'outcomes', count(*) from ticks where ended union all select 'posts in outcomes', count(*) from ticks join events on event_type = 'error' and ts >= h and ts < h + interval 2 hours where ended",
    ticks="""select h, h + interval 2 hours < newest as ended from (
        select unnest(generate_series(time_bucket(interval 15 minutes, oldest + interval 15 minutes - interval 1 microsecond), newest,
          interval 15 minutes)) as h, newest
        from (select min(published_at) as oldest, max(published_at) as newest from raw_items))""",
)
def _(spark, d):
    store, progress = _store(spark, "tick")
    for _ in range(2):  # a second cycle over the same input writes nothing
        at = F.col("ts").cast("timestamp")
        payload = _events_stream(spark, d).select(
            F.col("event_type").alias("source"),
            F.concat(F.lit("e"), F.col("event_id")).alias("external_id"),
            at.alias("published_at"),
            F.lit(None).cast("string").alias("author"),
            F.col("props").alias("raw_content"),
            F.array().cast("array<string>").alias("media_urls"),
            F.create_map().cast("map<string,string>").alias("raw_metadata"),
            at.alias("captured_at"),
        )
        stream_ticks(payload, store, progress, PHRASES, ("error",)).awaitTermination()
    counts = None
    for name in ("raw_items", "items", "annotations", "sources", "predictions", "outcomes"):
        one = store.read(name).agg(F.lit(name).alias("name"), F.count("*").alias("n"))
        counts = one if counts is None else counts.unionByName(one)
    posts = store.read("outcomes").agg(F.lit("posts in outcomes").alias("name"), F.sum("n_posts").alias("n"))
    return counts.unionByName(posts)


@case(
    "r04_late_data",
    f"""select window_start, window_end, v_max, n_posts, {r9sql('v_recent')}, n_posts > 0 and v_max >= 0 and v_max >= v_recent + 2 as had_jump
        from (select ws as window_start, ws + interval 2 hours as window_end,
                coalesce(max(valence_level) filter (published_at >= ws), -1)::int as v_max,
                count(item_id) filter (published_at >= ws) as n_posts,
                coalesce(avg(valence_level::double) filter (published_at <= ws), 0.0) as v_recent
              from grid left join (select * from posts where is_primary) p
                on published_at > ws - interval 24 hours and published_at < ws + interval 2 hours group by ws)""",
    closed=_CLOSED,
    grid="""select unnest(generate_series(first_pane, last_pane + interval 15 minutes - interval 2 hours, interval 15 minutes)) as ws
        from closed""",
)
def _(spark, d):
    """After the stream has closed its windows every post arrives once more, at the
    highest level: all but those of the open last pane are late."""
    store, progress = _store(spark, "late")
    folder = scratch(spark, "posts")
    posts = posts_of(spark, d).withColumn("published_at", F.col("published_at").cast("timestamp"))
    posts.write.parquet(f"{folder}/first")
    stream_outcomes(_stream(spark, f"{folder}/*", posts.schema), store, progress).awaitTermination()
    posts.withColumn("valence_level", F.lit(6)).write.parquet(f"{folder}/second")
    stream_outcomes(_stream(spark, f"{folder}/*", posts.schema), store, progress).awaitTermination()
    return _outcome_rows(store)
