"""Landed RSS feeds as payload rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brinkcast.functions.times import parse_feed_time, time_literal

ITEM_SCHEMA = (
    "title string, link string, guid string, id string, pubDate string, published string, author string, "
    "creator string, description string, summary string, encoded string, content string"
)

ENTRY_SCHEMA = (
    "id string, link array<struct<_href: string, _rel: string>>, published string, updated string, "
    "author struct<name: string>, content struct<_VALUE: string, _type: string>, summary struct<_VALUE: string, _type: string>"
)


def _filled(*parts: Column) -> Column:
    """First part that is neither NULL nor empty."""
    return F.coalesce(*[F.nullif(p, F.lit("")) for p in parts])


def with_published_at(df: DataFrame, fallback: Column, raw: str = "published_raw") -> DataFrame:
    """Add ``published_at``; an unreadable or missing date takes ``fallback``, the
    time the feed was captured."""
    return df.withColumn("published_at", parse_feed_time(F.col(raw), fallback))


def with_external_id(df: DataFrame) -> DataFrame:
    """Add ``external_id``: entry id, else link, else publication time as ISO text."""
    iso = F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ssXXX")
    iso = F.regexp_replace(iso, "Z$", "+00:00")
    return df.withColumn("external_id", F.coalesce(_filled(F.col("entry_id"), F.col("link")), iso))


def with_raw_content(df: DataFrame) -> DataFrame:
    """Add ``raw_content``: content body, else summary, else empty."""
    return df.withColumn("raw_content", F.coalesce(_filled(F.col("content"), F.col("summary")), F.lit("")))


def since_filter(df: DataFrame, since: datetime | str | None) -> DataFrame:
    """Entries published after ``since``; all of them without one."""
    if since is None:
        return df
    dtype = df.schema["published_at"].dataType.simpleString()
    return df.where(F.col("published_at") > time_literal(since, dtype))


def payload_rows(entries: DataFrame, source: Column, captured_at: Column) -> DataFrame:
    """Entry fields as ingest payloads."""
    rows = with_raw_content(with_external_id(with_published_at(entries, captured_at)))
    return rows.select(
        source.alias("source"),
        "external_id",
        "published_at",
        "author",
        "raw_content",
        F.array().cast("array<string>").alias("media_urls"),
        F.create_map(F.lit("link"), F.col("link")).alias("raw_metadata"),
    )


def read_feed_items(
    spark: SparkSession,
    path: str,
    source: str,
    captured_at: datetime | str,
    since: datetime | str | None = None,
) -> DataFrame:
    """Payload rows of the feeds under ``path``: one per ``<item>`` of RSS, one per
    ``<entry>`` of Atom."""

    def tagged(tag: str, schema: str) -> DataFrame:
        reader = spark.read.format("xml").option("rowTag", tag).option("ignoreNamespace", "true")
        return reader.schema(schema).load(path)

    raw, atom = tagged("item", ITEM_SCHEMA), tagged("entry", ENTRY_SCHEMA)
    # the link that names no relation, or the entry itself as such; else the first
    own = F.filter("link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    atom = atom.select(
        _filled(F.col("id")).alias("entry_id"),
        F.coalesce(F.get(own, F.lit(0)), F.get("link", F.lit(0)))["_href"].alias("link"),
        F.coalesce("published", "updated").alias("published_raw"),
        F.col("author.name").alias("author"),
        F.col("content._VALUE").alias("content"),
        F.col("summary._VALUE").alias("summary"),
    )
    entries = raw.select(
        _filled(F.col("guid"), F.col("id")).alias("entry_id"),
        "link",
        F.coalesce("pubDate", "published").alias("published_raw"),
        F.coalesce("author", "creator").alias("author"),
        F.coalesce("encoded", "content").alias("content"),
        F.coalesce("description", "summary").alias("summary"),
    )
    rows = payload_rows(entries.unionByName(atom), F.lit(source), time_literal(captured_at, "timestamp"))
    return since_filter(rows, since)


def source_dimension(
    spark: SparkSession, rows: list[tuple[str, str, str]]
) -> DataFrame:
    """A fixed list of (name, url, label); a repeated or empty name is an error."""
    names = [r[0] for r in rows]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"source names are not unique: {', '.join(repeated)}")
    if not all(names):
        raise ValueError("a source has no name")
    return spark.createDataFrame(rows, "name string, url string, label string")


def duplicate_names(sources: DataFrame) -> DataFrame:
    """Names that occur more than once in a table of sources."""
    return sources.groupBy("name").agg(F.count("*").alias("n")).where("n > 1")
