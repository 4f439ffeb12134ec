"""One cycle over the table store: ingest, label, forecast, outcomes."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brinkcast.functions.keys import observed_json, stable_id
from brinkcast.functions.text import ladder_level, normalize_text, token_count
from brinkcast.functions.times import MINUTE, epoch_micros, from_epoch, grid_spine, micros, time_literal
from brinkcast.operators.annotations import items_with_latest, pending_annotation
from brinkcast.operators.predictions import MODEL_VERSION, due_windows, prediction_rows
from brinkcast.operators.windows import features_at, window_outcomes
from brinkcast.operators.writes import (
    append_annotations,
    insert_absent,
    new_outcomes,
    new_predictions,
    raw_item_rows,
)
from brinkcast.sources.keyindex import KeyIndex
from brinkcast.sources.tables import RAW_KEY, TableStore


def utc(t: datetime | str) -> datetime:
    t = datetime.fromisoformat(t) if isinstance(t, str) else t
    return t.replace(tzinfo=timezone.utc) if t.tzinfo is None else t.astimezone(timezone.utc)


def day_of(t: datetime) -> str:
    return t.date().isoformat()


def ingest(store: TableStore, payload: DataFrame, now: datetime, kind: str = "rss", primary: tuple[str, ...] = ()) -> dict[str, int]:
    """Write what is new of a batch of payloads: sources, raw rows, items.

    Each step reads the tables as the step before left them, so a retry after a
    failure carries on where the first attempt stopped.
    """
    named = payload.select(F.col("source").alias("name")).distinct()
    flag = F.when(F.col("name").isin(*primary), F.lit("true")).otherwise("false") if primary else F.lit("false")
    sources = named.select(
        stable_id(F.col("name")).alias("source_id"),
        "name",
        F.lit(kind).alias("kind"),
        F.lit(None).cast("string").alias("url"),
        F.create_map(F.lit("primary"), flag).alias("metadata"),
    )
    store.append("sources", insert_absent(store.read("sources"), sources, ["name"], ["source_id"]))
    # The id follows from the name, so raw rows need no join to the sources.
    raw = raw_item_rows(payload, stable_id(F.col("source")), time_literal(now, "timestamp"))
    n_raw = KeyIndex(store, "raw_items", RAW_KEY).append_new(raw, ["published_at", "raw_item_id"])
    lo = raw.agg(F.min(micros(F.col("published_at")))).first()[0]
    # Items are made from the raw rows that were stored, so that both come from the
    # same copy of a post.
    ids = raw.select("raw_item_id").distinct()
    kept = raw.limit(0)
    if lo is not None:
        kept = store.since("raw_items", day_of(from_epoch(lo))).join(ids, "raw_item_id", "left_semi")
    clean = normalize_text(F.col("raw_content"), is_html=True)
    items = kept.select(
        F.col("raw_item_id").alias("item_id"),
        "raw_item_id",
        F.lit("en").alias("language"),
        clean.alias("clean_text"),
        token_count(clean).alias("token_count"),
    )
    n_items = KeyIndex(store, "items", ["raw_item_id"]).append_new(items, ["raw_item_id"])
    return {"new_raw": n_raw, "new_items": n_items}


def label_pending(
    store: TableStore,
    version: str,
    now: datetime,
    phrases: dict[int, list[str]],
    annotator: str = "llm",
    among: DataFrame | None = None,
) -> int:
    """Label items without a label at this version with the phrase ladder.

    ``among`` (item ids) confines the work to the items of a batch.
    """
    items, done = store.read("items"), store.read("annotations")
    if among is not None:
        ids = among.select("item_id").distinct()
        items, done = (df.join(ids, "item_id", "left_semi") for df in (items, done))
    todo = pending_annotation(items.where(F.col("clean_text") != ""), done, version)
    labels = todo.select(
        "item_id",
        ladder_level(F.col("clean_text"), phrases).alias("level"),
        F.lit("none").alias("target_type"),
        F.lit(1.0).alias("confidence"),
    )
    none = store.read("annotations").limit(0)
    rows = append_annotations(none, labels, annotator, version, time_literal(now, "timestamp"))
    return store.append("annotations", rows)


def posts_between(store: TableStore, lo: datetime, hi: datetime) -> DataFrame:
    """Posts of a time range with their newest level.

    Older partitions of the posts are skipped.  Items and labels are reduced to
    those of the range before anything is ranked or joined: a small range is
    broadcast, and the history is scanned but not shuffled.
    """
    raw = store.since("raw_items", day_of(lo)).where(
        F.col("published_at").between(time_literal(lo, "timestamp"), time_literal(hi, "timestamp"))
    )
    items = store.read("items").join(raw.select("raw_item_id"), "raw_item_id", "left_semi")
    ann = store.read("annotations").join(items.select("item_id"), "item_id", "left_semi")
    return items_with_latest(raw, items, store.read("sources"), ann)


def predict(store: TableStore, now: datetime, since: datetime | None = None) -> int:
    """Forecasts for the windows that start at grid points up to ``now``.

    Grid points after the newest forecast are made up for, and those from ``since``
    on that have none; without either only the newest grid point counts.
    """
    step = 15 * MINUTE
    last = epoch_micros(now) // step * step
    own = store.read("predictions").where(F.col("model_version") == MODEL_VERSION)
    newest = own.agg(F.max(micros(F.col("window_start")))).first()[0]
    begins = [last] if newest is None else [newest + step]
    if since is not None:
        begins.append(-(-epoch_micros(since) // step) * step)
    first = min(last, *begins)
    spine = grid_spine(store.spark, from_epoch(first), from_epoch(last), 15, "h", "timestamp")
    known = store.since("predictions", day_of(from_epoch(first))).where(F.col("model_version") == MODEL_VERSION)
    missing = spine.join(known.select(F.col("window_start").alias("h")), "h", "left_anti")
    posts = posts_between(store, from_epoch(first) - timedelta(hours=24), from_epoch(last))
    rows = prediction_rows(features_at(posts, missing), time_literal(now, "timestamp"))
    return store.append("predictions", new_predictions(known, rows))


def close_windows(store: TableStore, now: datetime, limit: int | None = None) -> int:
    """Outcomes of forecast windows that have ended."""
    due = due_windows(store.read("predictions"), store.read("outcomes"), now, limit)
    span = due.agg(
        F.min(micros(F.col("window_start"))).alias("lo"), F.max(micros(F.col("window_end"))).alias("hi")
    ).first()
    if span["lo"] is None:
        return 0
    lo, hi = from_epoch(span["lo"]), from_epoch(span["hi"])
    posts = posts_between(store, lo - timedelta(hours=24), hi)
    rows = window_outcomes(posts, due).select(
        "window_start",
        "window_end",
        "v_max",
        "n_posts",
        observed_json(F.col("v_recent")).alias("targets_observed"),
        "had_jump",
        time_literal(now, "timestamp").alias("computed_at"),
    )
    return store.append("outcomes", new_outcomes(store.read("outcomes"), rows))


def run_tick(
    store: TableStore,
    payload: DataFrame,
    now: datetime | str,
    phrases: dict[int, list[str]] | None = None,
    version: str = "ladder-1",
    primary: tuple[str, ...] = (),
    limit: int | None = None,
) -> dict[str, int]:
    """Ingest, label, forecast, close windows; returns what was written.

    Forecasts cover every grid time since the oldest post of the batch, outcomes
    every window that has ended, unless a limit is given.

    Running the same cycle again writes nothing.
    """
    now = utc(now)
    out = ingest(store, payload, now, primary=primary)
    if phrases:
        ids = payload.select(stable_id(stable_id(F.col("source")), F.col("external_id")).alias("item_id"))
        out["annotations"] = label_pending(store, version, now, phrases, among=ids)
    else:
        out["annotations"] = 0
    oldest = payload.agg(F.min(micros(F.col("published_at")))).first()[0]
    out["predictions"] = predict(store, now, None if oldest is None else from_epoch(oldest))
    out["outcomes"] = close_windows(store, now, limit)
    return out
