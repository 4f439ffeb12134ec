"""Continuous ingest: only new posts reach the tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from brinkcast.functions.times import from_epoch, micros
from brinkcast.plans.cycle import run_tick
from brinkcast.sources.keyindex import KeyIndex
from brinkcast.sources.tables import RAW_KEY, TableStore


def drop_repeats(payload: DataFrame, delay: str = "1 day") -> DataFrame:
    """Leave out entries already seen within the delay.

    The watermark runs on the capture time: an old post that is fetched for the
    first time (a backfill) is not late.
    """
    return payload.withWatermark("captured_at", delay).dropDuplicatesWithinWatermark(
        ["source_id", "external_id"]
    )


def stream_ingest(
    raw: DataFrame, store: TableStore, checkpoint: str, delay: str = "1 day", **trigger
) -> StreamingQuery:
    """Append new raw rows of a stream to the store.

    The stream state drops recent repeats; the key index drops older ones and makes a
    repeated micro-batch harmless, without a look at the posts stored before.
    """
    index = KeyIndex(store, "raw_items", RAW_KEY)

    def write(batch: DataFrame, _: int) -> None:
        index.append_new(batch, None)  # each key once, by drop_repeats

    return (
        drop_repeats(raw, delay)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def stream_ticks(
    payload: DataFrame,
    store: TableStore,
    checkpoint: str,
    phrases: dict[int, list[str]] | None = None,
    primary: tuple[str, ...] = (),
    now: datetime | str | None = None,
    clock: str = "captured_at",
    **trigger,
) -> StreamingQuery:
    """The whole cycle once per micro-batch.

    The cycle's clock is the newest capture time in the batch, so a replay of
    the same batch does the same work; ``now`` overrides it.
    """

    def cycle(batch: DataFrame, _: int) -> None:
        batch = batch.persist()  # every step of the cycle reads it
        at = now
        if at is None:
            newest = batch.agg(F.max(micros(F.col(clock)))).first()[0]
            at = None if newest is None else from_epoch(newest)
        if at is not None:
            run_tick(store, batch, at, phrases, primary=primary)
        batch.unpersist()

    return (
        payload.writeStream.foreachBatch(cycle)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
