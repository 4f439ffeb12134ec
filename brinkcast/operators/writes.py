"""Append-only writes as set operations: insert what is absent, touch nothing else.

Each operator returns the rows to append.  A re-run over the same batch returns
nothing, so a retried job or micro-batch is harmless.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brinkcast.functions.keys import label_cache_key, stable_id


def first_per_key(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order, ties by a hash of the content.

    The row-number filter is applied in each task before the shuffle, so one key
    with very many copies sends at most one row per task.
    """
    # copies that agree in all of the order are told apart by their content
    content = F.xxhash64(*[F.to_json(F.struct(F.col(f"`{c}`"))) for c in batch.columns])
    w = W.partitionBy(*keys).orderBy(*order, content)
    return batch.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def insert_absent(
    existing: DataFrame, batch: DataFrame, keys: list[str], order: list[str]
) -> DataFrame:
    """Rows of ``batch`` whose key is not in ``existing``, one per key.

    The table is first reduced to keys that occur in the batch; for a batch
    small enough to broadcast, the table is only scanned, never shuffled.
    """
    fresh = first_per_key(batch, keys, order)
    known = existing.select(*keys).join(batch.select(*keys).distinct(), keys, "left_semi").distinct()
    return fresh.join(known, keys, "left_anti")


def get_or_create_sources(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """All sources after the batch: known names keep their row, new names are added."""
    order = [c for c in ("source_id", "url", "kind") if c in batch.columns]
    added = insert_absent(existing, batch, ["name"], order or ["name"])
    return existing.unionByName(added, allowMissingColumns=True)


def new_raw_items(existing: DataFrame, batch: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Batch rows with a new (source_id, external_id); the first in the batch wins."""
    return insert_absent(
        existing, batch, ["source_id", "external_id"], order or ["published_at", "raw_item_id"]
    )


def upsert_items(items: DataFrame, raw: DataFrame) -> DataFrame:
    """One item per raw row that has none yet."""
    return insert_absent(items, raw, ["raw_item_id"], ["raw_item_id"])


def append_annotations(
    ann: DataFrame, labels: DataFrame, annotator: str, version: str | None, at: Column
) -> DataFrame:
    """All labels after appending ``labels`` under an annotator and version."""
    tagged = labels.select(
        "item_id",
        F.lit(annotator).alias("annotator"),
        F.lit(version).cast("string").alias("labeler_version"),
        F.col("level").cast("int").alias("valence_level"),
        *[c for c in ("target_type", "target_name", "confidence", "rationale") if c in labels.columns],
        at.alias("annotated_at"),
    )
    return ann.unionByName(tagged, allowMissingColumns=True)


def new_predictions(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Forecasts for a (window, model) that has none."""
    return insert_absent(
        existing, batch, ["window_start", "window_end", "model_version"], ["made_at"]
    )


def new_outcomes(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Outcomes of windows without one; a stored outcome is never revised."""
    order = ["computed_at"] if "computed_at" in batch.columns else ["n_posts"]
    return insert_absent(existing, batch, ["window_start", "window_end"], order)


def ingest_summary(
    sources: DataFrame,
    new_raw: DataFrame,
    new_labels: DataFrame,
    failed: DataFrame | None = None,
    key: str = "name",
) -> DataFrame:
    """Counters per source and in total (NULL name): new posts, labels, fetch errors.

    Counts are brought to one long form and rolled up in a single aggregation.
    """
    zero = F.lit(0).cast("long")
    one = F.lit(1).cast("long")

    def tagged(df: DataFrame, raw: Column, lab: Column, err: Column) -> DataFrame:
        return df.select(
            F.col(key).alias(key), raw.alias("new_raw"), lab.alias("annotations"), err.alias("fetch_error")
        )

    rows = (
        tagged(sources, zero, zero, zero)
        .unionByName(tagged(new_raw, one, zero, zero))
        .unionByName(tagged(new_labels, zero, one, zero))
    )
    if failed is not None:
        rows = rows.unionByName(tagged(failed, zero, zero, one))
    return rows.rollup(key).agg(
        F.grouping(key).cast("int").alias("is_total"),
        F.sum("new_raw").alias("new_raw"),
        F.sum("annotations").alias("annotations"),
        F.max("fetch_error").alias("fetch_error") if failed is None else F.sum("fetch_error").alias("fetch_error"),
    )


def join_label_cache(
    batch: DataFrame, cache: DataFrame, model: str, version: str, text: str = "clean_text"
) -> tuple[DataFrame, DataFrame]:
    """Rows answered by the cache, and one row per distinct text that is not.

    Copies of a text share a key; only one of them is sent on.
    """
    keyed = batch.withColumn("label_key", label_cache_key(F.col(text), model, version))
    known = first_per_key(cache, ["label_key"], ["level"])
    hits = keyed.join(known, "label_key")
    misses = first_per_key(
        keyed.select("label_key", text), ["label_key"], [text]
    ).join(known.select("label_key"), "label_key", "left_anti")
    return hits, misses


def raw_item_rows(payload: DataFrame, source_id: Column, captured_at: Column) -> DataFrame:
    """Feed entries as raw rows with a deterministic id."""
    return payload.select(
        stable_id(source_id, F.col("external_id")).alias("raw_item_id"),
        source_id.cast("string").alias("source_id"),
        "external_id",
        "published_at",
        captured_at.cast("timestamp").alias("captured_at"),
        "author",
        "raw_content",
        "media_urls",
        "raw_metadata",
    )
