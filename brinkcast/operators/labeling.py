"""Labelling and embedding as batch jobs with a function the caller supplies."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from brinkcast.functions.keys import label_cache_key
from brinkcast.functions.text import excerpt
from brinkcast.operators.annotations import valid_label
from brinkcast.operators.ordered import stored
from brinkcast.operators.writes import first_per_key, join_label_cache
from brinkcast.session import bounded_batches

LABEL_SCHEMA = (
    "label_key string, level int, target_type string, target_name string, "
    "rationale string, confidence double, error string"
)


def _typed(label: dict[str, Any]) -> dict[str, Any]:
    """A label in the types of the schema; anything else is the labeler's error."""
    kinds = {"level": int, "confidence": float, "target_type": str, "target_name": str, "rationale": str}
    out = {}
    for name, kind in kinds.items():
        value = label.get(name)
        if isinstance(value, np.generic):
            value = value.item()
        if kind is float and isinstance(value, int) and not isinstance(value, bool):
            value = float(value)
        if value is not None and (not isinstance(value, kind) or isinstance(value, bool)):
            raise TypeError(name)
        if kind is int and value is not None and not -(2**31) <= value < 2**31:
            raise ValueError(name)
        out[name] = value
    return out


def _call_labeler(labeler: Callable[[str], dict[str, Any]], text: str):
    """Run the labeler over batches of texts; a failure marks its row only."""

    fields = ["label_key", "level", "target_type", "target_name", "rationale", "confidence", "error"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, value in zip(batch["label_key"], batch[text]):
                row = {"label_key": key}
                try:
                    row.update(_typed(labeler(value)))
                except Exception as exc:  # counted, not fatal
                    row["error"] = type(exc).__name__
                rows.append(row)
            yield pd.DataFrame({f: pd.Series([r.get(f) for r in rows], dtype="object") for f in fields})

    return run


def label_batch(
    df: DataFrame,
    labeler: Callable[[str], dict[str, Any]],
    cache: DataFrame,
    model: str,
    version: str,
    text: str = "clean_text",
    max_chars: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Label rows of ``df``: returns labelled rows and new cache entries.

    Empty texts are dropped, others cut only where a labeler's limit is given.  Known texts come
    from the cache; each distinct new text is labelled once, in the executors.
    Every row keeps ``status``: ok, invalid (label rejected) or failed.  Only
    valid labels go into the cache.
    """
    bounded_batches(df.sparkSession)
    rows = df.where(F.col(text) != "")
    if max_chars is not None:
        rows = rows.withColumn(text, excerpt(F.col(text), max_chars))
    cache = first_per_key(cache, ["label_key"], ["label_key"])
    _, misses = join_label_cache(rows, cache, model, version, text)
    # Stored: answers and cache entries both read it, the labeler must run once.
    fresh = stored(misses.mapInPandas(_call_labeler(labeler, text), LABEL_SCHEMA))
    fields = ["level", "target_type", "target_name", "rationale", "confidence"]
    new_entries = fresh.where(F.col("error").isNull() & valid_label()).select("label_key", *fields)
    known = cache.select("label_key", *fields, F.lit(None).cast("string").alias("error"))
    answers = known.unionByName(fresh).withColumn(
        "status",
        F.when(F.col("error").isNotNull(), "failed").when(valid_label(), "ok").otherwise("invalid"),
    )
    labelled = rows.withColumn("label_key", label_cache_key(F.col(text), model, version)).join(
        answers, "label_key"
    )
    return labelled, new_entries


def embed_batch(
    df: DataFrame, encoder: Callable[[list[str]], Any], text: str = "clean_text", batch: int = 32
) -> DataFrame:
    """Add unit-length ``embedding`` vectors from an encoder over lists of texts.

    A worker holds an Arrow batch of bounded size and the texts of one call; each text
    is encoded once.
    """

    bounded_batches(df.sparkSession)

    @F.arrow_udf(ArrayType(FloatType()))
    def encode(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            out = [pa.array([], pa.list_(pa.float32()))]
            for i in range(0, len(part), batch):
                vec = np.asarray(encoder(part.slice(i, batch).to_pylist()), dtype="float64")
                norm = np.linalg.norm(vec, axis=1, keepdims=True)
                unit = (vec / np.where(norm > 0, norm, 1.0)).astype("float32")
                cuts = np.arange(len(unit) + 1, dtype="int32") * unit.shape[1]
                out.append(pa.ListArray.from_arrays(pa.array(cuts), pa.array(unit.ravel())))
            yield pa.concat_arrays(out)

    # not deterministic: else a filter that Spark infers on the vectors encodes each text again
    return df.withColumn("embedding", encode.asNondeterministic()(F.col(text)))


def ablate_features(
    df: DataFrame,
    temporal: bool = True,
    lexical: bool = True,
    topics: bool = True,
    families: dict[str, list[str]] | None = None,
) -> DataFrame:
    """Drop the columns of feature families that are switched off.

    A column's family is named in its metadata (``family``) or in ``families``.
    """
    off = {
        name
        for name, on in (("temporal", temporal), ("lexical", lexical), ("topics", topics))
        if not on
    }
    named = {c: fam for fam, cols in (families or {}).items() for c in cols}
    drop = [
        f.name for f in df.schema.fields if (f.metadata or {}).get("family", named.get(f.name)) in off
    ]
    return df.drop(*drop)


def in_family(col: Column, name: str, family: str) -> Column:
    """Tag a column with its feature family."""
    return col.alias(name, metadata={"family": family})
