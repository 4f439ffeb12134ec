"""Deterministic keys and JSON payloads."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FEATURE_COLUMNS = (
    "eco_mean_6h",
    "eco_n_6h",
    "primary_mean_24h",
    "primary_n_24h",
    "primary_posts_6h",
)


def stable_id(*parts: Column) -> Column:
    """Surrogate id from the natural key: a re-run gives the same id."""
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def feature_hash(h: Column, columns: tuple[str, ...] = FEATURE_COLUMNS) -> Column:
    """SHA-256 over the time and the features at six decimals."""
    fixed = [F.col(c).cast("decimal(18,6)").cast("string") for c in columns]
    return F.sha2(F.concat_ws("|", F.date_format(h, "yyyy-MM-dd HH:mm:ss"), *fixed), 256)


def label_cache_key(text: Column, model: str, version: str) -> Column:
    """SHA-256 under which a label of this text is kept."""
    return F.sha2(F.concat(F.lit(version + model), text), 256)


def prediction_payload(features: tuple[str, ...], probs: tuple[str, ...]) -> Column:
    """JSON record of the inputs and outputs of a forecast."""
    return F.to_json(
        F.struct(
            F.struct(*[F.col(c) for c in features]).alias("features"),
            F.struct(*[F.col(c) for c in probs]).alias("probs"),
        )
    )


def is_primary(metadata: Column, flag: str = "primary", as_json: bool = False) -> Column:
    """True for the source of interest; a missing flag means no."""
    value = F.get_json_object(metadata, f"$.{flag}") if as_json else F.try_element_at(metadata, F.lit(flag))
    return F.coalesce(value, F.lit("false")) == "true"


def outcome_context(observed: Column) -> Column:
    """``v_recent`` out of the stored JSON, 0.0 when absent."""
    return F.coalesce(F.get_json_object(observed, "$.v_recent").try_cast("double"), F.lit(0.0))


def observed_json(v_recent: Column) -> Column:
    """The JSON stored beside an outcome."""
    return F.to_json(F.struct(v_recent.alias("v_recent")))


def shuffle_key(seed: int | str, item_id: Column) -> Column:
    """Seeded pseudo-random order that every engine reproduces."""
    return F.md5(F.concat(F.lit(f"{seed}:"), item_id.cast("string")))
