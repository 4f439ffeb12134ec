"""Labels: newest per item, joins to posts, machine/human pairs, candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from brinkcast.functions.keys import is_primary
from brinkcast.schemas import TARGET_TYPES

VERSION = "labeler_version"


def is_machine(annotator: Column) -> Column:
    """Machine labelers carry the ``llm`` prefix; all others are people."""
    return annotator.startswith("llm")


def _recency(df: DataFrame) -> list[str]:
    """Tie-break columns present in the frame, after time and version."""
    return [c for c in ("annotator", "valence_level") if c in df.columns]


def latest_annotation(ann: DataFrame, who: str = "all") -> DataFrame:
    """One row per item, the newest label of the wanted kind of annotator.

    Newest by time, then by labeler version with NULL (a human) first.  The
    filter on the row number makes Spark cut each task's rows to one per item
    before the shuffle, so an item with very many labels does not weigh on it.
    """
    if who == "machine":
        ann = ann.where(is_machine(F.col("annotator")))
    elif who == "human":
        ann = ann.where(~is_machine(F.col("annotator")))
    elif who != "all":
        raise ValueError(f"who must be all, machine or human, not {who!r}")
    newest = W.partitionBy("item_id").orderBy(
        F.desc("annotated_at"),
        F.desc_nulls_first(VERSION),
        *[F.desc(c) for c in _recency(ann)],
    )
    return ann.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


def _newest(keep: Column, df: DataFrame, payload: list[str]) -> Column:
    """Aggregate form of the same order, for several kinds in one pass.

    NULL version ranks first through its own flag in the ordering struct.
    """
    order = F.struct(
        F.col("annotated_at"),
        F.col(VERSION).isNull().alias("unversioned"),
        F.col(VERSION),
        *[F.col(c) for c in _recency(df)],
        F.struct(*[F.col(c) for c in payload]).alias("payload"),
    )
    return F.max(F.when(keep, order))


def paired_annotations(ann: DataFrame) -> DataFrame:
    """Items with both kinds of label: newest machine level and newest human level.

    One aggregation over the labels instead of two rankings and a join.
    """
    machine = is_machine(F.col("annotator"))
    both = ann.groupBy("item_id").agg(
        _newest(machine, ann, ["valence_level"]).alias("m"),
        _newest(~machine, ann, ["valence_level"]).alias("h"),
    )
    return both.where("m is not null and h is not null").select(
        "item_id",
        F.col("m.payload.valence_level").alias("llm_level"),
        F.col("h.payload.valence_level").alias("human_level"),
    )


def sampling_candidates(ann: DataFrame, gold: DataFrame, items: DataFrame | None = None) -> DataFrame:
    """Machine-labelled items that no person labelled and that are not in the gold set.

    Whether a person labelled an item comes out of the same aggregation as the
    newest machine label.  ``items`` adds ``clean_text``; leave it out to rank
    first and fetch texts for the few picked rows only.
    """
    machine = is_machine(F.col("annotator"))
    payload = ["valence_level", "confidence", "target_type", "target_name"]
    per_item = ann.groupBy("item_id").agg(
        _newest(machine, ann, payload).alias("m"),
        F.max((~machine).cast("int")).alias("has_human"),
    )
    out = (
        per_item.where("m is not null and has_human = 0")
        .join(gold.select("item_id").distinct(), "item_id", "left_anti")
        .select(
            "item_id",
            F.col("m.payload.valence_level").alias("llm_level"),
            F.col("m.payload.confidence").alias("llm_confidence"),
            F.col("m.payload.target_type").alias("llm_target_type"),
            F.col("m.payload.target_name").alias("llm_target_name"),
        )
    )
    if items is None:
        return out
    return out.join(items.select("item_id", "clean_text"), "item_id")


def with_primary(sources: DataFrame) -> DataFrame:
    """Sources with the ``is_primary`` flag read from their metadata (map or JSON)."""
    if "is_primary" in sources.columns:
        return sources
    as_json = sources.schema["metadata"].dataType.simpleString() == "string"
    return sources.withColumn("is_primary", is_primary(F.col("metadata"), as_json=as_json))


def enriched_items(
    ann: DataFrame, items: DataFrame, raw: DataFrame, sources: DataFrame
) -> DataFrame:
    """Labelled posts: newest label with its item, post and source (inner joins).

    No broadcast hint: Spark broadcasts the sources when their size allows and
    splits a hot source by skew join otherwise.
    """
    posts = (
        items.select("item_id", "raw_item_id")
        .join(raw.select("raw_item_id", "source_id", "published_at"), "raw_item_id")
        .join(with_primary(sources).select("source_id", "is_primary"), "source_id")
    )
    labels = latest_annotation(ann).select("item_id", "annotator", "valence_level")
    return posts.join(labels, "item_id").select(
        "item_id", "source_id", "published_at", "is_primary", "annotator", "valence_level"
    )


def items_with_latest(
    raw: DataFrame,
    items: DataFrame,
    sources: DataFrame,
    ann: DataFrame,
    primary_only: bool = False,
) -> DataFrame:
    """All posts with their newest level; posts without a label or item keep NULL.

    Items meet their labels first and posts meet the items last, so no join runs
    on a key that is NULL for the posts without an item.  With ``primary_only``
    the posts are cut to the source of interest before that.
    """
    src = with_primary(sources).select("source_id", "is_primary")
    if primary_only:
        src = src.where("is_primary")
    posts = raw.select("raw_item_id", "source_id", "published_at").join(src, "source_id")
    labels = latest_annotation(ann).select("item_id", "valence_level")
    labelled = items.select("item_id", "raw_item_id").join(labels, "item_id", "left")
    return posts.join(labelled, "raw_item_id", "left").select(
        "raw_item_id", "item_id", "source_id", "published_at", "is_primary", "valence_level"
    )


def primary_posts(items: DataFrame, raw: DataFrame, sources: DataFrame) -> DataFrame:
    """Items of the source of interest."""
    src = with_primary(sources).where("is_primary").select("source_id")
    keep = raw.select("raw_item_id", "source_id", "published_at", "author").join(src, "source_id")
    return items.join(keep, "raw_item_id")


def valid_label(level: str = "level") -> Column:
    """Level on the scale, confidence in [0, 1], target type known; NULL is invalid."""
    ok = (
        F.col(level).between(0, 6)
        & F.col("confidence").between(0.0, 1.0)
        & F.col("target_type").isin(*TARGET_TYPES)
    )
    return F.coalesce(ok, F.lit(False))


def valid_annotations(df: DataFrame, level: str = "level") -> tuple[DataFrame, DataFrame]:
    """Accepted rows and rejected rows."""
    ok = valid_label(level)
    return df.where(ok), df.where(~ok)


def pending_annotation(
    items: DataFrame, ann: DataFrame, version: str, limit: int | None = None
) -> DataFrame:
    """Items with no label at the given version, lowest id first when limited."""
    done = ann.where(F.col(VERSION) == version).select("item_id").distinct()
    todo = items.select("item_id", "clean_text").join(done, "item_id", "left_anti")
    return todo if limit is None else todo.orderBy("item_id").limit(limit)


def merge_human_labels(sample: DataFrame, labels: DataFrame) -> DataFrame:
    """Sample rows with the human level and notes; absent gives NULL and ''."""
    keep = [c for c in sample.columns if c not in ("human_level", "human_notes")]
    found = labels.select("item_id", "human_level", "human_notes").withColumn("_hit", F.lit(True))
    return sample.select(*keep).join(found, "item_id", "left").select(
        *keep,
        F.col("human_level").cast("int").alias("human_level"),
        F.coalesce("human_notes", F.lit("")).alias("human_notes"),
    )
