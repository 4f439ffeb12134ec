"""Corpus preparation: five stages over ``documents``, each reading what the one
before it kept.

Every stage takes any table that has doc_id and text (and lang, where it says so);
other columns pass through unchanged, whatever their names, as they are set aside under
numbers while an operator adds its own.  Repeated rows are rows of their own unless
a stage says otherwise; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brinkcast.llm.arrow import bounded_batches
from brinkcast.llm.jaccard_join import jaccard_components
from brinkcast.llm.language_id import UNKNOWN, identify, learn_profiles, score_limits
from brinkcast.llm.mixing import TARGETS, drawn_copies, fit_domains, fit_rates, labelled_domains, with_posteriors, with_rates
from brinkcast.llm.packing import pack, token_pieces
from brinkcast.llm.queries import table, tokenizer_file
from brinkcast.llm.secrets import find_secrets, redacted
from brinkcast.llm.storage import broadcast_if_small, stored


def _aside(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all columns but ``used`` renamed to numbers, and the way back."""
    names = {c: c if c in used else f"column {i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return renamed, lambda df: df.select(*[F.col(f"`{n}`").alias(c) for c, n in names.items()])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; profiles are learned from the labelled
    languages of the input.  Rejected are texts that are null or without a letter, and
    those whose cosine is below the limit of the language they are nearest to, half of
    what 99 of 100 recognised texts of that language reach (a language of which none
    is recognised has no limit).  Where nothing is labelled nothing is recognised."""
    bounded_batches(spark)
    rows, back = _aside(docs, "text", "lang")
    profiles = learn_profiles(rows)
    limits = score_limits(identify(rows.where("lang is not null").select("text", "lang"), profiles))
    judged = identify(rows, profiles)  # judged again rather than stored once more
    least = F.coalesce(*[F.when(F.col("lang_pred") == name, limit) for name, limit in sorted(limits.items())], F.lit(0.0))
    return back(judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id; of
    rows that share an id one, chosen by a hash of all its columns.  Rows without id
    or without words stay."""
    rows, back = _aside(docs, "doc_id", "text")
    groups = stored(jaccard_components(rows), "groups")
    gone = broadcast_if_small(stored(groups.where("component_id <> doc_id").select("doc_id").distinct(), "gone"))
    kept = rows.join(gone, "doc_id", "left_anti")
    twice = stored(groups.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "twice")
    if twice.limit(1).count():  # only rows that share an id are compared
        twice = broadcast_if_small(twice)
        order = Window.partitionBy("doc_id").orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]))
        one = kept.join(twice, "doc_id", "left_semi").withColumn("_row", F.row_number().over(order)).where("_row = 1").drop("_row")
        kept = kept.join(twice, "doc_id", "left_anti").unionByName(one)
    return back(kept)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every secret replaced and ``n_chars``, if there is one, adapted;
    null texts stay null."""
    rows, back = _aside(docs, "text", "n_chars")
    found = find_secrets(rows).withColumn("text", redacted("text", "spans"))
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return back(found)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate says on average: never for those led by
    toxic, once at least for those led by good and hardly toxic.  Empty texts count for
    nothing and have a rate like others; rows that share id and text are drawn alike."""
    bounded_batches(spark)
    rows, back = _aside(docs, "doc_id", "text")
    model = fit_domains(rows, labelled_domains(table(spark, sf_dir, "labels")))
    judged = with_posteriors(rows, model)  # texts are judged twice, their posteriors alone are stored
    fit = fit_rates(stored(judged.select("tokens", "posterior"), "posteriors"), TARGETS, whole=True)
    rated = with_rates(judged, fit)
    often = F.explode(F.array_repeat(F.lit(0), drawn_copies("rate", "doc_id", "text")))
    return back(rated.withColumn("_copy", often))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: every piece with its ids, sequence and place.  A null or empty text
    is the one id that ends it; copies are packed each by itself; other columns end here."""
    bounded_batches(spark)
    return pack(token_pieces(docs.select("doc_id", "text"), tokenizer_file(), most=150_000), aside=("ids",))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixture", mixture),
    ("packing", packing),
]

#: Models, shingle groups and packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
