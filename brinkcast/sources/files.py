"""Transcripts, audit labels, samples and reports as files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AUDIT_SCHEMA = (
    "item_id long, stratum string, clean_text string, llm_level string, llm_confidence double, "
    "llm_target_type string, llm_target_name string, human_level string, human_target_type string, "
    "human_target_name string, human_notes string"
)


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """One row per caption file; bytes that are not UTF-8 become the replacement sign."""
    files = spark.read.text(path, wholetext=True)
    return files.select(
        F.col("_metadata.file_path").alias("path"), F.make_valid_utf8("value").alias("text")
    )


def read_audit_labels(spark: SparkSession, path: str) -> DataFrame:
    """Audit lines; levels are read as text and cast, NULL where they are no number."""
    rows = spark.read.schema(AUDIT_SCHEMA).json(path)
    return rows.withColumns(
        {
            "llm_level": F.col("llm_level").try_cast("int"),
            "human_level": F.col("human_level").try_cast("int"),
        }
    )


def usable_labels(rows: DataFrame) -> DataFrame:
    return rows.where("llm_level is not null and human_level is not null")


def skipped_labels(rows: DataFrame) -> DataFrame:
    """One row: how many audit lines have both levels and how many were skipped."""
    both = F.col("llm_level").isNotNull() & F.col("human_level").isNotNull()
    return rows.agg(F.count_if(both).alias("n"), F.count_if(~both).alias("n_skipped"))


def write_sample_jsonl(sample: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Sample rows with blank human fields for the annotator; NULLs are written out."""
    blank = F.lit(None)
    rows = sample.select(
        "item_id",
        "stratum",
        "clean_text",
        "llm_level",
        "llm_confidence",
        "llm_target_type",
        "llm_target_name",
        blank.cast("int").alias("human_level"),
        blank.cast("string").alias("human_target_type"),
        blank.cast("string").alias("human_target_name"),
    )
    rows.write.mode(mode).option("ignoreNullFields", "false").json(path)


def write_report_json(report: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A report (one nested row) as JSON."""
    report.write.mode(mode).option("ignoreNullFields", "false").json(path)
