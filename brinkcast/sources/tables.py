"""Append-only Parquet tables under one folder."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from brinkcast import schemas

TABLES = {
    "sources": schemas.SOURCES,
    "raw_items": schemas.RAW_ITEMS,
    "items": schemas.ITEMS,
    "annotations": schemas.ANNOTATIONS,
    "predictions": schemas.PREDICTIONS,
    "outcomes": schemas.OUTCOMES,
    "panes": "pane long, on_edge boolean, eco_n long, eco_sum long, primary_n long, primary_sum long, "
    "primary_max int, primary_posts long, primary_items long",
    "progress": "watermark long",
    "labels": "label_key string, level int, target_type string, target_name string, rationale string, "
    "confidence double",
}

# What makes a raw row the same post again.
RAW_KEY = ["source_id", "external_id"]

# Time column whose date partitions the table, so that trailing windows prune.
PARTITION_TIME = {
    "raw_items": "published_at",
    "annotations": "annotated_at",
    "predictions": "window_start",
    "outcomes": "window_start",
}


class TableStore:
    """Named tables in a shared folder; a missing one reads as empty."""

    def __init__(self, spark: SparkSession, root: str):
        zone = spark.conf.get("spark.sql.session.timeZone")
        if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
            raise ValueError(f"the session's time zone is {zone}: call pin_utc(spark) first, all times are UTC")
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        schema = TABLES[name]
        stored = schema + (", day date" if name in PARTITION_TIME else "")
        try:
            df = self.spark.read.schema(stored).parquet(self.path(name))
        except AnalysisException as exc:
            if "PATH_NOT_FOUND" not in str(exc):
                raise
            df = self.spark.createDataFrame([], stored)
        return df

    def since(self, name: str, first_day: str) -> DataFrame:
        """The part of a partitioned table from a day on; other partitions are not read."""
        return self.read(name).where(F.col("day") >= F.lit(first_day).cast("date"))

    def append(self, name: str, rows: DataFrame) -> int:
        """Append rows in the table's schema; returns how many, counted while writing."""
        fields = StructType.fromDDL(TABLES[name]).fields
        cells = [
            (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in fields
        ]
        seen = Observation()
        out, daily = rows.select(*cells), name in PARTITION_TIME
        if daily:
            # a day's rows meet in few tasks, and so in few files; a large day is split
            out = out.withColumn("day", F.to_date(PARTITION_TIME[name])).hint("rebalance", "day")
        writer = out.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append")
        (writer.partitionBy("day") if daily else writer).parquet(self.path(name))
        return int(seen.get["n"])
