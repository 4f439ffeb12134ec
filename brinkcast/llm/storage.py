"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brinkcast.session import ensure_checkpoint_dir


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: a lost executor costs no
    more than what is read from that table."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, most: int = 500_000) -> DataFrame:
    """``df``, a stored table of a few numbers a row, with a broadcast hint if it has
    at most ``most`` rows; a larger one is left to Spark's choice of join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
