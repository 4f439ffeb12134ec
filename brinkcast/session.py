"""Session helpers.

On a cluster the caller owns the session; nothing here overrides what the
cluster already names.  ``local_session`` exists for tests and the bench.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "brinkcast", **conf: str) -> SparkSession:
    """A UTC session on the local machine, adaptive execution on."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.driver.memory", os.environ.get("BRINKCAST_DRIVER_MEMORY", "8g"))
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """All times are UTC: epoch arithmetic and NTZ casts rely on it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def bounded_batches(spark: SparkSession, most: int = 4_000_000) -> None:
    """From now on in this session an Arrow batch takes about ``most`` bytes, unless the
    session asks for less: a task holds each batch several times, on both sides."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", spark.conf.get(setting).strip().lower()).groups()
    if int(number) * 1024 ** " kmgtp".index(unit or " ") > most:
        spark.conf.set(setting, str(most))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the one the cluster names.

    Only a session on one machine (tests, bench) gets a temporary folder where
    it names none; on a cluster that would be a different folder on each
    executor, so there it is an error.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="brinkcast-checkpoint-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder
