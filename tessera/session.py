"""Session helpers: one place for the settings every job in the library relies on."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera") -> SparkSession:
    """Local / test session. On a cluster the launcher owns these settings."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators assume: UTC wall clock (dates are calendar days) and a
    checkpoint folder. The cluster's ``spark.checkpoint.dir`` always wins; a scratch
    folder is only made for a local master without one (tests); on a cluster its absence
    is an error, since executors would write to disks that nobody else sees."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # the lag frames of the forecasts (dozens of derived columns) spend minutes in constraint
    # inference otherwise: var_forecast did not end within ten minutes with it switched on
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    configured = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(configured)
        return configured
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def table_path(spark: SparkSession, name: str) -> str:
    """Shared location for intermediate tables that cut lineage (under the checkpoint dir)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}"
