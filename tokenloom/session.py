"""Session settings, checkpoint folder and scratch paths."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tokenloom", cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.tokenloom.scanPartitions", cores if cores.isdigit() else "")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def scan_partitions(spark: SparkSession) -> int | None:
    """How many tasks a CPU-heavy scan is dealt to; unset leaves the splits of the files as they are."""
    number = spark.conf.get("spark.tokenloom.scanPartitions", None)
    return int(number) if number else None


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster the
    executors could not see it, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    path = os.path.join(tempfile.gettempdir(), f"tokenloom-{os.getpid()}")
    os.makedirs(path, exist_ok=True)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for one run of one writer."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: it cuts the plan and outlives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
