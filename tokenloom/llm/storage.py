"""Tables written to the shared folder: they cut the lineage and survive lost executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tokenloom.session import scratch_path

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    The shuffle files of the write go with it: nothing reads them again, and those of a chain of steps
    would otherwise fill the executors' disks until the driver happens to collect garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
