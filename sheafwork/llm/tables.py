"""Written tables between the steps of an operator."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.session import shared_folder


#: Whether Spark deletes a query's shuffle files when it has ended, not when the driver collects garbage.
_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(frame: DataFrame, cleaned: bool = False) -> DataFrame:
    """The frame, computed once, written to the shared folder and read back.

    It cuts lineage: what is read back survives lost executors, and nothing above is
    computed again. The files stay as long as the session's shared folder does. ``cleaned`` is
    for frames that nothing else is computed from: what they exchanged is deleted at once.
    """
    spark = frame.sparkSession
    folder = shared_folder(spark)
    before = spark.conf.get(_CLEANED, "false")
    if cleaned:
        spark.conf.set(_CLEANED, "true")
    try:
        frame.write.parquet(folder)
    finally:
        if cleaned:
            spark.conf.set(_CLEANED, before)
    return spark.read.schema(frame.schema).parquet(folder)


def kept(frame: DataFrame) -> DataFrame:
    """The frame, computed once when it is first needed, on the executors' disks.

    What a lost executor had is computed again. No file is written to the shared folder: where
    Hadoop's native library is missing, each file written to a local one starts a process,
    which for a moment counts as large as the executor. The rows stay until the session's
    cache is cleared.
    """
    # The mark keeps the rows from another call whose input has changed since.
    mark = F.lit(uuid.uuid4().int >> 65).alias("_call")
    return frame.select("*", mark).persist(StorageLevel.DISK_ONLY).drop("_call")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
