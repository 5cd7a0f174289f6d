"""Results of a stream that changes rows it has given before.

A micro-batch writes its rows to a folder of its own, named by its number. A batch that runs again,
after a lost driver for instance, replaces its folder, so repeating it changes nothing. Readers
take, by key, what the latest batch says, or merge the batches by a rule that does not
mind repeats. Folders that are not finished are not read. :func:`compact` merges finished batches
into one, so their number stays small.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructType

from sheafwork.session import drop_folder

#: Number of the micro-batch that a stored row comes from.
BATCH = "batch"

Change = Callable[[DataFrame], DataFrame]


def store(rows: DataFrame, folder: str, number: int) -> None:
    """Write a batch's rows under its number, in place of an earlier try."""
    numbered = rows.withColumn(BATCH, F.lit(number).cast("long"))
    numbered.write.mode("overwrite").parquet(f"{folder}/batch-{number}")


def upsert_available(
    rows: DataFrame, folder: str, checkpoint: str, change: Change | None = None, mode: str = "update"
) -> StreamingQuery:
    """Process the input that is there now, storing what each micro-batch gives.

    ``change`` is applied to each batch, a summary for instance. In mode ``update`` an aggregation gives
    the rows that a batch changed, whole, so the latest row of a key is the right one. Both
    folders have to be shared storage.
    """

    def write(batch: DataFrame, number: int) -> None:
        store(change(batch) if change else batch, folder, number)

    return (
        rows.writeStream.outputMode(mode)
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _finished(spark: SparkSession, folder: str, kind: str) -> list[int]:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{kind}-*/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(int(x.getPath().getParent().getName().rsplit("-", 1)[1]) for x in found or [])


def _folders(spark: SparkSession, folder: str) -> tuple[list[str], list[int], list[int]]:
    """Folders to read, and the finished numbers of merged and of single batches."""
    merged, batches = _finished(spark, folder, "merged"), _finished(spark, folder, "batch")
    newest = merged[-1:]
    read = [f"{folder}/merged-{n}" for n in newest]
    return read + [f"{folder}/batch-{n}" for n in batches if not newest or n > newest[0]], merged, batches


def _numbered(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add(BATCH, LongType())


def stored(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    """All rows of finished batches, with the number of their batch. ``schema`` is that of the rows."""
    read, _, _ = _folders(spark, folder)
    if not read:
        return spark.createDataFrame([], _numbered(schema))
    return spark.read.schema(_numbered(schema)).parquet(*read)


def latest(rows: DataFrame, *keys: str) -> DataFrame:
    """For each key the row of its latest batch; a batch has a key once."""
    others = [c for c in rows.columns if c not in keys and c != BATCH]
    newest = F.max_by(F.struct(*others), BATCH)
    return rows.groupBy(*keys).agg(newest.alias("newest")).select(*keys, "newest.*")


def compact(spark: SparkSession, folder: str, schema: StructType, merge: Change) -> None:
    """Merge all finished batches but the newest, which may run again, into one folder.

    ``merge`` takes stored rows and gives rows of the same schema, that is with a number of a
    batch. The old folders go once the new one is finished; what a stopped attempt leaves behind is
    not read. Not to be called while the stream runs.
    """
    _, merged, batches = _folders(spark, folder)
    fresh = [n for n in batches[:-1] if not merged or n > merged[-1]]
    if not fresh:
        return
    read = [f"{folder}/merged-{n}" for n in merged[-1:]] + [f"{folder}/batch-{n}" for n in fresh]
    rows = spark.read.schema(_numbered(schema)).parquet(*read)
    merge(rows).select(rows.columns).write.mode("overwrite").parquet(f"{folder}/merged-{fresh[-1]}")
    old = [f"{folder}/merged-{n}" for n in merged] + [f"{folder}/batch-{n}" for n in batches if n <= fresh[-1]]
    for path in old:
        drop_folder(spark, path)


def compact_latest(spark: SparkSession, folder: str, schema: StructType, *keys: str) -> None:
    """:func:`compact` for rows that are read by :func:`latest`."""

    def merge(rows: DataFrame) -> DataFrame:
        others = [c for c in rows.columns if c not in keys]
        newest = F.max_by(F.struct(*others), BATCH).alias("newest")
        return rows.groupBy(*keys).agg(newest).select(*keys, "newest.*")

    compact(spark, folder, schema, merge)
