"""Running the operators over a stream."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from sheafwork.sources.documents import stream_documents
from sheafwork.sources.manifest import stream_manifest, stream_manifest_checked
from sheafwork.streaming.upserts import (
    compact,
    compact_latest,
    latest,
    store,
    stored,
    upsert_available,
)

__all__ = [
    "append_available",
    "compact",
    "compact_latest",
    "latest",
    "listing_by_core",
    "store",
    "stored",
    "stream_documents",
    "stream_manifest",
    "stream_manifest_checked",
    "upsert_available",
]

_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def listing_by_core(spark: SparkSession) -> Iterator[None]:
    """Streams that run within list files in a task for each core.

    A micro-batch lists its own files again, else in a task for each, which takes longer than
    reading small ones. The setting is that of the session, so await the query within.
    """
    before = spark.conf.get(_LISTING, None)
    spark.conf.set(_LISTING, spark.sparkContext.defaultParallelism)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_LISTING)
        else:
            spark.conf.set(_LISTING, before)


def append_available(rows: DataFrame, path: str, checkpoint: str, *partition_by: str) -> StreamingQuery:
    """Process the input that is there now and append the rows as Parquet.

    Every operator but the two aggregations is row-local, so it runs on a stream
    as it does on a batch and keeps no state. The file sink's log makes a restart
    after a lost executor or driver write each input once. Both folders have to
    be shared storage. Aggregations go to :func:`upsert_available`.
    """
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
