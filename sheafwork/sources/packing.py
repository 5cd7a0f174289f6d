"""Many small files into few large ones: HTML files to Parquet row groups of a bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheafwork.session import drop_folder, shared_folder
from sheafwork.sources.documents import scan_documents

GROUP_BYTES = 128 << 20

#: Files whose sizes one task sums up.
_FILES_PER_PART = 100_000
# What Parquet keeps of a row beside its two values.
_ROW_BYTES = 16


def file_sizes(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """``(doc_id, bytes)`` of files, which are listed and not opened."""
    reader = spark.read.format("binaryFile")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    name = F.col("_metadata.file_path")
    size = F.col("_metadata.file_size") + F.octet_length(name) + _ROW_BYTES
    return reader.load(path).select(name.alias("doc_id"), size.alias("bytes"))


def assigned(sizes: DataFrame, group_bytes: int) -> DataFrame:
    """``(doc_id, bytes, pack)``: packs of neighbouring files, numbered from 0 without a gap.

    Half a group is cut off at a time from the running sum of the sizes, so a file that straddles a
    cut keeps its pack below ``group_bytes``. A file of over half a group is a pack by itself. The
    running sum is taken in ranges of names: their totals first, one row each, then within each.
    """
    spark, folder = sizes.sparkSession, shared_folder(sizes.sparkSession)
    half = max(1, group_bytes // 2)
    large = F.col("bytes") > half
    sizes = sizes.select("*", large.cast("long").alias("large"), F.when(large, 0).otherwise(F.col("bytes")).alias("small"))
    parts = max(1, -(-sizes.count() // _FILES_PER_PART))
    ranged = sizes.repartitionByRange(parts, "doc_id").withColumn("part", F.spark_partition_id())
    ranged.write.parquet(folder)
    ranged = spark.read.schema(ranged.schema).parquet(folder)
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    totals = ranged.groupBy("part").agg(F.sum("small").alias("small"), F.sum("large").alias("large"))
    starts = totals.select(
        "part",
        F.coalesce(F.sum("small").over(before), F.lit(0)).alias("small_before"),
        F.coalesce(F.sum("large").over(before), F.lit(0)).alias("large_before"),
    )
    last = ranged.where("large = 0").agg(F.sum("small").alias("whole"), F.max_by("small", "doc_id").alias("own")).first()
    small_packs = 0 if last.whole is None else (last.whole - last.own) // half + 1
    within = W.partitionBy("part").orderBy("doc_id").rowsBetween(W.unboundedPreceding, -1)
    rows = ranged.join(starts, "part").select(
        "doc_id",
        "bytes",
        "large",
        (F.col("small_before") + F.coalesce(F.sum("small").over(within), F.lit(0))).alias("start"),
        (F.col("large_before") + F.coalesce(F.sum("large").over(within), F.lit(0))).alias("rank"),
    )
    # No small file is longer than a half, so one starts in every half up to the last one.
    alone = F.lit(small_packs) + F.col("rank")
    pack = F.when(F.col("large") == 1, alone).otherwise(F.floor(F.col("start") / half))
    return rows.select("doc_id", "bytes", pack.cast("int").alias("pack"))


def pack_documents(
    spark: SparkSession,
    path: str | list[str],
    folder: str,
    group_bytes: int = GROUP_BYTES,
    glob: str | None = None,
) -> DataFrame:
    """Write the files as Parquet, a file and a row group for each pack, and read them back.

    The rows are those of :func:`scan_documents`, sorted by name within a row group, and the groups are
    ranges of names, so a filter on ``doc_id`` reads few of them. Uncompressed, a row group has at
    most ``group_bytes``, or a single file. The contents are exchanged once when the list of packs
    is small enough for Spark to broadcast, else twice.
    """
    lists = shared_folder(spark)
    assigned(file_sizes(spark, path, glob), group_bytes).write.parquet(lists)
    packs = spark.read.schema("doc_id string, bytes long, pack int").parquet(lists)
    count = (packs.agg(F.max("pack").alias("last")).first().last or 0) + 1
    rows = scan_documents(spark, path, glob).join(packs.select("doc_id", "pack"), "doc_id")
    rows = rows.repartitionById(count, F.col("pack")).sortWithinPartitions("doc_id")
    options = {"parquet.block.size": 2 * group_bytes + (1 << 20)}
    rows.select("doc_id", "html").write.options(**options).parquet(folder)
    drop_folder(spark, lists)
    return read_packed(spark, folder)


def read_packed(spark: SparkSession, folder: str) -> DataFrame:
    """The documents of :func:`pack_documents`."""
    return spark.read.schema("doc_id string, html string").parquet(folder)
