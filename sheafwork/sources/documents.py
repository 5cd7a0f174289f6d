"""Documents: one row (doc_id, html) each, from HTML files or from a page table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BOM = "\ufeff"
#: Files that one task writes into a folder of its own.
FILES_PER_TASK = 250
PAGES_SCHEMA = "page_id bigint, url string, html string"


def _shape(files: DataFrame) -> DataFrame:
    html = F.col("value")
    return files.select(
        F.col("_metadata.file_path").alias("doc_id"),
        F.when(F.startswith(html, F.lit(_BOM)), F.substring(html, 2, 2**31 - 1))
        .otherwise(html)
        .alias("html"),
    )


def scan_documents(
    spark: SparkSession, path: str | list[str], glob: str | None = None
) -> DataFrame:
    """One row per file, never split at line ends; ``doc_id`` is the file's URI.

    Small files are packed into tasks, but one file is one value in one task.
    For volume runs write the result to Parquet once and start from that.
    """
    reader = spark.read
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return _shape(reader.text(path, wholetext=True))


def write_documents(documents: DataFrame, folder: str) -> None:
    """``documents(doc_id, html)`` as a file each, below one folder a task.

    Making a file takes far longer than rendering one, so they are dealt out by their number, not
    by the size of the table, and no file needs a folder to itself. Forms of one ``doc_id`` that
    one task rendered share a file, a line end apart. Tasks put their own files into place, under
    names that a repeated task takes again, so the driver does not move them one by one.
    """
    tasks = max(1, -(-documents.count() // FILES_PER_TASK))
    rows = documents.withColumn("number", F.monotonically_increasing_id())
    rows = rows.repartition(tasks, "doc_id").groupBy("doc_id", F.shiftright("number", 33))
    forms = F.array_sort(F.collect_list(F.struct("number", "html")))
    value = F.array_join(F.transform(forms, lambda form: form["html"]), "\n")
    files = rows.agg(value.alias("value")).select(F.spark_partition_id().alias("part"), "value")
    options = {"maxRecordsPerFile": 1, "mapreduce.fileoutputcommitter.algorithm.version": 2}
    files.write.partitionBy("part").options(**options).text(folder)


def stream_documents(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """:func:`scan_documents` over the files arriving in a directory."""
    reader = spark.readStream
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _shape(reader.text(path, wholetext=True))


def documents_from_pages(pages: DataFrame) -> DataFrame:
    """The (doc_id, html) view of a page table; no other column is read."""
    return pages.select(F.col("page_id").alias("doc_id"), "html")

