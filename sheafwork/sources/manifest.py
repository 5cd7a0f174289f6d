"""Manifest files: headered CSV rows of (mid, base_directory, file_name)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Header of a manifest file, all text.
MANIFEST_SCHEMA = "mid string, base_directory string, file_name string"


#: Options that write what :func:`scan_manifest` reads back as it was.
WRITE_OPTIONS = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


_COLUMNS = ("mid", "base_directory", "file_name")
_ROW = "_rejected_row"


def _options(reader, mode: str, multi_line: bool, schema: str = MANIFEST_SCHEMA):
    # Without enforceSchema=False a file with other headers would be read by
    # position and pass unnoticed; without columnPruning=False a row of another
    # length would, when some columns are not asked for.
    return (
        reader.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("columnPruning", False)
        .option("encoding", "UTF-8")
        .option("escape", '"')
        .option("multiLine", multi_line)
        .option("mode", mode)
    )


def scan_manifest(
    spark: SparkSession,
    path: str | list[str],
    mode: str = "FAILFAST",
    multi_line: bool = False,
) -> DataFrame:
    """Rows of one manifest file, a directory of them, or a list of paths.

    Each file has its own header and may start with a byte order mark. An empty
    field is NULL, a quote inside quotes is doubled. Files are split and packed into
    tasks by their size. A row with too few or too many fields is an error; mode
    ``PERMISSIVE`` fills it up or cuts it. ``multi_line`` allows line ends inside
    quotes, and a file is then read by one task.
    """
    return _options(spark.read, mode, multi_line).csv(path)


def stream_manifest(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    mode: str = "FAILFAST",
    multi_line: bool = False,
) -> DataFrame:
    """:func:`scan_manifest` over the files arriving in a directory."""
    reader = _options(spark.readStream, mode, multi_line)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def _checked(reader, multi_line: bool, path: str | list[str]) -> DataFrame:
    schema = f"{MANIFEST_SCHEMA}, {_ROW} string"
    reader = _options(reader, "PERMISSIVE", multi_line, schema).option("columnNameOfCorruptRecord", _ROW)
    row = F.col(_ROW)
    # Separators outside quotes; a doubled quote ends one quoted part and begins the next.
    bare = F.regexp_replace(row, r'"[^"]*+(?:"|\z)', "")
    rejected = F.struct(
        F.col("_metadata.file_path").alias("file"),
        row.alias("row"),
        (F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1).cast("int").alias("fields"),
    )
    rows = reader.csv(path).select(*_COLUMNS, F.when(row.isNotNull(), rejected).alias("rejected"))
    # An explode of one element: a query that asks for rejects alone, and is then left with no
    # column of the file, would be refused.
    whole = F.explode(F.array(F.struct(*_COLUMNS, "rejected"))).alias("whole")
    fields = [F.when(F.col("whole.rejected").isNull(), F.col(f"whole.{c}")).alias(c) for c in _COLUMNS]
    return rows.select(whole).select(*fields, F.col("whole.rejected").alias("rejected"))


def scan_manifest_checked(
    spark: SparkSession, path: str | list[str], multi_line: bool = False
) -> DataFrame:
    """:func:`scan_manifest` with the rows of another length told apart, not failing.

    The column ``rejected`` is NULL for a good row. For any other it has the ``file``, the ``row`` as
    it is written there and its number of ``fields``, and the other columns are NULL. One pass
    gives both: write the rows by :func:`store_checked`, or filter. A wrong header is
    still an error, since it makes every row of its file doubtful.
    """
    return _checked(spark.read, multi_line, path)


def stream_manifest_checked(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """:func:`scan_manifest_checked` over the files arriving in a directory."""
    reader = spark.readStream
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _checked(reader, multi_line, path)


def store_checked(rows: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Write checked rows in one pass and read the good ones and the rejects back.

    Good rows have the manifest's columns, rejects have ``file``, ``row`` and ``fields``. Each
    kind is a folder, so reading one does not touch the other.
    """
    is_rejected = F.col("rejected").isNotNull()
    rows.withColumn("is_rejected", is_rejected).write.partitionBy("is_rejected").parquet(folder)
    schema = f"{MANIFEST_SCHEMA}, rejected struct<file:string,row:string,fields:int>, is_rejected boolean"
    back = rows.sparkSession.read.schema(schema).parquet(folder)
    return back.where("NOT is_rejected").select(*_COLUMNS), back.where("is_rejected").select("rejected.*")
