"""Manifest rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.functions.paths import join_path


def manifest_path(manifest: DataFrame) -> DataFrame:
    """Add ``path``: directory and file name with one slash between, or NULL."""
    path = join_path(F.col("base_directory"), F.col("file_name"))
    return manifest.withColumn("path", path)
