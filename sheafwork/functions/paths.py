"""Column expressions over file paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def join_path(directory: Column, name: Column) -> Column:
    """Directory and name joined by exactly one slash; NULL if either is NULL."""
    slash = F.lit("/")
    return F.concat(F.rtrim(directory, slash), slash, F.ltrim(name, slash))
