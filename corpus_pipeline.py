"""The corpus pipeline: stages over ``documents``, each written and read again.

Every stage works on the rows that its predecessor kept and returns the columns of
``documents``; the last returns the pieces of packed sequences. Rows are kept as they
are but for what a stage decides: ``n_chars`` follows the text, and nothing else changes.
Rows that share a ``doc_id`` are judged each by its own text, and so are rows without one: the
classifier decides by id and a hash of the text, the near-duplicate stage by a number that it
gives each row. A label counts for every row with its ``doc_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafwork.llm import decontaminate, minhash, packing, pii, quality
from sheafwork.llm.queries import TOKENIZER
from sheafwork.llm.tables import table, written


def _lean(spark: SparkSession) -> None:
    """Let Python workers give arrays of a megabyte and more back when they are done with them.

    The stages follow one another in the same workers, and what a stage has freed would else stay
    with them beside what the next one takes.
    """
    spark.sparkContext.environment.setdefault("MALLOC_MMAP_THRESHOLD_", str(1 << 20))


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` as the text now is."""
    return docs.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def _unused(docs: DataFrame) -> str:
    """A name that no column has."""
    name = "row"
    while name in docs.columns:
        name += "_"
    return name


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the classifier accepts."""
    _lean(spark)
    row = _unused(docs)
    keyed = docs.withColumn(row, F.xxhash64("doc_id", "text"))
    judged = quality.classify(keyed, table(spark, sf_dir, "labels"), row).where("accepted")
    judged = judged.select("doc_id", row).distinct().alias("judged")
    same = F.col(f"keyed.{row}") == F.col(f"judged.{row}")
    same &= F.col("keyed.doc_id").cast("long").eqNullSafe(F.col("judged.doc_id"))
    return keyed.alias("keyed").join(judged, same, "left_semi").drop(row)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the row with the smallest ``doc_id``; rows without one come last."""
    _lean(spark)
    row = _unused(docs)
    docs = written(docs.withColumn(row, F.monotonically_increasing_id()))
    found = minhash.near_duplicates(docs.select(F.col(row).alias("doc_id"), "text"))
    found = found.select(F.col("doc_id").alias(row), "component_id")
    places = docs.select(row, F.struct(F.col("doc_id").isNull(), "doc_id", row).alias("place"))
    first = found.join(places, row).groupBy("component_id").agg(F.min("place").alias("place"))
    return docs.join(first.select(F.col(f"place.{row}").alias(row)), row, "left_semi").drop(row)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their benchmark passages."""
    _lean(spark)
    return _counted(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with personal data masked."""
    _lean(spark)
    return _counted(pii.redact(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences."""
    _lean(spark)
    return packing.pack(docs, TOKENIZER, lean=True)


STAGES = [
    ("quality classifier", quality_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("PII", pii_stage),
    ("packing", packing_stage),
]

#: No stage can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
