"""Jobs over web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.functions.markup import LANG, blank_to_null, first_group, without_hidden
from sheafwork.operators.items import list_items


def items_per_language(documents: DataFrame) -> DataFrame:
    """(lang, items): number of list items in the pages of each language.

    The language travels with the page, so nothing is joined. Items are counted
    within each task first: one row per language and task is exchanged, and a
    language that most pages share is no heavier than another.
    """
    visible = F.explode(F.array(without_hidden(F.col("html")))).alias("body")
    rows = documents.select("doc_id", F.lit(0).alias("pos"), visible)
    rows = rows.select("*", first_group(F.col("body"), LANG).alias("lang"))
    items = list_items(rows, "lang")
    return items.groupBy("lang").agg(F.count("*").alias("items"))


def page_manifest(pages: DataFrame) -> DataFrame:
    """Manifest rows of a page table: the address cut at its last slash."""
    url = F.col("url")
    return pages.select(
        F.col("page_id").cast("string").alias("mid"),
        blank_to_null(F.regexp_extract(url, r"(?s)\A(.*/)[^/]*\z", 1)).alias("base_directory"),
        blank_to_null(F.regexp_extract(url, r"([^/]*)\z", 1)).alias("file_name"),
    )


def careless_manifests(pages: DataFrame, pages_per_file: int) -> DataFrame:
    """(part, value): whole manifest files of the pages' addresses, as a careless writer leaves them.

    A query in the address is written as one more field, and an address with a fragment is not cut
    into directory and name, so its row has a field less.
    """
    url, mid = F.col("url"), F.col("page_id").cast("string")
    name = F.regexp_extract(url, r"([^/]*)\z", 1)
    cut = F.concat_ws(",", mid, F.left(url, F.length(url) - F.length(name)), name)
    line = F.when(F.contains(url, F.lit("#")), F.concat_ws(",", mid, url)).when(
        F.contains(url, F.lit("?")), F.replace(cut, F.lit("?"), F.lit(","))
    ).otherwise(cut)
    part = F.floor(F.col("page_id") / pages_per_file).cast("int").alias("part")
    lines = pages.where("url IS NOT NULL").select(part, "page_id", line.alias("line"))
    ordered = F.array_sort(F.collect_list(F.struct("page_id", "line")))
    text = F.array_join(F.transform(ordered, lambda x: x["line"]), "\n")
    header = "mid,base_directory,file_name\n"
    return lines.groupBy("part").agg(F.concat(F.lit(header), text).alias("value"))
