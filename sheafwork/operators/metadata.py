"""Document metadata and text: one output row per document, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.functions import markup


def document_metadata(documents: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, lang, charset, title, h1); an absent or empty field is NULL.

    Scripts, styles and comments are not read. The character set is that of the
    first ``meta`` tag with such an attribute or standing for the content type.
    Columns named in ``keep`` are carried along.
    """
    html = F.col("visible")
    title = F.regexp_extract(html, markup.TITLE, 1)
    h1 = F.regexp_extract(html, markup.H1, 1)
    visible = markup.without_hidden(F.col("html")).alias("visible")
    # An explode of one element: the optimizer does not repeat it for every field.
    visible = F.explode(F.array(visible)).alias("visible")
    charsets = [markup.first_group(html, markup.CHARSET, group) for group in (1, 2, 3)]
    return documents.select("doc_id", *keep, visible).select(
        "doc_id",
        *keep,
        markup.first_group(html, markup.LANG).alias("lang"),
        F.coalesce(*charsets).alias("charset"),
        markup.blank_to_null(markup.plain_fragment(title)).alias("title"),
        markup.blank_to_null(markup.plain_fragment(h1)).alias("h1"),
    )


def document_text(documents: DataFrame) -> DataFrame:
    """(doc_id, text): the whole visible text and the title, entities left encoded."""
    return documents.select("doc_id", markup.plain(F.col("html")).alias("text"))
