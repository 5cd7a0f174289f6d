"""Sections of a document and their headings: row-local, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.functions import markup


def sections(documents: DataFrame, *keep: str, preamble: bool = False) -> DataFrame:
    """(doc_id, pos, heading, body): one row per ``h2`` section, in order.

    The body runs to the next ``h2`` or the end of the document and has no
    scripts, styles or comments. With ``preamble`` the part before the first
    ``h2`` comes as position 0 without a heading. Columns named in ``keep`` are
    carried along.
    """
    pieces = F.split(markup.without_hidden(F.col("html")), markup.H2_OPEN)
    # The outer form only keeps the optimizer from computing the split a second
    # time for a filter on its size; the array is never empty.
    rows = documents.select(
        "doc_id", *keep, F.posexplode_outer(pieces).alias("pos", "piece")
    )
    rows = rows.where(F.col("pos") >= (0 if preamble else 1))
    cut = F.split("piece", markup.H2_CLOSE, 2)
    closed = (F.col("pos") > 0) & (F.size("cut") == 2)
    return rows.select("*", cut.alias("cut")).select(
        "doc_id",
        *keep,
        "pos",
        F.when(closed, markup.plain_fragment(F.get("cut", F.lit(0)))).alias("heading"),
        F.when(closed, F.get("cut", F.lit(1))).otherwise(F.col("piece")).alias("body"),
    )


def parse_heading(section_rows: DataFrame) -> DataFrame:
    """Add ``no``, ``title`` and ``marker`` read from ``N. title (marker)``.

    A heading without a leading number has a NULL ``no``; the marker is the text
    of a parenthesis at the very end, NULL if there is none. A number with further
    digits behind its dot, or one that is too large, is part of the title.
    """
    heading = F.col("heading")
    number = F.regexp_extract(heading, r"^([0-9]+)\.(?![0-9])", 1).try_cast("int")
    rest = F.when(number.isNull(), heading).otherwise(
        F.regexp_replace(heading, r"^[0-9]+\.", "")
    )
    parts = r"(?s)\A\s*(.*?)\s*(?:\(([^()]*)\))?\z"
    return section_rows.select(
        "*",
        number.alias("no"),
        markup.blank_to_null(F.regexp_extract(rest, parts, 1)).alias("title"),
        markup.blank_to_null(F.regexp_extract(rest, parts, 2)).alias("marker"),
    )
