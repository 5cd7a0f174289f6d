"""Labels, values and unfilled slots of list items: row-local, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.functions import slots as fn


def label_values(items: DataFrame) -> DataFrame:
    """Add ``label``, ``value`` and ``raw`` to list items.

    The label is what stands before the first colon, whether in a span of its own
    or as bare text, leaving out placeholders and anything in brackets. Without
    such a colon the label is NULL and the value is the whole text. A value may
    contain colons; one that is only a placeholder is NULL. ``raw`` is the value with
    its entities as written, for telling brackets from written ones.
    """
    given = fn.given_text(F.col("content"), F.col("text"))
    rows = items.select("*", given.alias("_given"))
    # An explode of one element: a filter on the label or value is then not pushed
    # below the cut, which would be computed again for every mention of it.
    cut = F.explode(F.array(fn.label_cut(F.col("_given"))))
    rows = rows.select("*", cut.alias("_cut"))
    rows = rows.select("*", fn.cut_label(F.col("_cut"), F.col("_given")).alias("label"))
    raw = fn.cut_raw(F.col("_cut"), F.col("label"), F.col("_given"))
    rows = rows.select(*items.columns, "label", raw.alias("raw"))
    return rows.select(*items.columns, "label", fn.value_of(F.col("raw")).alias("value"), "raw")


def unfilled(items: DataFrame) -> DataFrame:
    """Add ``is_unfilled`` and ``hint`` to labelled items and clear unfilled values.

    An item is unfilled if it has a placeholder span, if its value is wholly in
    brackets, or if nothing is left as its value. So a value is NULL exactly when
    ``is_unfilled`` is true. The hint is the placeholder's or the brackets' text.
    """
    content, value, raw = F.col("content"), F.col("value"), F.col("raw")
    rows = items.select(
        "*",
        fn.has_hint(content).alias("_hinted"),
        fn.is_bracketed(raw).alias("_bracketed"),
    )
    hinted, bracketed = F.col("_hinted"), F.col("_bracketed")
    missing = hinted | bracketed | value.isNull()
    kept = [c for c in items.columns if c not in ("value", "raw")]
    return rows.select(
        *kept,
        F.when(~missing, value).alias("value"),
        fn.hint_of(content, hinted, bracketed, raw).alias("hint"),
        missing.alias("is_unfilled"),
    )


def slots(items: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, pos, item, label, value, hint, is_unfilled) of list items.

    Columns named in ``keep`` are carried along.
    """
    return unfilled(label_values(items)).select(
        "doc_id", "pos", *keep, "item", "label", "value", "hint", "is_unfilled"
    )
