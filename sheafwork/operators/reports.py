"""Summaries over slots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafwork.functions import markup
from sheafwork.functions import slots as fn


def completeness(slot_rows: DataFrame, *keys: str) -> DataFrame:
    """(keys, slots, filled, ratio): slots and filled slots per key.

    Without keys it is one row, whose ratio is NULL if there are no slots at all.

    Counts are summed within each task before the exchange, so at most one row per
    key and task moves, however many slots a key has. Works on a stream too, but with a
    key such as the document its state grows for ever: :func:`completeness_windows` has a
    time to expire it by. Counts per document need no exchange: see
    :func:`completeness_documents`.
    """
    return _counts(slot_rows, *keys)


def _counts(slot_rows: DataFrame, *keys: str | Column) -> DataFrame:
    counts = slot_rows.groupBy(*keys).agg(
        F.count("*").alias("slots"), F.count("value").alias("filled")
    )
    return counts.select("*", F.try_divide("filled", "slots").alias("ratio"))


def completeness_windows(
    slot_rows: DataFrame, *keys: str, time: str, width: str, delay: str
) -> DataFrame:
    """(window_start, keys, slots, filled, ratio): :func:`completeness` by windows of event time.

    ``time`` is a column of the slots, ``width`` the windows' length. On a stream a window's counts are
    kept until an event ``delay`` past the window's end has been seen; then they are dropped, and rows
    that come still later are not counted. So the state is that of the windows within ``delay`` of the
    latest event, however long the stream runs. On a batch all rows count, those without a
    time not, in either case. In output mode ``update``, with
    ``streaming.upsert_available`` and ``streaming.latest``, the rows of a stream without late
    events are those of the batch; ``append`` gives each window once, when it is over.
    """
    rows = slot_rows.withWatermark(time, delay) if slot_rows.isStreaming else slot_rows
    counts = _counts(rows.where(F.col(time).isNotNull()), F.window(time, width).alias("_window"), *keys)
    return counts.select(
        F.col("_window.start").alias("window_start"), *keys, "slots", "filled", "ratio"
    )


def wide(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """One row per document with a column per label, from long rows.

    ``pairs`` has (doc_id, pos, item, label, value). A label that a document has
    more than once gives its first value in document order, one that it has not
    gives NULL. The labels are known, so this is one aggregation by document with
    one exchange, of one row per document and task; a pivot on the label takes two.
    The aggregation sorts, so values of other labels are dropped before it. Documents
    that are still whole need neither: :func:`wide_documents` is the first choice.
    """
    named = F.col("label").isin(list(labels))
    pairs = pairs.select("doc_id", "pos", "item", "label", F.when(named, F.col("value")).alias("value"))

    def first_value(label: str) -> Column:
        wanted = (F.col("label") == label) & F.col("value").isNotNull()
        place = F.struct("pos", "item", "value")
        return F.min(F.when(wanted, place))["value"].alias(label)

    return pairs.groupBy("doc_id").agg(*map(first_value, labels))


def wide_parts(pairs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """What some long rows say of the documents' wide records: (doc_id, parts).

    ``parts`` has, for each label, the first of its values among these rows, with its place. Parts of
    any split of the rows, also of repeated ones, merge into the record of all of them: see
    :func:`merge_parts` and :func:`wide_of_parts`.
    """
    named = F.col("label").isin(list(labels))
    pairs = pairs.select("doc_id", "pos", "item", "label", F.when(named, F.col("value")).alias("value"))

    def first_value(number: int, label: str) -> Column:
        wanted = (F.col("label") == label) & F.col("value").isNotNull()
        return F.min(F.when(wanted, F.struct("pos", "item", "value"))).alias(f"part{number}")

    return pairs.groupBy("doc_id").agg(*(first_value(n, label) for n, label in enumerate(labels)))


def merge_parts(parts: DataFrame) -> DataFrame:
    """One row a document from rows of :func:`wide_parts`."""
    names = [c for c in parts.columns if c.startswith("part")]
    return parts.groupBy("doc_id").agg(*(F.min(c).alias(c) for c in names))


def wide_of_parts(parts: DataFrame, labels: Sequence[str]) -> DataFrame:
    """:func:`wide` from rows of :func:`wide_parts`."""
    values = [F.col(f"part{n}.value").alias(label) for n, label in enumerate(labels)]
    return merge_parts(parts).select("doc_id", *values)


def _with_pairs(documents: DataFrame) -> DataFrame:
    """(doc_id, items, pairs): how many items a document has, and its filled slots.

    All the items of a document are in its one value, so its labels are read from
    the array of items before any row is exploded.
    """
    visible = markup.without_hidden(F.col("html"))
    fragments = F.split(visible, markup.ITEM_OPEN)
    rows = documents.select("doc_id", fragments.alias("fragments"))
    rows = rows.select(
        "doc_id",
        F.transform(
            F.slice("fragments", F.lit(2), F.size("fragments")), markup.item_content
        ).alias("contents"),
    )
    # A slot with a placeholder has no value to give.
    rows = rows.select(
        "doc_id",
        F.size("contents").cast("long").alias("items"),
        F.filter("contents", lambda c: ~fn.has_hint(c)).alias("contents"),
    )
    rows = rows.select(
        "doc_id", "items", F.transform("contents", markup.plain_fragment).alias("texts")
    )
    rows = rows.select("*", F.transform("texts", fn.label_cut).alias("cuts"))
    rows = rows.select("*", F.zip_with("cuts", "texts", fn.cut_label).alias("labels"))
    cuts = F.arrays_zip("texts", "cuts", "labels")
    raws = F.transform(cuts, lambda c: fn.cut_raw(c["cuts"], c["labels"], c["texts"]))
    rows = rows.select("doc_id", "items", "labels", raws.alias("raws"))
    rows = rows.select("*", F.transform("raws", fn.value_of).alias("values"))
    pairs = F.filter(
        F.arrays_zip("raws", "labels", "values"),
        lambda p: ~fn.is_bracketed(p["raws"]) & p["values"].isNotNull(),
    )
    # An explode of one element: a filter on a label's column is then not pushed
    # below all of this, which would be computed again for every mention of it.
    return rows.select("doc_id", "items", F.explode(F.array(pairs)).alias("pairs"))


def wide_documents(documents: DataFrame, labels: Sequence[str]) -> DataFrame:
    """:func:`wide` straight from documents: row-local, no shuffle."""

    def first_value(label: str) -> Column:
        found = F.filter("pairs", lambda pair: pair["labels"] == label)
        return F.get(found, F.lit(0))["values"].alias(label)

    return _with_pairs(documents).select("doc_id", *map(first_value, labels))


def completeness_documents(documents: DataFrame) -> DataFrame:
    """:func:`completeness` by document straight from documents: row-local, no shuffle.

    A document without slots is a row of zeros with a NULL ratio.
    """
    filled = F.size("pairs").cast("long")
    return _with_pairs(documents).select(
        "doc_id",
        F.col("items").alias("slots"),
        filled.alias("filled"),
        F.try_divide(filled, "items").alias("ratio"),
    )


def label_map(documents: DataFrame) -> DataFrame:
    """(doc_id, slots): a map of every label a document has to its first value.

    For labels that are not known in advance; row-local, no shuffle. Slots without a
    label or a value are not in it, and a repeated label has its first value.
    """
    numbered = F.transform(
        "pairs",
        lambda pair, place: F.struct(
            pair["labels"].alias("label"), place.alias("place"), pair["values"].alias("value")
        ),
    )
    ordered = F.array_sort(F.filter(numbered, lambda x: x["label"].isNotNull()))
    rows = _with_pairs(documents).select("doc_id", ordered.alias("ordered"))
    labels = F.transform("ordered", lambda x: x["label"])
    before = F.concat(F.array(F.lit(None).cast("string")), labels)
    first = F.filter(
        F.zip_with(
            "ordered",
            F.slice(before, F.lit(1), F.size("ordered")),
            lambda x, last: F.when(~x["label"].eqNullSafe(last), F.struct(x["label"], x["value"])),
        ),
        lambda x: x.isNotNull(),
    )
    return rows.select("doc_id", F.map_from_entries(first).alias("slots"))
