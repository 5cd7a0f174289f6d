"""List items and their nesting: row-local, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafwork.functions import markup, nesting

# Stands for an item's tag in the copy of a section that the tokens are read from. In
# that copy the section's own such characters become another one.
_CONTROL, _OTHER = "\x01", "\x02"
_MARK = "<" + _CONTROL
# The tag of a list ends at the next item's at the latest.
_TOKEN = rf"(?i)<(?:{_CONTROL}|/?[ou]l(?:\s[^>{_CONTROL}]*)?(?:>|(?={_MARK})|\z))"


def _bodies(rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """(doc_id, pos, keep, body) of sections, or of whole documents at position 0."""
    if "body" in rows.columns:
        return rows.select("doc_id", "pos", *keep, "body")
    body = markup.without_hidden(F.col("html"))
    return rows.select("doc_id", F.lit(0).alias("pos"), *keep, body.alias("body"))


def _items(
    rows: DataFrame, keep: tuple[str, ...], fragment: Column, *extra: Column
) -> DataFrame:
    """Explode ``pieces`` to ``piece``, passing over what stands before any item."""
    # The outer form keeps the optimizer from adding a filter on the array's size,
    # which would compute the split twice; the array is never empty.
    rows = rows.select(
        "doc_id", "pos", *keep, F.posexplode_outer("pieces").alias("item", "piece")
    ).where(F.col("item") > 0)
    rows = rows.select("*", markup.item_content(fragment).alias("content"))
    return rows.select(
        "doc_id",
        "pos",
        *keep,
        "item",
        fragment.alias("fragment"),
        "content",
        markup.plain_fragment(F.col("content")).alias("text"),
        *extra,
    )


def list_items(rows: DataFrame, *keep: str) -> DataFrame:
    """(doc_id, pos, item, fragment, content, text): one row per ``li``, in order.

    ``rows`` are sections, or whole documents, whose items then have position 0.
    An item begins at its tag and ends at its closing tag or at the next item,
    so an outer item ends where its nested list's first item starts. ``content``
    is its markup, ``text`` the same without tags, ``fragment`` the markup up to
    the next item. Columns named in ``keep`` are carried along.
    """
    pieces = F.split("body", markup.ITEM_OPEN)
    return _items(_bodies(rows, keep).withColumn("pieces", pieces), keep, F.col("piece"))


def item_tree(rows: DataFrame, *keep: str) -> DataFrame:
    """:func:`list_items` with ``depth`` and ``parent_item``.

    Depth is the number of lists open at the item within its section. The parent
    is the number of the item that holds the item's list, NULL if none does; any
    depth of nesting is followed. A section's items all come from one input value,
    so their places are worked out on the array before it is exploded: no window,
    and no shuffle of the text.
    """
    fragments = F.split("body", markup.ITEM_OPEN)
    staged = _bodies(rows, keep).withColumn("fragments", fragments)
    clean = F.transform("fragments", lambda x: F.replace(x, F.lit(_CONTROL), F.lit(_OTHER)))
    marked = F.array_join(clean, _MARK)
    tokens = F.regexp_extract_all(marked, F.lit(_TOKEN), F.lit(0))
    steps = F.transform(
        tokens,
        lambda x: F.when(x == _MARK, nesting.ITEM)
        .when(F.startswith(x, F.lit("</")), nesting.END)
        .otherwise(nesting.START),
    )
    staged = nesting.with_places(staged.withColumn("_steps", steps), "_steps", "_nested")
    none = F.lit(None).cast("int")
    before = F.array(F.struct(none.alias("depth"), none.alias("parent")))
    staged = staged.withColumn("places", F.concat(before, "_nested"))
    # The places go into the elements and not beside them: an array kept as a
    # column would be copied with each of its items.
    pieces = F.arrays_zip(
        F.col("fragments").alias("fragment"), F.col("places").alias("place")
    )
    fragment, place = F.col("piece")["fragment"], F.col("piece")["place"]
    return _items(
        staged.withColumn("pieces", pieces),
        keep,
        fragment,
        place["depth"].alias("depth"),
        place["parent"].alias("parent_item"),
    )
