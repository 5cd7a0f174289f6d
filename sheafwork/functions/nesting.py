"""Places of items in nested lists, worked out on the array of a section's tokens.

A token is an item, the start of a list or the end of one. A running count of starts and
ends gives each token its depth, and the list that holds an item is the one started last
at the item's depth. So the tokens are sorted by depth, and what a token needs to know of
earlier ones of its depth is carried along each depth once. No list of open lists is kept,
so the work does not grow with their number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A fold copies its state at every step, so one that gathered all states would cost the
# square of a long section. Chunks bound what a fold gathers.
_CHUNK = 128

ITEM, START, END = 0, 1, -1
# Kinds of events: an item, a list started below, and a list started at the event's depth.
_ITEM, _BELOW, _HERE = 0, 1, 2


def _running(
    rows: DataFrame, values: str, out: str, start: Column, step: Callable[[Column, Column], Column]
) -> DataFrame:
    """Add the states after each element of a fold, whose state has a fixed size."""

    def walk(chunk: Column, states: Column) -> Column:
        return F.aggregate(
            chunk, states, lambda had, x: F.array_append(had, step(F.element_at(had, F.lit(-1)), x))
        )

    places = F.sequence(F.lit(1), F.greatest(F.size(values), F.lit(1)), F.lit(_CHUNK))
    rows = rows.withColumn("_chunks", F.transform(places, lambda at: F.slice(values, at, F.lit(_CHUNK))))
    starts = F.aggregate(
        F.slice("_chunks", F.lit(1), F.size("_chunks") - 1),
        F.array(start),
        lambda states, chunk: F.array_append(
            states, F.aggregate(chunk, F.element_at(states, F.lit(-1)), step)
        ),
    )
    parts = F.transform(
        F.arrays_zip(F.col("_chunks").alias("chunk"), starts.alias("start")),
        lambda z: F.slice(walk(z["chunk"], F.array(z["start"])), F.lit(2), F.lit(_CHUNK)),
    )
    return rows.withColumn(out, F.flatten(parts)).drop("_chunks")


def with_places(rows: DataFrame, steps: str, out: str) -> DataFrame:
    """Add an array of ``(depth, parent)`` for the items among ``steps``, in order.

    ``depth`` is the number of lists open at the item; ``parent`` is the number, from 1, of
    the item that holds the innermost of them, NULL if none does. An end without an open
    list means nothing.
    """
    zero, none = F.lit(0), F.lit(None).cast("int")
    counts = F.struct(zero.alias("depth"), zero.alias("items"), zero.alias("lists"))
    rows = _running(
        rows,
        steps,
        "_counts",
        counts,
        lambda had, x: F.struct(
            F.greatest(had["depth"] + x, F.lit(0)).alias("depth"),
            (had["items"] + (x == ITEM).cast("int")).alias("items"),
            (had["lists"] + (x == START).cast("int")).alias("lists"),
        ),
    )

    def event(depth: Column, place: Column, kind: int, number: Column) -> Column:
        return F.struct(
            depth.alias("depth"), place.alias("place"), F.lit(kind).alias("kind"), number.alias("number")
        )

    def events(token: Column, place: Column) -> Column:
        counted = token["counts"]
        depth, none_ = counted["depth"], F.array(event(zero, zero, _ITEM, zero))
        return (
            F.when(token["step"] == ITEM, F.array(event(depth, place, _ITEM, counted["items"])))
            .when(
                token["step"] == START,
                F.array(
                    event(depth - 1, place, _BELOW, counted["lists"]),
                    event(depth, place, _HERE, counted["lists"]),
                ),
            )
            .otherwise(F.slice(none_, 1, 0))
        )

    tokens = F.arrays_zip(F.col(steps).alias("step"), F.col("_counts").alias("counts"))
    rows = rows.withColumn("_events", F.sort_array(F.flatten(F.transform(tokens, events))))

    # Along a depth: the latest item of the list started last, and the number of that list.
    carried = F.struct(F.lit(-1).alias("depth"), none.alias("item"), none.alias("list"))

    def carry(had: Column, x: Column) -> Column:
        same = had["depth"] == x["depth"]
        item, list_ = F.when(same, had["item"]), F.when(same, had["list"])
        return F.struct(
            x["depth"].alias("depth"),
            F.when(x["kind"] == _ITEM, x["number"]).when(x["kind"] == _BELOW, item).alias("item"),
            F.when(x["kind"] == _HERE, x["number"]).otherwise(list_).alias("list"),
        )

    rows = _running(rows, "_events", "_carried", carried, carry)
    known = F.arrays_zip(F.col("_events").alias("event"), F.col("_carried").alias("carried"))
    rows = rows.withColumn("_known", known)
    below = F.filter("_known", lambda x: x["event"]["kind"] == _BELOW)
    holders = F.sort_array(F.transform(below, lambda x: F.struct(x["event"]["number"], x["carried"]["item"].alias("item"))))
    items = F.filter("_known", lambda x: x["event"]["kind"] == _ITEM)
    items = F.transform(
        items,
        lambda x: F.struct(
            x["event"]["number"].alias("number"), x["event"]["depth"].alias("depth"), x["carried"]["list"].alias("list")
        ),
    )
    rows = rows.withColumns({"_holders": holders, "_items": F.sort_array(items)})

    def place(x: Column) -> Column:
        # Asking for the size as well keeps the optimizer from computing the array in here.
        holder = F.when(x["list"] <= F.size("_holders"), F.get("_holders", x["list"] - 1)["item"])
        return F.struct(x["depth"].alias("depth"), holder.alias("parent"))

    rows = rows.withColumn(out, F.transform("_items", place))
    return rows.drop("_counts", "_events", "_carried", "_known", "_holders", "_items")
