"""Exact duplicates against immutable snapshots that have binary-fuse filters.

A snapshot holds the distinct texts of the batches so far, in buckets by their digest, and
a static filter for each bucket. An incoming batch is first grouped by itself, so a text
that half of it shares is one class. The digests of its classes, not their texts, meet the
filters; only the classes that pass meet the texts of the exact bucket, byte by byte. What
is not found there becomes the next snapshot, and what is found counts for the class there.

Texts are equal when they are after leaving out ASCII white space.
"""

from __future__ import annotations

import dataclasses
import functools
import math
from collections.abc import Callable
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafwork.llm import fuse
from sheafwork.llm.tables import written

#: Batches that :func:`deduplicate` takes a table as.
BATCHES = 2
#: Keys of a bucket, which one task has at once.
KEYS_PER_BUCKET = 4_096

_BLANK = " \t\n\v\f\r"
_TURN = Decimal(2**65)
_LAST = Decimal(2**63)


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


@dataclasses.dataclass(frozen=True)
class Snapshot:
    """Classes ``(class_id, digest, normal, best, size)`` and filters ``(bucket, filter)``."""

    classes: DataFrame
    filters: DataFrame
    buckets: int


def keyed(docs: DataFrame, digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """``(doc_id, rank, digest, normal)``: the larger ``rank`` is the row that stays.

    Rank counts the text's code points first, then prefers a small ``doc_id``, and any to
    none. It is one number, so that a class's best row is a plain maximum.
    """
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    normal = F.translate("text", _BLANK, "")
    place = F.coalesce(F.lit(_LAST) - F.col("doc_id"), F.lit(0))
    rank = F.char_length("text").cast("decimal(10,0)") * F.lit(_TURN) + place.cast("decimal(20,0)")
    return docs.select(
        "doc_id", rank.cast("decimal(32,0)").alias("rank"), digest(normal).alias("digest"), normal.alias("normal")
    )


def classes(rows: DataFrame, batch: int = 0, batches: int = 1) -> DataFrame:
    """The distinct texts of a batch, written: ``(class_id, digest, normal, best, size)``.

    Copies are summed up within each task before a text is exchanged. The ids of the
    classes differ between the batches.
    """
    grouped = rows.groupBy("digest", "normal").agg(F.max("rank").alias("best"), F.count("*").alias("size"))
    class_id = F.monotonically_increasing_id() * batches + batch
    return written(grouped.select(class_id.alias("class_id"), "digest", "normal", "best", "size"))


def _bucketed(frame: DataFrame, buckets: int, *columns: str) -> DataFrame:
    bucket = F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(buckets).cast("long"))
    return frame.select(bucket.alias("bucket"), F.xxhash64("digest").alias("key"), *columns)


def _filter(rows: pa.Table) -> pa.Table:
    keys = rows["key"].to_numpy().view(np.uint64)
    return pa.table({"bucket": rows["bucket"][:1], "filter": pa.array([fuse.build(keys)], pa.binary())})


def snapshot(fresh: DataFrame) -> Snapshot:
    """The snapshot of written classes."""
    buckets = max(1, math.ceil(fresh.count() / KEYS_PER_BUCKET))
    keys = _bucketed(fresh, buckets)
    filters = keys.groupBy("bucket").applyInArrow(_filter, "bucket long, filter binary")
    return Snapshot(fresh, written(filters), buckets)


def _passing(keys: pa.Table, filters: pa.Table) -> pa.Table:
    passed = np.zeros(keys.num_rows, bool)
    if keys.num_rows and filters.num_rows:
        passed = fuse.holds(filters["filter"][0].as_py(), keys["key"].to_numpy().view(np.uint64))
    return keys.select(["class_id"]).filter(pa.array(passed))


def screened(arrived: DataFrame, known: Snapshot) -> DataFrame:
    """``(class_id)`` of the classes whose digest passes the snapshot's filters."""
    keys = _bucketed(arrived, known.buckets, "class_id")
    return (
        keys.groupBy("bucket").cogroup(known.filters.groupBy("bucket")).applyInArrow(_passing, "class_id long")
    )


def matched(arrived: DataFrame, known: Snapshot) -> DataFrame:
    """``(class_id, known_id, best, size)`` of the classes that the snapshot has, checked by bytes."""
    possible = arrived.join(screened(arrived, known), "class_id", "left_semi")
    there = known.classes.select(F.col("class_id").alias("known_id"), "digest", "normal")
    return possible.join(there, ["digest", "normal"]).select("class_id", "known_id", "best", "size")


def _attached(rows: DataFrame, found: DataFrame, texts: DataFrame) -> DataFrame:
    """Every row with its class's ``(best, size)``.

    Adaptive execution splits a class that a large share of the rows belongs to, since
    the classes' side of the join is unique. ``rows`` bring their text along, which is
    read only where texts with the same digest differ.
    """
    bare = rows.drop("normal")
    clashing = written(found.groupBy("digest").count().where("count > 1").select("digest"))
    if clashing.isEmpty():
        return bare.join(found.drop("class_id"), "digest")
    plain = found.join(clashing, "digest", "left_anti").drop("class_id")
    told_apart = found.join(clashing, "digest", "left_semi").join(texts, "class_id").drop("class_id")
    apart = rows.join(clashing, "digest", "left_semi").join(told_apart, ["digest", "normal"])
    return bare.join(plain, "digest").unionByName(apart.drop("normal"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.union, frames)


def deduplicate(
    docs: DataFrame, batches: int = BATCHES, digest: Callable[[Column], Column] = sha256
) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)`` for every row of ``docs(doc_id, text)``.

    The rows are taken as ``batches`` that arrive one after another, dealt by their id.
    Of equal texts the row with the most code points stays, of these the one with the
    smallest ``doc_id``; ``keep_id`` is its id and ``group_size`` counts the rows. Null is
    an empty text, and empty texts are equal to one another and to blank ones. Rows that
    agree in ``doc_id`` and length share their answer, so repeated rows may all be kept. A
    row without ``doc_id`` is counted and loses to any row that has one and is as long;
    where none has, ``keep_id`` is null and the longest rows are kept. Further columns are
    not read.
    """
    docs = docs.select("doc_id", "text")
    turn = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(batches).cast("long"))
    snapshots, counted, texts = [], [], []
    for batch in range(batches):
        arrived = classes(keyed(docs.where(turn == batch), digest), batch, batches)
        texts.append(arrived.select("class_id", "digest", "normal"))
        if snapshots:
            again = written(_union([matched(arrived, known) for known in snapshots]))
            counted.append(again.select(F.col("known_id").alias("class_id"), "best", "size"))
            arrived = arrived.join(again, "class_id", "left_anti")
        counted.append(arrived.select("class_id", "best", "size"))
        if batch + 1 < batches:
            snapshots.append(snapshot(written(arrived) if snapshots else arrived))
    total = _union(counted).groupBy("class_id").agg(F.max("best").alias("best"), F.sum("size").alias("size"))
    every = _union(texts)
    total = written(total.join(every.select("class_id", "digest"), "class_id"))
    rows = _attached(keyed(docs, digest), total, every.select("class_id", "normal"))
    place = F.col("best") % F.lit(_TURN)
    keep_id = F.when(place > 0, (F.lit(_LAST) - place).cast("long"))
    return rows.select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("rank") == F.col("best")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
