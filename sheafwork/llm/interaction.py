"""How filters interact: what each one removes after the others, in every order.

Four filters look at a text alone. The fifth asks whether a row with a smaller id has the
same text, and a counting Bloom filter spares most texts that question: every text
counts in a few cells, the counts of all tasks are added up, and a text with a cell of its own
is unique. Only the others are exchanged, whole, for the smallest id of each text. All that
the orders need are counts by the set of filters that a document fails, which add up over
sources and tasks.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.hashing import raw
from sheafwork.llm.tables import kept

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50  # per cent of the words
MOST_CAPITALS = 2  # per cent of the code points
MARKS = b"#$%&*|"

#: Cells of the sketch a text: eight, up to the most, 2**27 cells or 16 MB of bits. Beyond
#: some 20 million texts a growing share of the unique ones is exchanged too.
CELLS_PER_TEXT = 8
MOST_CELLS = 1 << 27
CELLS = 3
_SECTION = 1 << 15

_CAPITALS = bytes(range(0x41, 0x5B))
_CONTINUED = bytes(range(0x80, 0xC0))
_DUPLICATE = 1 << FILTERS.index("E")
_MARKED = "doc_id long, source string, text string, mask int, digest binary, one long, two long, three long"

Digest = Callable[[bytes], bytes]


def failed(text: bytes) -> int:
    """The filters A to D that a text fails, as bits."""
    words = text.split()
    points = len(text.translate(None, _CONTINUED))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
        | (100 * capitals > MOST_CAPITALS * points) << 2
        | (len(text.translate(None, MARKS)) < len(text)) << 3
    )


def _cells(digests: list[bytes], cells: int) -> np.ndarray:
    """The cells of each text, a row each."""
    words = np.frombuffer(b"".join(digests), "<u4").reshape(-1, 4)[:, :CELLS].astype(np.int64)
    return words % cells


def marked(docs: DataFrame, cells: int, digest: Digest, with_text: bool = False) -> DataFrame:
    """``(doc_id, source, text, mask, digest, one, two, three)``; the text is null unless wanted."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = raw(batch["text"])
            digests = [digest(text) for text in texts]
            columns = [
                batch["doc_id"],
                batch["source"],
                batch["text"] if with_text else pa.nulls(len(texts), pa.string()),
                pa.array(np.fromiter(map(failed, texts), np.int32, len(texts))),
                pa.array(digests, pa.binary()),
                *map(pa.array, _cells(digests, cells).T),
            ]
            yield pa.record_batch(columns, names=["doc_id", "source", "text", "mask", "digest", "one", "two", "three"])

    return docs.mapInArrow(rows, _MARKED)


def several(rows: DataFrame, cells: int) -> np.ndarray:
    """A bit for each cell: whether more than one row counts in it.

    Counts are added up within each task first, and a section of 32,768 cells reaches the driver
    as one bitmap, so it gets ``cells`` bits at most, however many rows there are.
    """
    # A row counts once in a cell, also where two of its cells are one.
    own = F.explode(F.array_distinct(F.array("one", "two", "three"))).alias("cell")
    counted = rows.select(own).groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    sections = counted.groupBy((F.col("cell") / _SECTION).cast("long").alias("section")).agg(
        F.bitmap_construct_agg(F.col("cell") % _SECTION).alias("bits")
    )
    merged = np.zeros(-(-cells // _SECTION) * _SECTION // 8, np.uint8)
    for row in sections.toLocalIterator():
        start = row.section * _SECTION // 8
        merged[start : start + _SECTION // 8] = np.frombuffer(row.bits, np.uint8)
    return merged


def repeated(docs: DataFrame, sketch: np.ndarray, cells: int, digest: Digest) -> DataFrame:
    """``(digest, text, first)`` of the texts that may be repeated, grouped by their whole content."""
    held = docs.sparkSession.sparkContext.broadcast(sketch)

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = [digest(text) for text in raw(batch["text"])]
            places = _cells(digests, cells)
            bits = held.value[places >> 3] >> (places & 7).astype(np.uint8) & 1
            columns = [batch["doc_id"], pa.array(digests, pa.binary()), batch["text"]]
            names = ["doc_id", "digest", "text"]
            yield pa.record_batch(columns, names=names).filter(pa.array(bits.astype(bool).all(1)))

    found = docs.select("doc_id", "text").mapInArrow(possible, "doc_id long, digest binary, text string")
    return found.groupBy("digest", "text").agg(F.min("doc_id").alias("first"))


def with_duplicates(docs: DataFrame, digest: Digest = xxhash.xxh3_128_digest) -> DataFrame:
    """``(doc_id, source, mask)`` of every row: the filters it fails, as bits from A on.

    The smallest ids join by digest; where texts with one digest differ, by the texts as
    well. Adaptive execution splits a text that many rows have, since the ids' side of the
    join is unique.
    """
    cells = min(MOST_CELLS, max(_SECTION, CELLS_PER_TEXT * docs.count()))
    rows = kept(marked(docs, cells, digest))
    texts = repeated(docs, several(rows, cells), cells, digest)
    firsts = kept(texts.select("digest", "first"))
    clashing = firsts.groupBy("digest").count().where("count > 1").select("digest")
    later = F.when(F.col("doc_id") > F.col("first"), _DUPLICATE).otherwise(0)
    columns = ["doc_id", "source", F.col("mask").bitwiseOR(later).alias("mask")]
    if clashing.isEmpty():
        return rows.drop("text").join(firsts, "digest", "left").select(columns)
    plain = rows.drop("text").join(firsts.join(clashing, "digest", "left_anti"), "digest", "left")
    plain = plain.join(clashing, "digest", "left_anti").select(columns)
    apart = marked(docs, cells, digest, with_text=True).join(clashing, "digest", "left_semi")
    return plain.union(apart.join(texts, ["digest", "text"]).select(columns))


#: What is counted of a document: that it is one, that it is good, that it is toxic.
_COUNTED = ("docs", "good", "toxic")


def mask_counts(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each ``source`` with 32 sums for each of ``docs``, ``good`` and ``toxic``.

    ``rows`` are those of :func:`with_duplicates`. A label counts if any row of ``labels`` with the
    document's id has it.
    """
    marks = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id").agg(
        F.max((F.coalesce("quality", F.lit(0)) == 1).cast("int")).alias("good"),
        F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("int")).alias("toxic"),
    )
    labelled = rows.join(marks.withColumnRenamed("doc_id", "labelled"), F.col("doc_id") == F.col("labelled"), "left")
    values = {"docs": F.lit(1), "good": F.coalesce("good", F.lit(0)), "toxic": F.coalesce("toxic", F.lit(0))}
    sums = [
        F.sum(F.when(F.col("mask") == mask, value).otherwise(0)).alias(f"{name}_{mask}")
        for name, value in values.items()
        for mask in range(1 << len(FILTERS))
    ]
    summed = labelled.groupBy("source").agg(*sums)
    arrays = [F.array(*(f"{name}_{mask}" for mask in range(1 << len(FILTERS)))).alias(name) for name in _COUNTED]
    return summed.select("source", *arrays)


def _orders() -> list[tuple[str, int, int, int]]:
    """(order, step, the step's filter as a bit, the filters before it as bits)."""
    out = []
    for order in itertools.permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            out.append(("".join(order), step, bit, before))
            before |= bit
    return out


_REPORT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps = _orders()
    masks = np.arange(1 << len(FILTERS))
    order, step, bit, before = (np.array(x) for x in zip(*steps))
    fails = (masks & bit[:, None]) > 0
    reached = (masks & before[:, None]) == 0
    removed = fails & reached
    only = masks == bit[:, None]
    for batch in batches:
        for source, *counts in zip(*(batch[c].to_pylist() for c in ("source", *_COUNTED))):
            docs, good, toxic = (np.array(x, np.int64) for x in counts)
            here = removed @ docs
            share = {b: here[bit == b].sum() for b in np.unique(bit)}
            columns = [
                pa.array([source] * len(steps), pa.string()),
                pa.array(order.tolist(), pa.string()),
                pa.array(step, pa.int32()),
                *(
                    pa.array(x, pa.int64())
                    for x in (
                        (reached & ~fails) @ docs,
                        here,
                        (fails & ~reached) @ docs,
                        only @ docs,
                        removed @ good,
                        removed @ toxic,
                        np.array([share[b] for b in bit]),
                    )
                ),
            ]
            yield pa.record_batch(columns, names=[x.split()[0] for x in _REPORT.split(", ")])


def audit(docs: DataFrame, labels: DataFrame, digest: Digest = xxhash.xxh3_128_digest) -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley)``: 600 rows for each source of ``docs(doc_id, text, source)``.

    The filters fail a text with under 200 words (A), with under half of its words distinct (B),
    with over 2 % capitals (C), with any of ``#$%&*|`` (D), and one that a row with a smaller
    ``doc_id`` has (E), in whichever source that row is and whether or not it is removed. Null is an
    empty text or source; an empty text fails A. Rows with one ``doc_id`` and text don't repeat
    each other, rows without ``doc_id`` repeat nothing and no row repeats them, and they
    have no labels. Each row counts, repeated or not. An empty table gives no rows.
    Further columns are not read.
    """
    text, source = (F.coalesce(c, F.lit("")).alias(c) for c in ("text", "source"))
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text, source)
    return mask_counts(with_duplicates(docs, digest), labels).mapInArrow(_reports, _REPORT)
