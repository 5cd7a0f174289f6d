"""How far the sources of a language differ in their words.

Identical texts of a language are one row with a count for each source, so a text is cut
into terms once, and its counts are weighted. Terms that too few documents have are left
out, and pairs of sources are compared on the counts that are there: a pair in which no
source has a term differs by the same amount for every such term.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheafwork.llm.hashing import raw
from sheafwork.llm.tables import written

#: Documents of a language that a kept term is in, at least.
LEAST_DOCUMENTS = 30
#: Ranks of the part ``term``.
TOP = 50

SMOOTHED = 5
_STEP = 1_000
# Counts that a task holds before it passes them on.
_HELD = 1_000_000
# Terms of a slice and sources of a tile: a comparison's array has at most their product.
_SLICE_TERMS = 4_096
_TILE_SOURCES = 128

# Letters of terms: A-Z as a-z, and every byte of a character beyond ASCII. All else is blank.
_LETTERS = bytes(
    b if b >= 0x80 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)

_COUNTED = pa.schema(
    [("lang", pa.string()), ("term", pa.string()), ("source", pa.string()), ("count", pa.int64()), ("docs", pa.int64())]
)


def terms(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weighted counts and documents by language, source and term, as far as a task sees."""
    counts: dict[tuple[str, str], Counter[bytes]] = defaultdict(Counter)
    docs: dict[tuple[str, str], Counter[bytes]] = defaultdict(Counter)

    def passed_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), held in counts.items():
            found, several = list(held), docs[lang, source]
            columns = [
                pa.DictionaryArray.from_arrays(np.zeros(len(found), np.int32), [lang]).cast(pa.string()),
                pa.array(found, pa.binary()).cast(pa.string()),
                pa.DictionaryArray.from_arrays(np.zeros(len(found), np.int32), [source]).cast(pa.string()),
                pa.array(held.values(), pa.int64()),
                pa.array([several[term] for term in found], pa.int64()),
            ]
            yield pa.record_batch(columns, schema=_COUNTED)
        counts.clear(), docs.clear()

    size = 0
    for batch in batches:
        for lang, sources, text in zip(batch["lang"].to_pylist(), batch["sources"].to_pylist(), raw(batch["text"])):
            found = terms(text)
            distinct = set(found)
            for source in sources:
                own, several, number = counts[lang, source["source"]], docs[lang, source["source"]], source["n"]
                size -= len(own)
                if number == 1:
                    own.update(found), several.update(distinct)
                else:
                    for term, times in Counter(found).items():
                        own[term] += number * times
                        several[term] += number
                size += len(own)
            if size >= _HELD:
                yield from passed_on()
                size = 0
    yield from passed_on()


def collapsed(docs: DataFrame) -> DataFrame:
    """``(lang, sources, text)``: each text of a language once, with ``(source, n)`` for each source.

    Texts are told apart by their SHA-256. Copies are summed up within each task, so a text that
    a third of all rows have is one row a task; then only its digest meets its sources.
    """
    rows = docs.select("lang", "source", F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    sources = rows.groupBy("lang", "digest", "source").agg(F.count("*").alias("n"))
    sources = sources.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("sources"))
    texts = rows.groupBy("lang", "digest").agg(F.first("text").alias("text"))
    return texts.join(sources, ["lang", "digest"]).select("lang", "sources", "text")


def kept_counts(docs: DataFrame) -> DataFrame:
    """``(lang, term, source, count, total)`` of kept terms, ``total`` over the language's sources."""
    counted = collapsed(docs).mapInArrow(
        _counts, "lang string, term string, source string, count long, docs long"
    )
    # What a task passes on is summed up already, so one exchange by term serves all that follows.
    counted = counted.repartition("lang", "term").groupBy("lang", "term", "source")
    counted = counted.agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    term = W.partitionBy("lang", "term")
    counted = counted.withColumns({"total": F.sum("count").over(term), "within": F.sum("docs").over(term)})
    return counted.where(F.col("within") >= LEAST_DOCUMENTS).select("lang", "term", "source", "count", "total")


def _probability(count: Column, size: Column) -> Column:
    """``1 + floor(10**9 * (count + 5) / size)`` in whole numbers, three digits at a time.

    No product exceeds a thousand times ``size``, so a language may have some 9e15 occurrences.
    """
    left, value = count + SMOOTHED, F.lit(0).cast("long")
    for _ in range(3):
        left = left * _STEP
        value = value * _STEP + F.call_function("div", left, size)
        left = left % size
    return value + 1


def _probabilities(counts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """:func:`_probability` of arrays."""
    left, value = counts + SMOOTHED, np.zeros(np.broadcast(counts, size).shape, np.int64)
    for _ in range(3):
        whole, left = np.divmod(left * _STEP, size)
        value = value * _STEP + whole
    return value + 1


def groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """A row for each ``(lang, source)`` that occurs, with and without kept terms.

    ``own_size`` and ``lang_size`` are the divisors of the probabilities of the source and of its
    language, ``n_terms`` the language's kept terms, ``slices`` and ``tiles`` the parts
    that its terms and its sources are compared in.
    """
    occurring = docs.select("lang", "source").distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("count").alias("own"))
    each = kept.select("lang", "term", "total").distinct().groupBy("lang")
    each = each.agg(F.count("*").alias("n_terms"), F.sum("total").alias("whole"))
    sources = occurring.groupBy("lang").agg(F.count("*").alias("n_sources"))
    found = occurring.join(own, ["lang", "source"], "left").join(sources, "lang").join(each, "lang", "left")
    found = found.fillna(0, ["own", "n_terms", "whole"])
    smooth = SMOOTHED * F.col("n_terms")
    return found.select(
        "lang",
        "source",
        "n_terms",
        (F.col("own") + smooth).alias("own_size"),
        (F.col("whole") + smooth).alias("lang_size"),
        F.greatest(F.lit(1), F.ceil(F.col("n_terms") / _SLICE_TERMS)).cast("int").alias("slices"),
        F.ceil(F.col("n_sources") / _TILE_SOURCES).cast("int").alias("tiles"),
    )


def _tiled(rows: DataFrame) -> DataFrame:
    """Every row in each pair of tiles that its source's tile is in."""
    tile = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    rows = rows.withColumn("tile", tile).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    down, across = F.least("tile", "other").alias("down"), F.greatest("tile", "other").alias("across")
    return rows.select("lang", "slice", down, across, "source", "tile", "own_size", "term", "count")


def _differences(rows: pa.Table) -> pa.Table:
    """What a slice of terms adds to the differences between the sources of two tiles.

    A row without a term stands for its source. A source's probability of a term that it
    lacks is one and the same number, so a pair starts from the difference of those
    for every term, and only the slice's terms that one of the tiles has correct it.
    """
    lang, down, across = (rows[c][0].as_py() for c in ("lang", "down", "across"))
    stands = rows["term"].is_null().to_numpy()
    sources, place = np.unique(np.array(rows["source"].to_pylist(), object), return_inverse=True)
    found, column = np.unique(np.array(rows["term"].to_pylist(), object)[~stands], return_inverse=True)
    size, tile = np.ones(len(sources), np.int64), np.zeros(len(sources), np.int64)
    size[place], tile[place] = rows["own_size"].to_numpy(), rows["tile"].to_numpy()
    counts = np.zeros((len(sources), len(found)), np.int64)
    counts[place[~stands], column] = rows["count"].to_numpy()[~stands]
    lacking = _probabilities(np.zeros(len(sources), np.int64), size)
    chances = _probabilities(counts, size[:, None])
    others = np.flatnonzero(tile == across)
    one, two, value = [], [], []
    for i in np.flatnonzero(tile == down):
        apart = np.abs(chances[others] - chances[i]).sum(1) - len(found) * np.abs(lacking[others] - lacking[i])
        one.append(np.full(len(others), i)), two.append(others), value.append(apart)
    one, two, value = map(np.concatenate, (one, two, value))
    keep = one != two
    one, two, value = one[keep], two[keep], value[keep]
    if down != across:
        one, two, value = np.r_[one, two], np.r_[two, one], np.r_[value, value]
    return pa.table(
        {
            "lang": pa.array([lang] * len(one), pa.string()),
            "source": pa.array(sources[one], pa.string()),
            "item": pa.array(sources[two], pa.string()),
            "more": pa.array(value, pa.int64()),
        }
    )


def pairs(kept: DataFrame, found: DataFrame) -> DataFrame:
    """``(lang, source, item, value)``: each source against each other one of its language.

    A language's terms are dealt to slices and its sources to tiles, so that no task
    has a whole language, and a slice adds one row a pair, not one a term.
    """
    slice_ = F.pmod(F.xxhash64("term"), F.col("slices")).cast("int").alias("slice")
    counts = kept.join(found, ["lang", "source"]).select(
        "lang", "source", "own_size", "tiles", "term", "count", slice_
    )
    stand = found.where("n_terms > 0").select(
        "lang",
        "source",
        "own_size",
        "tiles",
        F.lit(None).cast("string").alias("term"),
        F.lit(0).cast("long").alias("count"),
        F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"),
    )
    tiles = _tiled(counts.unionByName(stand)).groupBy("lang", "slice", "down", "across")
    parts = tiles.applyInArrow(_differences, "lang string, source string, item string, more long")
    # Where a language keeps no term, every pair differs by nothing.
    others = found.where("n_terms = 0").select("lang", F.col("source").alias("item"))
    nothing = found.where("n_terms = 0").join(others, "lang").where("source <> item")
    parts = parts.union(nothing.select("lang", "source", "item", F.lit(0).cast("long")))
    summed = parts.groupBy("lang", "source", "item").agg(F.sum("more").alias("more"))
    lacking = F.when(F.col("n_terms") > 0, _probability(F.lit(0).cast("long"), F.col("own_size"))).otherwise(0)
    own = found.select("lang", "source", "n_terms", lacking.alias("lacking"))
    other = own.select("lang", F.col("source").alias("item"), F.col("lacking").alias("lacking_item"))
    whole = summed.join(own, ["lang", "source"]).join(other, ["lang", "item"])
    apart = F.abs(F.col("lacking") - F.col("lacking_item"))
    return whole.select("lang", "source", "item", (F.col("more") + F.col("n_terms") * apart).alias("value"))


def overused(kept: DataFrame, found: DataFrame) -> DataFrame:
    """``(lang, source, item, value)``: kept terms that a source has more often than its language."""
    rows = kept.join(found, ["lang", "source"])
    value = _probability(F.col("count"), F.col("own_size")) - _probability(F.col("total"), F.col("lang_size"))
    return rows.select("lang", "source", F.col("term").alias("item"), value.alias("value")).where("value > 0")


def audit(docs: DataFrame) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` for ``docs(text, lang, source)``.

    The part ``pair`` has for each source the other sources of its language by the sum of
    the differences of their terms' probabilities, the part ``term`` its 50 most
    overused terms. Ranks are by value, descending, then by item. Null is an empty text,
    language or source; texts without terms count as documents and as occurrences of their source
    only. Rows are counted whatever their ids are, repeated ones each time. An
    empty table, or a language with one source and no kept term, gives no rows. Further columns
    are not read.
    """
    read = [F.coalesce(c, F.lit("")).alias(c) for c in ("text", "lang", "source")]
    docs = docs.select(*read)
    kept = written(kept_counts(docs))
    found = written(groups(docs, kept))
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pair = pairs(kept, found).withColumns({"part": F.lit("pair"), "rank": F.row_number().over(order)})
    term = overused(kept, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)
    return pair.select(columns).union(term.withColumn("part", F.lit("term")).select(columns))
