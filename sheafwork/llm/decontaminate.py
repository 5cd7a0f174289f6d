"""Benchmark passages in documents, by q-gram filtering and banded alignment.

A passage with at most k edits keeps ``m + 1 - q (k + 1)`` of an item's q-grams, and
their places differ from it by at most k diagonals. So shared q-grams are counted in
bands of ``2 (k + 1)`` diagonals that overlap by half, bands that reach the bound are
kept, and the item is aligned with the document inside them.

The benchmark is a query set: its items are taken in blocks of bounded size, and each
block meets all documents in one pass that exchanges nothing.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Q = 10
#: One edit is allowed for so many characters of an item.
CHARS_PER_EDIT = 16
#: Code points of the items that are sent to every task at a time, about 20 bytes each.
BLOCK_CHARS = 1 << 20
_SLICE_CHARS = 1 << 19
_GAP = 1 << 12
_ONE = np.uint64(0x9E3779B97F4A7C15)
_TWO = np.uint64(0xC2B2AE3D27D4EB4F)
_TABLE_BITS = 24
_FAR = 1 << 40

Match = tuple[int | None, int, int, int]


def edits_allowed(chars: int) -> int:
    """The budget of an item; its q-gram bound is at least one."""
    return max(0, min(chars // CHARS_PER_EDIT, chars // Q - 1))


def folded(text: str) -> np.ndarray:
    """Code points in lower case, white space as blanks, one for each of the text."""
    lower = text.lower()
    if len(lower) != len(text):
        lower = "".join(x.lower() if len(x.lower()) == 1 else x for x in text)
    codes = np.frombuffer(lower.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int32)
    return np.where((codes <= 32) | (codes == 0xA0), 32, codes)


def _grams(codes: np.ndarray) -> np.ndarray:
    """A hash of the ``Q`` codes from each place on."""
    one = codes.astype(np.uint64)

    def joined(left: np.ndarray, right: np.ndarray, shift: int) -> np.ndarray:
        size = len(right) - shift
        value = left[:size] * _ONE + right[shift:] * _TWO
        return value ^ (value >> np.uint64(29))

    two = joined(one, one, 1)
    four = joined(two, two, 2)
    eight = joined(four, four, 4)
    return joined(eight, two, 8)


@dataclass
class Index:
    """The q-grams of a block of items."""

    ids: list[int | None]
    codes: list[np.ndarray]
    grams: np.ndarray
    item: np.ndarray
    place: np.ndarray
    budget: np.ndarray
    bound: np.ndarray
    known: np.ndarray

    @classmethod
    def of(cls, items: list[tuple[int | None, np.ndarray]]) -> Index:
        grams = [_grams(codes) for _, codes in items]
        sizes = [len(x) for x in grams]
        flat = np.concatenate(grams)
        order = np.argsort(flat, kind="stable")
        known = np.zeros(1 << _TABLE_BITS, bool)
        known[flat >> np.uint64(64 - _TABLE_BITS)] = True
        chars = np.array([len(codes) for _, codes in items])
        budget = np.array([edits_allowed(n) for n in chars])
        return cls(
            [item for item, _ in items],
            [codes for _, codes in items],
            flat[order],
            np.repeat(np.arange(len(items)), sizes)[order],
            np.concatenate([np.arange(n) for n in sizes])[order],
            budget,
            chars + 1 - Q * (budget + 1),
            np.packbits(known),
        )


def _aligned(item: np.ndarray, codes: np.ndarray, low: int, high: int, budget: int) -> list[tuple[int, int, int]]:
    """``(edits, start, end)`` of the best passage within budget at each end, on diagonals ``low`` to ``high``.

    A cell holds edits and where its passage starts, in one number that orders by edits.
    """
    width = high - low + 1
    start = np.arange(low, high + 1)
    unit = np.int64(1) << 32
    steps = np.arange(width) * unit
    none = np.int64(_FAR) << 20
    padded = np.full(len(item) + width + 1, -1, np.int64)
    first, last = max(0, low), min(len(codes), high + len(item))
    padded[first - low : last - low] = codes[first:last]
    cells = np.where((start >= 0) & (start <= len(codes)), start, none)
    for row in range(1, len(item) + 1):
        cost = cells + unit * (padded[row - 1 : row - 1 + width] != item[row - 1])
        cost[:-1] = np.minimum(cost[:-1], cells[1:] + unit)
        cells = np.minimum.accumulate(cost - steps) + steps
        ends = start + row
        cells[(ends < 0) | (ends > len(codes))] = none
        if cells.min() >= (budget + 1) * unit:
            return []
    hit = np.flatnonzero(cells < (budget + 1) * unit)
    return list(zip((cells[hit] >> 32).tolist(), (cells[hit] & (unit - 1)).tolist(), (low + hit + len(item)).tolist()))


def _apart(matches: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Passages that do not overlap, by place: those with fewest edits first, then those that start first."""
    starts: list[int] = []
    taken: list[tuple[int, int, int]] = []
    for match in sorted(matches):
        _, start, end = match
        k = bisect.bisect_left(starts, end)
        if start < end and (k == 0 or taken[k - 1][2] <= start):
            starts.insert(k, start), taken.insert(k, match)
    return taken


def _all_aligned(
    item: np.ndarray, codes: np.ndarray, bands: list[tuple[int, int]], budget: int
) -> list[tuple[int, int, int]]:
    """``(edits, start, end)`` of passages on the bands' diagonals: no other is left between them.

    A text that repeats itself has several in a band, and the best one at an end may overlap one that
    is taken; so what lies between is aligned again until nothing is found there.
    """
    taken: list[tuple[int, int, int]] = []
    free = [(0, len(codes))]
    while free:
        found, left = [], []
        for begin, end in free:
            inside = []
            for low, high in bands:
                low, high = max(low, begin - budget), min(high, end - len(item) + budget)
                if low <= high:
                    inside += _aligned(item, codes[begin:end], low - begin, high - begin, budget)
            own = [(edits, begin + x, begin + y) for edits, x, y in _apart(inside)]
            found += own
            edges = [begin, *(x for _, *place in own for x in place), end]
            if own:
                left += [(x, y) for x, y in zip(edges[::2], edges[1::2]) if y - x >= len(item) - budget]
        taken += found
        free = left
    return taken


def _candidates(index: Index, codes: np.ndarray, known: np.ndarray) -> list[tuple[int, int, int]]:
    """``(item, low, high)``: diagonals of bands that reach an item's bound, joined."""
    grams = _grams(codes)
    hits = np.flatnonzero(known[grams >> np.uint64(64 - _TABLE_BITS)])
    left = np.searchsorted(index.grams, grams[hits], "left")
    right = np.searchsorted(index.grams, grams[hits], "right")
    times = right - left
    hits, left, times = hits[times > 0], left[times > 0], times[times > 0]
    if not len(hits):
        return []
    entry = np.repeat(left - np.cumsum(times) + times, times) + np.arange(times.sum())
    item = index.item[entry]
    step = index.budget[item] + 1
    band = (np.repeat(hits, times) - index.place[entry] + _FAR // 2) // step
    keys = np.concatenate([item * _FAR + band, item * _FAR + band - 1])
    keys, counts = np.unique(keys, return_counts=True)
    keys = keys[counts >= index.bound[keys // _FAR]]
    out: list[tuple[int, int, int]] = []
    for key in keys:
        own, place = divmod(int(key), _FAR)
        width = int(index.budget[own]) + 1
        low = place * width - _FAR // 2
        high = low + 2 * width - 1
        if out and out[-1][0] == own and low <= out[-1][2] + 1:
            out[-1] = (own, out[-1][1], high)
        else:
            out.append((own, low, high))
    return out


def _matches(index: Index, known: np.ndarray, texts: list[np.ndarray]) -> list[list[Match]]:
    """``(item_id, start, end, edits)`` of each document's passages, by place."""
    out: list[list[Match]] = [[] for _ in texts]
    sizes = np.array([len(x) for x in texts])
    starts = np.cumsum(sizes + _GAP) - sizes - _GAP
    whole = np.full(int(sizes.sum()) + _GAP * len(texts), -1, np.int64)
    for start, codes in zip(starts, texts):
        whole[start : start + len(codes)] = codes
    bands: dict[tuple[int, int], list[tuple[int, int]]] = {}
    # Gaps hash alike but are in no item; each is wider than any band reaches.
    for item, low, high in _candidates(index, whole, known):
        size = len(index.codes[item])
        first = max(0, int(np.searchsorted(starts, low, "right")) - 1)
        for own in range(first, int(np.searchsorted(starts, high + size, "right"))):
            shift = int(starts[own])
            if high + size >= shift and low <= shift + sizes[own]:
                bands.setdefault((own, item), []).append((low - shift, high - shift))
    for (own, item), places in bands.items():
        found = _all_aligned(index.codes[item], texts[own], places, int(index.budget[item]))
        out[own] += [(index.ids[item], start, end, edits) for edits, start, end in found]
    return [sorted(matches, key=lambda m: (m[1], m[2], repr(m[0]))) for matches in out]


def _slices(column: pa.Array) -> Iterator[list[np.ndarray]]:
    texts, size = [], 0
    for value in column:
        texts.append(folded(value.as_py() or ""))
        size += len(texts[-1]) + _GAP
        if size >= _SLICE_CHARS:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts


def _blocks(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of the items, as many at a time as ``BLOCK_CHARS`` hold."""
    items, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        codes = folded(row.text or "")
        if len(codes) < Q:
            continue
        if items and size + len(codes) > BLOCK_CHARS:
            yield Index.of(items)
            items, size = [], 0
        items.append((row.item_id, codes))
        size += len(codes)
    if items:
        yield Index.of(items)


def _found(index: Index) -> Callable[[pa.Array], Iterator[list[Match]]]:
    def found(column: pa.Array) -> Iterator[list[Match]]:
        known = np.unpackbits(index.known).astype(bool)
        for texts in _slices(column):
            yield from _matches(index, known, texts)

    return found


def _listed(index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["doc_id", "item_id", "start", "end", "edits"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = zip(batch["doc_id"].to_pylist(), _found(index.value)(batch["text"]))
            out = [(doc_id, *match) for doc_id, matches in found for match in matches]
            columns = list(zip(*out)) or [()] * len(names)
            yield pa.record_batch([pa.array(x, pa.int64()) for x in columns], names=names)

    return rows


def passages(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, item_id, start, end, edits)``: where ``docs(doc_id, text)`` hold items of
    ``benchmark(item_id, text)``.

    Places are code points, the end exclusive. Letters are compared without case and any
    white space as a blank. An item of m characters may have m // 16 edits. Of overlapping
    passages of one item the one with fewest edits is returned; between those returned there is no other. Items of under ten
    characters, null and empty ones are too short to tell and match nothing; repeated
    items match each. Null texts are empty, repeated documents are searched each.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, start long, end long, edits long"
    spark = docs.sparkSession
    out = spark.createDataFrame([], schema)
    for index in _blocks(benchmark):
        out = out.union(docs.mapInArrow(_listed(spark.sparkContext.broadcast(index)), schema))
    return out


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans, a blank in place of each run of them."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start > at or not out:
            out.append(text[at:start])
        at = max(at, end)
    out.append(text[at:])
    return " ".join(part.strip() for part in out if part.strip()) if spans else text


def _cleaned(text: str, spans: list[tuple[int, int]], indexes: list[Index]) -> str:
    """The text without the spans, and without passages that come to stand together by that."""
    while spans:
        text = cut(text, spans)
        column = pa.array([text], pa.string())
        spans = [match[1:3] for index in indexes for matches in _found(index)(column) for match in matches]
    return text


def _removed(handles: list) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = batch.schema.get_field_index("text")
            field, spans = batch.schema.field(place), {}
            for handle in handles:
                for k, matches in enumerate(_found(handle.value)(batch["text"])):
                    if matches:
                        spans.setdefault(k, []).extend(match[1:3] for match in matches)
            if spans:
                texts, indexes = batch["text"].to_pylist(), [handle.value for handle in handles]
                for k, places in spans.items():
                    texts[k] = _cleaned(texts[k], places, indexes)
                batch = batch.set_column(place, field, pa.array(texts, field.type))
            yield batch

    return rows


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with the passages of :func:`passages` cut out of ``text``, in one pass over the documents.

    All blocks of items are searched in the texts as they are; what they find is cut at once. A text
    that something was cut from is searched again, since what stood around it may now be a passage,
    until none is left. A task holds all blocks, some 25 bytes a character of the benchmark.
    """
    handles = [docs.sparkSession.sparkContext.broadcast(index) for index in _blocks(benchmark)]
    return docs.mapInArrow(_removed(handles), docs.schema)
