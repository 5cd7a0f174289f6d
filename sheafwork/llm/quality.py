"""A quality classifier: perplexity under an n-gram model of trusted text.

The model is an interpolated modified Kneser-Ney model of characters, five at a time.
Documents are dealt to blocks, once. Each block asks for its distinct n-grams and brings
its trusted counts along; what is asked is sharded, counts of all blocks meet there, and
probabilities go back to the blocks that asked, where every document is scored. So texts
are exchanged once, an n-gram that all documents share costs one entry a block, and no
task holds the whole model. A document is accepted when its perplexity is within a bound
set by quantiles of the trusted documents in its language.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.hashing import mixed
from sheafwork.llm.tables import written

ORDER = 5
#: Characters of a block's documents, about. A task has one block at once.
BLOCK_CHARS = 6_000_000
_BITS = 21
#: Symbols of the model: code points.
SYMBOLS = 0x110000
_SYMBOL = np.uint64((1 << _BITS) - 1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_START = 1
_MODEL_SHARDS = 64
_SLICE_CHARS = 1 << 19
#: Trusted documents train the model, but one in ``FOLDS`` is held out for the quantiles.
FOLDS = 5
_HELD_OUT, _TRAINS = 1, 2
#: Characters that a language's middle perplexity counts for in a document's own.
PRIOR_CHARS = 100
#: How far above the middle a document may be, in steps from the middle to a quantile.
STEPS, QUANTILE = 4.0, 0.9
#: The quantiles of all trusted documents count for so many documents in a language's own.
PRIOR_DOCUMENTS = 20


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.maximum(codes, 2).astype(np.uint64)


def _named(high: np.ndarray, low: np.ndarray, order: int) -> np.ndarray:
    """A name for the last ``order`` symbols of n-grams, of 64 bits. An n-gram's first two
    symbols are in ``high``, the others in ``low``. Names up to order 3 are the symbols."""
    if order > 3:
        return mixed(mixed(high if order > 4 else high & _SYMBOL) * _STEP + low)
    return low & np.uint64((1 << (_BITS * order)) - 1)


def _contexts(high: np.ndarray, low: np.ndarray, order: int) -> np.ndarray:
    """Names for what stands before the last symbol of :func:`_named`."""
    return _named(high, low >> np.uint64(_BITS), order) if order > 3 else _named(high, low, order) >> np.uint64(_BITS)


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-gram that ends at each character, in two words, and the characters of each text."""
    coded = [symbols(text) for text in texts]
    sizes = np.array([len(x) for x in coded], np.int64)
    pad = np.full(ORDER - 1, _START, np.uint64)
    flat = np.concatenate([x for one in coded for x in (pad, one)] + [pad[:0]])
    count = max(0, len(flat) - ORDER + 1)
    high, low = np.zeros(count, np.uint64), np.zeros(count, np.uint64)
    for shift in range(ORDER):
        word = high if shift < ORDER - 3 else low
        word <<= np.uint64(_BITS)
        word |= flat[shift : shift + count]
    # Behind each text stand as many windows that run into the next one's start.
    starts = np.cumsum(sizes + ORDER - 1) - sizes - ORDER + 1
    keep = np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    keep = keep.astype(np.int64)
    return high[keep], low[keep], sizes


def _slices(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    first, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text) + ORDER
        if size >= _SLICE_CHARS:
            yield first, texts[first : k + 1]
            first, size = k + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def _squeezed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts compressed, each by itself: they are exchanged and held as that."""
    coder = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        blobs = [coder.compress((text or "").encode("utf-8", "surrogatepass")) for text in batch["text"].to_pylist()]
        yield pa.record_batch([*batch.columns[:3], pa.array(blobs, pa.binary())], names=["doc_id", "row", "lang", "blob"])


def _texts(docs: pa.Table) -> list[str]:
    coder = zstandard.ZstdDecompressor()
    return [coder.decompress(blob).decode("utf-8", "surrogatepass") for blob in docs["blob"].to_pylist()]


def _documents(rows: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The documents of a block, and how far all their labels trust them."""
    is_doc = rows["is_doc"].to_numpy()
    docs, labels = rows.filter(pa.array(is_doc)), rows.filter(pa.array(~is_doc))
    trust: dict[int | None, int] = {}
    for doc_id, trusted in zip(labels["doc_id"].to_pylist(), labels["trusted"].to_pylist()):
        trust[doc_id] = min(trust.get(doc_id, _TRAINS), trusted)
    trust.pop(None, None)
    return docs, np.array([trust.get(x, 0) for x in docs["doc_id"].to_pylist()], int)


def _summed(counts: np.ndarray, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct n-grams by name: names, counts and both words."""
    unique, first, place = np.unique(_named(high, low, ORDER), return_index=True, return_inverse=True)
    return unique, np.bincount(place, counts, len(unique)).astype(np.int64), high[first], low[first]


def packed(values: np.ndarray) -> bytes:
    """The array's bytes, compressed with the first of all values first and so on."""
    return zstandard.compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes(), 1)


def unpacked(blob: bytes, kind: str) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return np.ascontiguousarray(flat.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _wanted(texts: list[str], trusted: np.ndarray, shards: int) -> tuple[np.ndarray, ...]:
    """A block's distinct n-grams by shard, then both words: names, counts in training texts,
    both words and shards."""
    parts, size = [(np.zeros(0), *(np.zeros(0, np.uint64) for _ in range(2)))], 0
    for first, some in _slices(texts):
        high, low, sizes = _grams(some)
        code, unique = pd.factorize(_named(high, low, ORDER))
        counted = np.repeat(trusted[first : first + len(some)] == _TRAINS, sizes)
        spot = np.zeros(len(unique), np.int64)
        spot[code] = np.arange(len(code))
        parts.append((np.bincount(code, counted, len(unique)), high[spot], low[spot]))
        size += len(unique)
        # What slices have in common is summed up as soon as it is as much as the rest.
        if size > 2 * len(parts[0][0]) + _SLICE_CHARS:
            parts, size = [_summed(*(np.concatenate(x) for x in zip(*parts)))[1:]], 0
    keys, counts, high, low = _summed(*(np.concatenate(x) for x in zip(*parts)))
    shard = (mixed(keys) % np.uint64(shards)).astype(np.int64)
    # Neighbours share most of their last symbols, so they compress well.
    order = np.lexsort((high, low, shard))
    return tuple(x[order] for x in (keys, counts, high, low, shard))


def _ask(shards: int) -> Callable[[pa.Table], pa.Table]:
    """What a block asks for: its distinct n-grams with counts, by shard."""

    def ask(rows: pa.Table) -> pa.Table:
        docs, trusted = _documents(rows)
        _, counts, high, low, shard = _wanted(_texts(docs), trusted, shards)
        used, first = np.unique(shard, return_index=True)
        block = rows["block"][0].as_py() if len(rows) else 0
        parts = [np.split(x, first[1:])[: len(used)] for x in (high, low, counts.astype("<u4"))]
        return pa.table(
            {
                "shard": pa.array(used, pa.int64()),
                "block": pa.array([block] * len(used), pa.int64()),
                "high": pa.array(list(map(packed, parts[0])), pa.binary()),
                "low": pa.array(list(map(packed, parts[1])), pa.binary()),
                "counts": pa.array(list(map(packed, parts[2])), pa.binary()),
            }
        )

    return ask


def _joined(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(unpacked(blob, kind) for blob in column.to_pylist())])


def _merge(rows: pa.Table) -> pa.Table:
    """Counts of all blocks for the n-grams of a shard."""
    words = (_joined(rows[c], "<u8") for c in ("high", "low"))
    _, counts, high, low = _summed(_joined(rows["counts"], "<u4"), *words)
    last_context = (low >> np.uint64(_BITS)) & _SYMBOL
    return pa.table(
        {
            "model": pa.array((mixed(last_context) % np.uint64(_MODEL_SHARDS)).astype(np.int64)),
            "high": pa.array(high.astype(np.int64)),
            "low": pa.array(low.astype(np.int64)),
            "count": pa.array(counts),
        }
    )


def _orders(high: np.ndarray, low: np.ndarray, counts: np.ndarray) -> dict[int, tuple[np.ndarray, ...]]:
    """Seen n-grams of each order from 2 by name: names, counts and both words; below the
    top the counts are in how many ways each is continued to the left. All have the last
    symbol of the context."""
    seen = np.flatnonzero(counts > 0)
    tables = {ORDER: _summed(counts[seen], high[seen], low[seen])}
    for order in range(ORDER - 1, 1, -1):
        _, _, high, low = tables[order + 1]
        unique, first, ways = np.unique(_named(high, low, order), return_index=True, return_counts=True)
        tables[order] = (unique, ways, high[first], low[first])
    return tables


def _words(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return rows["high"].to_numpy().astype(np.uint64), rows["low"].to_numpy().astype(np.uint64)


def _statistics(rows: pa.Table) -> pa.Table:
    """Counts of counts from 1 to 4 by order, and how many ways lead to each symbol."""
    tables = _orders(*_words(rows), rows["count"].to_numpy())
    out = [
        (order, times, int((table[1] == times).sum()))
        for order, table in tables.items()
        for times in range(1, 5)
    ]
    last, ways = np.unique(tables[2][0] & _SYMBOL, return_counts=True)
    out += [(1, int(symbol), int(n)) for symbol, n in zip(last, ways)]
    columns = list(zip(*out))
    return pa.table({name: pa.array(x, pa.int64()) for name, x in zip(("order", "key", "n"), columns)})


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """The three discounts of modified Kneser-Ney, kept within their counts."""
    if not (n1 and n2):
        return 0.5, 0.75, 0.75
    y = n1 / (n1 + 2 * n2)
    d1 = 1 - 2 * y * n2 / n1
    d2 = 2 - 3 * y * n3 / n2
    d3 = 3 - 4 * y * n4 / n3 if n3 else d2
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in ((1, d1), (2, d2), (3, d3)))


def _discounted(counts: np.ndarray, amounts: tuple[float, float, float]) -> np.ndarray:
    return np.array([0, *amounts])[np.minimum(counts, 3)]


def _probabilities(shards: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def probabilities(rows: pa.Table, statistics: pa.Table) -> pa.Table:
        high, low = _words(rows)
        number: dict[tuple[int, int], int] = {
            (order, key): n
            for order, key, n in zip(*(statistics[x].to_pylist() for x in ("order", "key", "n")))
        }
        tables = _orders(high, low, rows["count"].to_numpy())
        ways = np.zeros(SYMBOLS)
        for (order, key), n in number.items():
            if order == 1:
                ways[key] = n
        times = np.array([(ways == k).sum() for k in range(1, 5)])
        total = ways.sum()
        last = (low & _SYMBOL).astype(np.int64)
        if total:
            off = _discounted(ways.astype(np.int64), discounts(*times))
            value = (ways - off + off.sum() / SYMBOLS)[last] / total
        else:
            value = np.full(len(low), 1 / SYMBOLS)
        for order in range(2, ORDER + 1):
            grams, counts, seen_high, seen_low = tables[order]
            if not len(grams):
                continue
            own, before = _named(high, low, order), _contexts(high, low, order)
            amounts = discounts(*(number.get((order, k), 0) for k in range(1, 5)))
            off = _discounted(counts, amounts)
            contexts, group = np.unique(_contexts(seen_high, seen_low, order), return_inverse=True)
            totals, left = np.bincount(group, counts), np.bincount(group, off)
            place = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
            hit = grams[place] == own
            spot = np.minimum(np.searchsorted(contexts, before), len(contexts) - 1)
            known = contexts[spot] == before
            direct = np.where(hit, (counts - off)[place], 0)
            value = np.where(known, (direct + left[spot] * value) / totals[spot], value)
        asked = _named(high, low, ORDER)
        return pa.table(
            {
                "shard": pa.array((mixed(asked) % np.uint64(shards)).astype(np.int64)),
                "gram": pa.array(asked.astype(np.int64)),
                "logp": pa.array(np.log(value)),
            }
        )

    return probabilities


def _answer(asked: pa.Table, known: pa.Table) -> pa.Table:
    """The log probabilities of what each block asked of a shard, in its order."""
    grams = known["gram"].to_numpy()
    order = np.argsort(grams)
    grams, logs = grams[order], known["logp"].to_numpy()[order].astype("<f4")
    answers = [
        packed(logs[np.searchsorted(grams, _named(unpacked(high, "<u8"), unpacked(low, "<u8"), ORDER).astype(np.int64))])
        for high, low in zip(asked["high"].to_pylist(), asked["low"].to_pylist())
    ]
    return pa.table(
        {"block": asked["block"], "shard": asked["shard"], "logs": pa.array(answers, pa.binary())}
    )


def _scored(shards: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def scored(rows: pa.Table, answers: pa.Table) -> pa.Table:
        return _score(rows, answers, shards)

    return scored


def _score(rows: pa.Table, answers: pa.Table, shards: int) -> pa.Table:
    docs, trusted = _documents(rows)
    texts = _texts(docs)
    keys = _wanted(texts, trusted, shards)[0]
    # Answers have no keys: those of a shard are in the order in which they were asked.
    logs = _joined(answers.sort_by("shard")["logs"], "<f4").astype(float)
    order = np.argsort(keys)
    keys, logs = keys[order], logs[order]
    chars, sums = np.zeros(len(texts), np.int64), np.zeros(len(texts))
    for first, some in _slices(texts):
        high, low, sizes = _grams(some)
        code, unique = pd.factorize(_named(high, low, ORDER))
        value = logs[np.searchsorted(keys, unique)][code]
        holder = np.repeat(np.arange(len(some)), sizes)
        chars[first : first + len(some)] = sizes
        sums[first : first + len(some)] = np.bincount(holder, value, len(some))
    return pa.table(
        {
            "doc_id": docs["doc_id"],
            "row": docs["row"],
            "lang": docs["lang"],
            "trusted": pa.array(trusted, pa.int32()),
            "chars": pa.array(chars),
            "log_sum": pa.array(sums),
        }
    )


def scores(docs: DataFrame, labels: DataFrame, row: str | None = None) -> DataFrame:
    """``(doc_id, row, lang, trusted, chars, log_sum)`` of every row of ``docs(doc_id, text,
    lang)``; ``log_sum`` is the natural log of its probability under the model of the
    documents that ``labels(doc_id, quality, toxic)`` trust: quality 1, not toxic.
    ``trusted`` is 2 where the document trained the model, 1 where it was held out. ``row`` names
    a column of numbers that is carried along, to tell rows apart; without it the numbers are null.

    A document with several labels is trusted when all do. Labels of other documents and
    without ``doc_id`` count for nothing. Null texts are empty. Without trusted text all
    symbols are equally likely. Rows with the same ``doc_id`` are scored each, in one block. Very long
    texts are cut into slices for counting, but a block has each of its texts whole.
    """
    number = F.col(row).cast("long") if row else F.lit(None).cast("long")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), number.alias("row"), "lang", "text")
    chars = docs.agg(F.sum(F.length("text")).alias("chars")).first().chars or 0
    number = max(1, math.ceil(chars / BLOCK_CHARS))
    docs = docs.mapInArrow(_squeezed, "doc_id long, row long, lang string, blob binary")
    good = (F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)
    fold = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit("fold")), F.lit(FOLDS).cast("long"))
    marks = labels.where("doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.lit(None).cast("long").alias("row"),
        F.lit(None).cast("string").alias("lang"),
        F.lit(None).cast("binary").alias("blob"),
        F.when(~F.coalesce(good, F.lit(False)), 0).when(fold == 0, _HELD_OUT).otherwise(_TRAINS).alias("trusted"),
        F.lit(False).alias("is_doc"),
    )
    rows = docs.select("*", F.lit(0).alias("trusted"), F.lit(True).alias("is_doc")).union(marks)
    # Rows without an id have no labels to meet.
    spread = F.xxhash64(F.coalesce("doc_id", F.xxhash64("blob")))
    block = F.pmod(spread, F.lit(number).cast("long")).alias("block")
    blocks = rows.select(block, "*").groupBy("block")
    shards = number
    asked = blocks.applyInArrow(_ask(shards), "shard long, block long, high binary, low binary, counts binary")
    merged = asked.groupBy("shard").applyInArrow(_merge, "model long, high long, low long, count long")
    parts = merged.groupBy("model").applyInArrow(_statistics, "order long, key long, n long")
    totals = parts.groupBy("order", "key").agg(F.sum("n").alias("n"))
    totals = totals.withColumn("model", F.explode(F.sequence(F.lit(0), F.lit(_MODEL_SHARDS - 1))))
    totals = totals.select(F.col("model").cast("long").alias("model"), "order", "key", "n")
    known = (
        merged.groupBy("model")
        .cogroup(totals.groupBy("model"))
        .applyInArrow(_probabilities(shards), "shard long, gram long, logp double")
    )
    answers = (
        asked.groupBy("shard")
        .cogroup(known.groupBy("shard"))
        .applyInArrow(_answer, "block long, shard long, logs binary")
    )
    return blocks.cogroup(answers.groupBy("block")).applyInArrow(
        _scored(shards), "doc_id long, row long, lang string, trusted int, chars long, log_sum double"
    )


def classify(docs: DataFrame, labels: DataFrame, row: str | None = None) -> DataFrame:
    """``(doc_id, lang, chars, perplexity, bound, accepted)`` of every row of ``docs``, and ``row``
    if it names a column of numbers that tell rows apart.

    A document's log perplexity is averaged with the middle one of its language's held out
    trusted documents, which counts for ``PRIOR_CHARS`` characters, so that a few words are not
    judged by themselves. The bound lies ``STEPS`` times as far above the middle as the
    ``QUANTILE`` quantile does. A language's quantiles are averaged with those of all trusted
    documents, which count for ``PRIOR_DOCUMENTS``; a null language takes the latter, and without
    any trusted document all are accepted. A document without characters has no perplexity and
    is not accepted. Very long texts and repeated rows are those of :func:`scores`.
    """
    scored = written(scores(docs, labels, row))
    trusted = scored.where(f"trusted = {_HELD_OUT} AND chars > 0").withColumn("cost", -F.col("log_sum") / F.col("chars"))
    marks = [
        F.percentile_approx("cost", [0.5, QUANTILE], 10_000).alias("marks"),
        F.count("*").alias("number"),
    ]
    by_language = trusted.where("lang IS NOT NULL").groupBy("lang").agg(*marks)
    overall = trusted.agg(*marks).first().marks or (0.0, float("inf"))
    judged = scored.join(by_language, "lang", "left")
    share = F.col("number") / (F.col("number") + PRIOR_DOCUMENTS)

    def blended(place: int) -> Column:
        own = share * F.col("marks")[place] + (1 - share) * F.lit(overall[place])
        return F.coalesce(own, F.lit(overall[place]))

    middle, high = blended(0), blended(1)
    cost = (PRIOR_CHARS * middle - F.col("log_sum")) / (PRIOR_CHARS + F.col("chars"))
    some = F.col("chars") > 0
    return judged.select(
        "doc_id",
        *([F.col("row").alias(row)] if row else []),
        "lang",
        "chars",
        F.when(some, F.exp(-F.col("log_sum") / F.col("chars"))).alias("perplexity"),
        F.exp(middle + STEPS * (high - middle)).alias("bound"),
        (some & (cost <= middle + STEPS * (high - middle))).alias("accepted"),
    )
