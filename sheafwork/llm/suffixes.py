"""Exact repeats across documents, by longest previous factors around shared anchors.

The previous factors of a suffix are its common prefixes with suffixes of earlier
documents. In suffix order the longest one is with the nearest suffix before or behind it
that belongs to a smaller document, and its length is the least common prefix of the
neighbours in between. A suffix whose longest previous factor has ``LENGTH`` bytes starts a
later copy; factors are counted up to ``LENGTH`` bytes, since longer ones decide nothing.

No task needs the suffix order of the corpus. Every window of ``LENGTH`` bytes has an
anchor: its smallest ``GRAM``-byte substring by hash. Equal windows have the same anchor at
the same place, so only suffixes around equal anchors have to be put in order together.
First, blocks of documents ask which anchors several documents have. Around those they send
the bytes of the windows, once for each distinct run of windows, with the smallest document
that has it. In the anchor's shard the suffixes are ordered and the array of longest
previous factors is worked out. One bit a window goes back to the block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from sheafwork.llm import sharing
from sheafwork.llm.hashing import mixed, raw

LENGTH = 50
GRAM = 24
_STARTS = LENGTH - GRAM + 1
_WIDEST = LENGTH + _STARTS - 1
_SLICE_BYTES = 1 << 19
#: Suffixes whose neighbours are compared at once.
_ROWS = 1 << 16
_STEP = np.uint64(0x9E3779B97F4A7C15)

_SENT = "shard long, block long, sizes binary, docs binary, bytes binary"


def _grams(flat: np.ndarray) -> np.ndarray:
    one = mixed(flat.astype(np.uint64) + np.uint64(1))

    def joined(left: np.ndarray, right: np.ndarray, shift: int) -> np.ndarray:
        value = left[: len(right) - shift] * _STEP + right[shift:]
        return value ^ (value >> np.uint64(31))

    two = joined(one, one, 1)
    four = joined(two, two, 2)
    eight = joined(four, four, 4)
    return mixed(joined(joined(eight, eight, 8), eight, 16))


def _smallest(values: np.ndarray) -> np.ndarray:
    """Where the leftmost smallest of the ``_STARTS`` values from each place on stands."""
    place = np.arange(len(values))

    def lesser(values: np.ndarray, place: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
        size = len(values) - shift
        right = values[shift:] < values[:size]
        return np.where(right, values[shift:], values[:size]), np.where(right, place[shift:], place[:size])

    width = 1
    while 2 * width <= _STARTS:
        values, place = lesser(values, place, width)
        width *= 2
    return lesser(values, place, _STARTS - width)[1]


def _slices(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    first, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= _SLICE_BYTES:
            yield first, texts[first : k + 1]
            first, size = k + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def _anchored(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: key, text, first window, number of windows."""
    out: list[tuple[np.ndarray, ...]] = []
    for offset, some in _slices(texts):
        flat = np.frombuffer(b"".join(some), np.uint8)
        if len(flat) < LENGTH:
            continue
        sizes = np.array([len(x) for x in some])
        starts = np.cumsum(sizes) - sizes
        grams = _grams(flat)
        anchor = _smallest(grams)
        windows = np.maximum(sizes - LENGTH + 1, 0)
        text = np.repeat(np.arange(len(some)), windows)
        place = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
        own = anchor[place + starts[text]]
        fresh = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (text[1:] != text[:-1])][: len(own)])
        if len(fresh):
            number = np.diff(np.r_[fresh, len(own)])
            out.append((grams[own[fresh]], text[fresh] + offset, place[fresh], number))
    if not out:
        return (np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _numbered(rows: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    """Documents that can be compared: those with an id, with their texts."""
    known = [(i, t) for i, t in zip(rows["doc_id"].to_pylist(), raw(rows["text"])) if i is not None]
    return np.array([i for i, _ in known], np.int64), [t for _, t in known]


def _ask(shards: int) -> Callable[[pa.Table], pa.Table]:
    def ask(rows: pa.Table) -> pa.Table:
        ids, texts = _numbered(rows)
        keys, text, _, _ = _anchored(texts)
        short, shard, several, _ = sharing.distinct(keys, ids[text], shards)
        return sharing.asked(rows["block"][0].as_py(), short, shard, several)

    return ask


Piece = tuple[int, bytes]


def _pieces(ids: np.ndarray, texts: list[bytes], answers: pa.Table, shards: int) -> tuple[dict[Piece, int], list[tuple[int, int, Piece]]]:
    """Distinct runs of windows around shared anchors with their smallest document, and
    every run with its text and first window."""
    keys, text, place, number = _anchored(texts)
    _, shard, _, spot = sharing.distinct(keys, ids[text], shards)
    some = np.flatnonzero(sharing.shared(answers, shard)[spot])
    least: dict[Piece, int] = {}
    runs = []
    columns = (shard[spot[some]], text[some], place[some], number[some])
    for k, t, at, n in zip(*(x.tolist() for x in columns)):
        piece = (k, texts[t][at : at + n + LENGTH - 1])
        doc_id = int(ids[t])
        if least.setdefault(piece, doc_id) > doc_id:
            least[piece] = doc_id
        runs.append((t, at, piece))
    return least, runs


def _send(shards: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def send(rows: pa.Table, answers: pa.Table) -> pa.Table:
        ids, texts = _numbered(rows)
        least, _ = _pieces(ids, texts, answers, shards)
        by_shard: dict[int, list[tuple[bytes, int]]] = {}
        for (shard, piece), doc_id in sorted(least.items()):
            by_shard.setdefault(shard, []).append((piece, doc_id))
        packer = zstandard.ZstdCompressor(level=1)
        block = rows["block"][0].as_py() if len(rows) else 0
        return pa.table(
            {
                "shard": pa.array(list(by_shard), pa.int64()),
                "block": pa.array([block] * len(by_shard), pa.int64()),
                "sizes": pa.array([bytes(len(p) for p, _ in x) for x in by_shard.values()], pa.binary()),
                "docs": pa.array([np.array([d for _, d in x], "<i8").tobytes() for x in by_shard.values()], pa.binary()),
                "bytes": pa.array([packer.compress(b"".join(p for p, _ in x)) for x in by_shard.values()], pa.binary()),
            }
        )

    return send


def _common(suffixes: np.ndarray) -> np.ndarray:
    """Bytes that each row has in common with the row before it; 0 for the first."""
    out = np.zeros(len(suffixes), np.uint8)
    for at in range(1, len(suffixes), _ROWS):
        rows = suffixes[at - 1 : at + _ROWS]
        differ = rows[1:] != rows[:-1]
        out[at : at + _ROWS] = np.where(differ.any(1), differ.argmax(1), LENGTH)
    return out


def _before(docs: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each place in suffix order the bytes it has in common with the nearest place
    before it that has a smaller document.

    Exact from ``GRAM`` bytes on. Where neighbours have less in common a new group begins,
    and the place before it counts as smaller, so no search leaves its group.
    """
    fresh = common < GRAM
    value = np.cumsum(fresh) * (int(docs.max(initial=0)) + 1) + docs
    longest = int(np.diff(np.flatnonzero(np.r_[fresh, True])).max(initial=1))
    # Least documents and common prefixes of 1, 2, 4, ... places from each one on.
    least, reach = [value], [common]
    while 2 << (len(least) - 1) <= longest:
        step = 1 << (len(least) - 1)
        least.append(np.minimum(least[-1][:-step], least[-1][step:]))
        reach.append(np.minimum(reach[-1][:-step], reach[-1][step:]))
    at, out = np.arange(len(docs)), common.copy()
    for k in range(len(least) - 1, -1, -1):
        own = np.flatnonzero(at >= 1 << k)
        to = at[own] - (1 << k)
        ok = least[k][to] >= value[own]
        own, to = own[ok], to[ok]
        out[own] = np.minimum(out[own], reach[k][to])
        at[own] = to
    out[at == 0] = 0
    return out


def longest_previous_factors(suffixes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For suffixes in order, cut to ``LENGTH`` bytes a row, the length of the longest prefix
    that a suffix of a smaller document starts with too; exact from ``GRAM`` bytes on.

    ``docs`` may be any numbers in the order of the documents, such as ranks.
    """
    common = _common(suffixes)
    # A suffix that has less than GRAM bytes in common with both neighbours has no such factor.
    near = np.flatnonzero(np.maximum(common, np.r_[common[1:], np.uint8(0)][: len(common)]) >= GRAM)
    docs, some = docs[near], np.where(common[near] < GRAM, 0, common[near]).astype(np.uint8)
    out = np.zeros(len(common), np.uint8)
    if len(near):
        behind = _before(docs[::-1], np.r_[np.uint8(0), some[:0:-1]])[::-1]
        out[near] = np.maximum(_before(docs, some), behind)
    return out


def later_copies(pieces: list[bytes], docs: np.ndarray) -> np.ndarray:
    """For each piece a bit for each of its windows: whether a smaller document has
    the same ``LENGTH`` bytes."""
    sizes = np.array([len(x) for x in pieces])
    flat = np.frombuffer(b"".join(pieces), np.uint8)
    windows = sizes - LENGTH + 1
    holder = np.repeat(np.arange(len(pieces)), windows)
    within = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    start = np.repeat(np.cumsum(sizes) - sizes, windows) + within
    suffix = np.lib.stride_tricks.sliding_window_view(flat, LENGTH)[start]
    order = np.argsort(suffix.reshape(-1).view(f"S{LENGTH}"), kind="stable")
    rank = np.unique(docs, return_inverse=True)[1]
    later = order[longest_previous_factors(suffix[order], rank[holder[order]]) >= LENGTH]
    bits = np.zeros(len(pieces), np.uint32)
    np.bitwise_or.at(bits, holder[later], np.uint32(1) << within[later].astype(np.uint32))
    return bits


def _compare(rows: pa.Table) -> pa.Table:
    """Bits for the pieces of every block in a shard."""
    unpacker = zstandard.ZstdDecompressor()
    pieces: list[bytes] = []
    numbers = []
    for sizes, packed in zip(rows["sizes"].to_pylist(), rows["bytes"].to_pylist()):
        whole, at = unpacker.decompress(packed), 0
        for size in sizes:
            pieces.append(whole[at : at + size])
            at += size
        numbers.append(len(sizes))
    docs = np.frombuffer(b"".join(rows["docs"].to_pylist()), "<i8")
    # Equal pieces stand once for all blocks, with their smallest document.
    place: dict[bytes, int] = {}
    spot = np.array([place.setdefault(piece, len(place)) for piece in pieces])
    least = np.full(len(place), np.iinfo(np.int64).max)
    np.minimum.at(least, spot, docs)
    bits = later_copies(list(place), least)[spot]
    full = (np.uint64(1) << (np.array([len(x) for x in pieces], np.uint64) - np.uint64(LENGTH - 1))) - np.uint64(1)
    bits = np.where(docs > least[spot], full.astype(np.uint32), bits)
    return pa.table(
        {
            "block": rows["block"],
            "shard": rows["shard"],
            "kind": pa.array(np.ones(len(numbers), np.int32)),
            "answer": pa.array([x.astype("<u4").tobytes() for x in np.split(bits, np.cumsum(numbers)[:-1])], pa.binary()),
        }
    )


def _covered(rows: pa.Table, answers: pa.Table, shards: int) -> Iterator[tuple[int | None, bytes, np.ndarray]]:
    """Every document with the places of its bytes that are covered."""
    kind = answers["kind"].to_numpy()
    ids, texts = _numbered(rows)
    least, runs = _pieces(ids, texts, answers.filter(pa.array(kind == 0)), shards)
    sent = answers.filter(pa.array(kind == 1))
    bits = dict(zip(sent["shard"].to_pylist(), sent["answer"].to_pylist()))
    masks: dict[Piece, int] = {}
    spot: dict[int, int] = {}
    for piece in sorted(least):
        at = spot.get(piece[0], 0)
        masks[piece] = int.from_bytes(bits[piece[0]][at : at + 4], "little")
        spot[piece[0]] = at + 4
    covered: dict[int, list[tuple[int, int]]] = {}
    for text, at, piece in runs:
        number = len(piece[1]) - LENGTH + 1
        mask = masks[piece] if least[piece] == ids[text] else (1 << number) - 1
        while mask:
            low = (mask & -mask).bit_length() - 1
            run = ((mask >> low) + 1 & -((mask >> low) + 1)).bit_length() - 1
            covered.setdefault(text, []).append((at + low, at + low + run + LENGTH - 1))
            mask &= ~(((1 << run) - 1) << low)
    for k, (doc_id, text) in enumerate(zip(ids.tolist(), texts)):
        steps = np.zeros(len(text) + 1, np.int64)
        if k in covered:
            ends = np.array(covered[k])
            np.add.at(steps, ends[:, 0], 1)
            np.add.at(steps, ends[:, 1], -1)
        yield doc_id, text, np.cumsum(steps)[:-1] > 0
    for doc_id, text in zip(rows["doc_id"].to_pylist(), raw(rows["text"])):
        if doc_id is None:
            yield None, text, np.zeros(len(text), bool)


def _digests(shards: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def digests(rows: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for doc_id, text, gone in _covered(rows, answers, shards):
            kept = text
            if gone.any():
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
            out.append((doc_id, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
        columns = list(zip(*out)) or [()] * len(names)
        return pa.table([pa.array(x, t) for x, t in zip(columns, kinds)], names=names)

    return digests


def deduplicate(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept)`` of every row of
    ``docs(doc_id, text)``.

    Removed is each byte of the UTF-8 text that is covered by a string of ``LENGTH`` bytes
    which also starts in a document with a smaller ``doc_id``; strings may overlap and are
    judged on the texts as given. ``kept`` holds the other bytes, which may split a
    character. Null texts are empty. Rows with the same ``doc_id`` remove nothing from each
    other, rows without one are left as they are and remove nothing. All comparisons are of
    bytes; hashes only decide which bytes meet.
    """
    number = sharing.number_of_blocks(docs)
    blocks = sharing.in_blocks(docs, number).groupBy("block")
    asked = blocks.applyInArrow(_ask(number), sharing.ASKED)
    answers = asked.groupBy("shard").applyInArrow(sharing.answer, sharing.ANSWERED)
    sent = blocks.cogroup(answers.groupBy("block")).applyInArrow(_send(number), _SENT)
    compared = sent.groupBy("shard").applyInArrow(_compare, sharing.ANSWERED)
    both = answers.union(compared)
    return blocks.cogroup(both.groupBy("block")).applyInArrow(
        _digests(number),
        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary",
    )
