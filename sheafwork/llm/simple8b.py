"""Simple-8b: several integers to a 64-bit word, coded and decoded in whole arrays.

The top four bits of a word select how many values it holds and how wide each is.
Selector 0 is an escape: the next word is one value of up to 64 bits. Values come in
blocks of ``BLOCK``, each with the offset of its first word, so that all blocks are
coded and decoded side by side and any block can be read alone.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
# Fixed values of the coding: values to a word and bits of each, by selector from 1.
PACKINGS = [
    (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7),
    (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60),
]
_WIDEST = 60
_LOW = np.uint64(0xFFFF)
_WIDTHS = np.array([n.bit_length() for n in range(1 << 16)], np.uint8)
_COUNTS = np.array([1] + [count for count, _ in PACKINGS] + [0])


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits of each value, read 16 at a time from a table."""
    widths, most = _WIDTHS[values & _LOW], int(values.max())
    for part in range(1, -(-most.bit_length() // 16)):
        high = _WIDTHS[values >> np.uint64(16 * part) & _LOW]
        widths = np.where(high > 0, high + np.uint8(16 * part), widths)
    return widths


def _selectors(widths: np.ndarray) -> np.ndarray:
    """For every place the selector that packs most of the values from there on."""
    span = {1: widths}

    def after(array: np.ndarray, shift: int) -> np.ndarray:
        moved = np.zeros_like(array)
        moved[:, :-shift] = array[:, shift:]
        return moved

    for count, one, two in (
        (2, 1, 1), (3, 2, 1), (4, 2, 2), (5, 4, 1), (6, 4, 2), (7, 4, 3), (8, 4, 4),
        (10, 8, 2), (12, 8, 4), (15, 8, 7), (20, 10, 10), (30, 15, 15), (60, 30, 30),
    ):
        span[count] = np.maximum(span[one], after(span[two], one))
    chosen = np.zeros(widths.shape, np.uint8)
    for selector in range(len(PACKINGS), 0, -1):
        count, bits = PACKINGS[selector - 1]
        chosen[span[count] <= bits] = selector
    return chosen


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words and the offset of each block's first word for unsigned integers."""
    values = np.ascontiguousarray(values, np.uint64)
    blocks = -(-len(values) // BLOCK)
    if not blocks:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # Room behind each block, so that a word that reaches over its end packs zeros.
    padded = np.zeros((blocks, BLOCK + _WIDEST), np.uint64)
    full = np.zeros(blocks * BLOCK, np.uint64)
    full[: len(values)] = values
    padded[:, :BLOCK] = full.reshape(blocks, BLOCK)
    selectors = _selectors(_widths(padded))
    sizes = np.full(blocks, BLOCK)
    sizes[-1] = len(values) - (blocks - 1) * BLOCK
    place, rows = np.zeros(blocks, np.int64), np.arange(blocks)
    steps: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(rows):
        selector = selectors[rows, place[rows]]
        steps.append((rows, place[rows], selector))
        place[rows] += _COUNTS[selector]
        rows = rows[place[rows] < sizes[rows]]
    row, at, selector = (np.concatenate(x) for x in zip(*steps))
    order = np.argsort(row, kind="stable")
    row, at, selector = row[order], at[order], selector[order]
    taken = np.where(selector == 0, 2, 1)
    target = np.cumsum(taken) - taken
    words = np.zeros(int(taken.sum()), np.uint64)
    flat, spot = padded.ravel(), row * padded.shape[1] + at
    for kind in np.unique(selector):
        pick = np.flatnonzero(selector == kind)
        if kind == 0:
            words[target[pick] + 1] = flat[spot[pick]]
            continue
        count, bits = PACKINGS[kind - 1]
        word, first = np.full(len(pick), np.uint64(kind) << np.uint64(60)), spot[pick]
        for k in range(count):
            word |= flat[first + k] << np.uint64(k * bits)
        words[target[pick]] = word
    starts = np.searchsorted(row, np.arange(blocks))
    return words, target[starts]


def decode(words: np.ndarray, offsets: np.ndarray, number: int) -> np.ndarray:
    """The ``number`` values that :func:`encode` made words and offsets of."""
    out = np.zeros(len(offsets) * BLOCK + _WIDEST, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    # A word behind an escape is a value, whatever its top bits look like.
    for k in np.flatnonzero(selector == 0):
        if not raw[k]:
            raw[k + 1] = True
    counts = np.where(raw, 0, _COUNTS[selector])
    before = np.cumsum(counts) - counts
    block = np.searchsorted(offsets, np.arange(len(words)), side="right") - 1
    place = before - before[offsets][block] + block * BLOCK
    for kind in range(len(PACKINGS) + 1):
        pick = np.flatnonzero((selector == kind) & ~raw)
        if not len(pick):
            continue
        if kind == 0:
            out[place[pick]] = words[pick + 1]
            continue
        count, bits = PACKINGS[kind - 1]
        mask = np.uint64((1 << bits) - 1)
        for k in range(count):
            # What a block's last word packs beyond its end is not a value.
            to = place[pick] + k
            inside = to < (block[pick] + 1) * BLOCK
            out[to[inside]] = (words[pick[inside]] >> np.uint64(k * bits)) & mask
    return out[:number]
