"""Static binary-fuse filters over sets of 64-bit keys, built and asked in numpy.

A key's three places lie in three neighbouring segments of one array of bytes, and the
exclusive or of the bytes there is the key's print. Such an array exists when the keys can
be peeled: taken off one after another, each at a place that no remaining key has. Here
all keys with a place of their own are taken off at once, round after round, and the bytes
are set in the reverse order of the rounds. A key of the set is always recognised, any
other with probability 1/256; the array has some ten bits a key.
"""

from __future__ import annotations

import math
import struct

import numpy as np

from sheafwork.llm.hashing import mixed, seeds

_SEEDS = seeds(64, 7_000)
_HEAD = struct.Struct("<QIII")


def _shape(keys: int) -> tuple[int, int]:
    """Length of a segment, a power of two, and number of first places."""
    keys = max(keys, 2)
    segment = 1 << min(18, max(2, int(math.log(keys) / math.log(3.33) + 2.25)))
    room = keys * max(1.125, 0.875 + 0.25 * math.log(1e6) / math.log(keys))
    segments = max(1, math.ceil(room / segment) - 2)
    return segment, segments * segment


def _places(keys: np.ndarray, seed: np.uint64, segment: int, first: int) -> tuple[np.ndarray, np.ndarray]:
    """The three places of every key, and its print."""
    thrown = mixed(keys ^ seed)
    low, mask = thrown & np.uint64(0xFFFFFFFF), np.uint64(segment - 1)
    start = (thrown >> np.uint64(32)) * np.uint64(first) >> np.uint64(32)
    one = start + np.uint64(segment) ^ low & mask
    two = start + np.uint64(2 * segment) ^ low >> np.uint64(14) & mask
    prints = mixed(thrown).astype(np.uint8)
    return np.stack([start, one, two]).astype(np.int64), prints


def _peeled(places: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, their own places); nothing when some keys cannot be taken off."""
    keys = np.arange(places.shape[1])
    holders, count = np.zeros(size, np.int64), np.zeros(size, np.int32)
    for row in places:
        np.bitwise_xor.at(holders, row, keys)
        np.add.at(count, row, 1)
    rounds, left = [], len(keys)
    single = np.flatnonzero(count == 1)
    while len(single):
        taken, first = np.unique(holders[single], return_index=True)
        rounds.append((taken, single[first]))
        left -= len(taken)
        for row in places:
            np.bitwise_xor.at(holders, row[taken], taken)
            np.subtract.at(count, row[taken], 1)
        touched = np.unique(places[:, taken])
        single = touched[count[touched] == 1]
    return None if left else rounds


def build(keys: np.ndarray) -> bytes:
    """The filter of some keys; repeated ones do no harm, none at all give an empty filter."""
    keys = np.unique(keys.astype(np.uint64))
    segment, first = _shape(len(keys))
    size = first + 2 * segment
    for seed in _SEEDS:
        places, prints = _places(keys, seed, segment, first)
        rounds = _peeled(places, size)
        if rounds is not None:
            break
    else:
        raise ValueError(f"no filter for {len(keys)} keys")
    held = np.zeros(size, np.uint8)
    for taken, own in reversed(rounds):
        # A round's own places are empty yet, so all three can be read.
        held[own] = prints[taken] ^ np.bitwise_xor.reduce(held[places[:, taken]], axis=0)
    return _HEAD.pack(int(seed), segment, first, len(keys)) + held.tobytes()


def holds(filter_: bytes, keys: np.ndarray) -> np.ndarray:
    """Whether each key may be in the set: always so for the set's own keys."""
    seed, segment, first, count = _HEAD.unpack_from(filter_)
    if not count:
        return np.zeros(len(keys), bool)
    held = np.frombuffer(filter_, np.uint8, offset=_HEAD.size)
    places, prints = _places(keys.astype(np.uint64), np.uint64(seed), segment, first)
    return np.bitwise_xor.reduce(held[places], axis=0) == prints
