"""Hashes of words and shingles, vectorised over whole batches of texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

_FIRST = np.uint64(0xFF51AFD7ED558CCD)
_SECOND = np.uint64(0xC4CEB9FE1A85EC53)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(32)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    values = (values ^ (values >> _SHIFT)) * _FIRST
    values = (values ^ (values >> _SHIFT)) * _SECOND
    return values ^ (values >> _SHIFT)


def seeds(number: int, start: int) -> np.ndarray:
    return mixed(np.arange(start + 1, start + number + 1, dtype=np.uint64) * _STEP)


def raw(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """A text column's UTF-8 bytes; null is empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def words(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.lower().split()


def word_hashes(tokens: list[bytes]) -> np.ndarray:
    # Hashing a word again takes less time than finding it among many.
    return np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, tokens)), ">u8").astype(np.uint64)


def word_hashes_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of :func:`word_hashes` of all texts' words, and where each text's words end.

    Words of up to eight bytes, which most are, are hashed all at once."""
    ends = np.cumsum([0, *(len(x) + 1 for x in texts)])
    whole = b"\n".join(texts).lower() + b"\n" + bytes(8)
    inside = np.r_[False, _WORD[np.frombuffer(whole, np.uint8)[: ends[-1]]]]
    first, last = np.flatnonzero(inside[1:] != inside[:-1]).reshape(-1, 2).T
    size = last - first
    # Each place's next eight bytes.
    eights = np.ndarray(len(whole) - 7, "<u8", whole, 0, (1,))
    hashes = np.empty(len(first), np.uint64)
    for some, hashed in ((size <= 3, _up_to_three), (size > 3, _up_to_eight)):
        some = np.flatnonzero(some & (size <= 8))
        length = size[some].astype(np.uint64)
        hashes[some] = hashed(eights[first[some]] & _BYTES[size[some]], length)
    some = np.flatnonzero(size > 8)
    hashes[some] = word_hashes([whole[a:b] for a, b in zip(first[some].tolist(), last[some].tolist())])
    return hashes, np.searchsorted(first, ends[1:])


#: Which bytes are no ASCII white space, and masks of the lowest bytes.
_WORD = np.array([not bytes([k]).isspace() for k in range(256)])
_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def _up_to_three(word: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH3 of words of one to three bytes."""
    eight, byte = np.uint64(8), np.uint64(255)
    middle = word >> (size >> np.uint64(1)) * eight & byte
    end = word >> (size - np.uint64(1)) * eight
    value = (word & byte) << np.uint64(16) | middle << np.uint64(24) | end | size << eight
    value ^= np.uint64(0x87275A9B)
    value = (value ^ (value >> np.uint64(33))) * np.uint64(0xC2B2AE3D27D4EB4F)
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0x165667B19E3779F9)
    return value ^ (value >> np.uint64(32))


def _up_to_eight(word: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH3 of words of four to eight bytes."""
    low = np.uint64(0xFFFFFFFF)
    value = (word >> (size - np.uint64(4)) * np.uint64(8) & low) + ((word & low) << _SHIFT)
    value ^= np.uint64(0xC73AB174C5ECD5A2)
    value ^= (value << np.uint64(49) | value >> np.uint64(15)) ^ (value << np.uint64(24) | value >> np.uint64(40))
    value *= np.uint64(0x9FB21C651E98DF25)
    value ^= (value >> np.uint64(35)) + size
    value *= np.uint64(0x9FB21C651E98DF25)
    return value ^ (value >> np.uint64(28))


def shingle_hashes(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """A hash per window of ``width`` words; fewer words make one, none make none."""
    width = min(width, len(hashes))
    if not width:
        return hashes
    count = len(hashes) - width + 1
    values = mixed(hashes[:count] + np.uint64(width))
    for shift in range(1, width):
        values = mixed(values * _STEP + hashes[shift : shift + count])
    return values


def shingle_set(text: bytes, width: int = 5) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    return np.unique(shingle_hashes(word_hashes(words(text)), width))
