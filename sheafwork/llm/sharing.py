"""Which keys occur in several documents, asked by blocks of documents.

A block sends each of its distinct keys once, to the key's shard, with a mark where two
of its own documents have it. The shard answers one bit a key. So a key that all
documents share costs an entry a block, and what is exchanged is five bytes a key. Keys
are cut to 40 bits for this: a few are taken for shared that are not, none is missed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DOCS_PER_BLOCK = 1_000
ASKED = "shard long, block long, keys binary, several binary"
ANSWERED = "block long, shard long, kind int, answer binary"
_DROPPED = np.uint64(24)


def number_of_blocks(docs: DataFrame) -> int:
    return max(1, math.ceil(docs.count() / DOCS_PER_BLOCK))


def in_blocks(docs: DataFrame, blocks: int) -> DataFrame:
    """``(block, doc_id, text)``; rows without ``doc_id`` are dealt by their text."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spread = F.xxhash64(F.coalesce(F.col("doc_id"), F.xxhash64("text")))
    return docs.select(F.pmod(spread, F.lit(blocks).cast("long")).alias("block"), "doc_id", "text")


def distinct(keys: np.ndarray, docs: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct short keys by shard, their shards, whether several documents have them,
    and for each given key its place among the distinct ones."""
    short = keys >> _DROPPED
    short = short + (short % np.uint64(shards) << np.uint64(40))
    # In whichever order a key's documents come, two neighbours differ if it has several.
    order = np.argsort(short)
    short, docs = short[order], docs[order]
    fresh = np.r_[True, short[1:] != short[:-1]] if len(short) else np.zeros(0, bool)
    group = np.cumsum(fresh) - 1
    several = np.zeros(int(fresh.sum()), bool)
    changed = np.flatnonzero(~fresh & np.r_[False, docs[1:] != docs[:-1]]) if len(short) else []
    several[group[changed]] = True
    place = np.empty(len(order), np.int64)
    place[order] = group
    unique = short[fresh]
    return unique & np.uint64((1 << 40) - 1), (unique >> np.uint64(40)).astype(np.int64), several, place


def _runs(shard: np.ndarray) -> list[tuple[int, slice]]:
    used, first = np.unique(shard, return_index=True)
    ends = np.r_[first[1:], len(shard)]
    return [(int(k), slice(a, b)) for k, a, b in zip(used, first, ends)]


def asked(block: int, keys: np.ndarray, shard: np.ndarray, several: np.ndarray) -> pa.Table:
    rows = [
        (k, block, keys[run].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes(), np.packbits(several[run]).tobytes())
        for k, run in _runs(shard)
    ]
    columns = list(zip(*rows)) or [()] * 4
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.table([pa.array(x, t) for x, t in zip(columns, kinds)], names=["shard", "block", "keys", "several"])


def answer(rows: pa.Table) -> pa.Table:
    """For a shard: one bit a key of each block."""
    parts, marks = [], []
    for keys, several in zip(rows["keys"].to_pylist(), rows["several"].to_pylist()):
        bare = np.frombuffer(keys, np.uint8).reshape(-1, 5)
        wide = np.zeros((len(bare), 8), np.uint8)
        wide[:, :5] = bare
        parts.append(wide.view("<u8").ravel())
        marks.append(np.unpackbits(np.frombuffer(several, np.uint8), count=len(bare)).astype(bool))
    _, place, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
    shared = counts > 1
    shared[place[np.concatenate(marks)]] = True
    bits = np.split(shared[place], np.cumsum([len(x) for x in parts])[:-1])
    return pa.table(
        {
            "block": rows["block"],
            "shard": rows["shard"],
            "kind": pa.array(np.zeros(len(parts), np.int32)),
            "answer": pa.array([np.packbits(x).tobytes() for x in bits], pa.binary()),
        }
    )


def shared(answers: pa.Table, shard: np.ndarray) -> np.ndarray:
    """The answered bits for distinct keys with these shards."""
    own = dict(zip(answers["shard"].to_pylist(), answers["answer"].to_pylist()))
    out = np.zeros(len(shard), bool)
    for k, run in _runs(shard):
        out[run] = np.unpackbits(np.frombuffer(own[k], np.uint8), count=run.stop - run.start)
    return out
