"""Packing by concatenating and cutting.

First pass: ids are written in parts, and the totals of the parts are summed up, which
gives every document its place in one long row of ids. Second pass: the row is cut every
``length`` ids. Each document knows from its place alone which sequences it lies in, so
the cut exchanges nothing; what it gives is a boundary record for each piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.llm import tokens

LENGTH = 4096

PIECE_SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary"
)


def _cut(length: int, with_ids: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, blobs = [], []
            for doc_id, place, ids in tokens.documents(batch):
                start = 0
                while start < len(ids):
                    sequence, offset = divmod(place + start, length)
                    piece = ids[start : start + length - offset].tobytes()
                    size = len(piece) // 4
                    rows.append(
                        (doc_id, start, size, zlib.crc32(piece), len(ids), sequence, offset)
                    )
                    blobs.append(piece if with_ids else None)
                    start += size
            columns = [pa.array(x, pa.int64()) for x in list(zip(*rows)) or [()] * len(names)]
            yield pa.record_batch([*columns, pa.array(blobs, pa.binary())], names=[*names, "ids"])

    return pieces


def pack(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, with_ids: bool = True, lean: bool = False
) -> DataFrame:
    """Pieces of ``docs(doc_id, text)`` in sequences of ``length`` ids.

    One row a piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, ids``; ``ids`` are little-endian unsigned 32-bit integers, null without
    ``with_ids``. All sequences but the last are full. A null text is empty: it has the
    closing id alone. No rows give no pieces. Repeated rows are packed each, further
    columns are not read. ``lean`` is for workers that other stages have filled.
    """
    folder = tokens.token_files(docs, tokenizer, lean)
    rows = tokens.read_files(docs.sparkSession, folder)
    return rows.mapInArrow(_cut(length, with_ids), PIECE_SCHEMA)


def _laid_out(length: int, pad: int) -> Callable[[pa.Table], pa.Table]:
    def sequence(pieces: pa.Table) -> pa.Table:
        pieces = pieces.sort_by("offset")
        ids = np.frombuffer(b"".join(pieces["ids"].to_pylist()), "<u4")
        full = np.full(length if len(ids) & (len(ids) - 1) else len(ids), pad, "<u4")
        full[: len(ids)] = ids
        return pa.table(
            {
                "sequence_id": pieces["sequence_id"].slice(0, 1),
                "ids": pa.array([full.tolist()], pa.list_(pa.int64())),
                "length": pa.array([len(ids)], pa.int64()),
                "ends": pa.array(
                    [np.add(pieces["offset"], pieces["length"]).tolist()], pa.list_(pa.int64())
                ),
            }
        )

    return sequence


def sequences(pieces: DataFrame, length: int = LENGTH, pad: int = tokens.END) -> DataFrame:
    """``(sequence_id, ids, length, ends)``: the padded sequences and where pieces end.

    A sequence whose length is a power of two is not padded. A group is one sequence,
    at most ``length`` ids.
    """
    needed = pieces.select("sequence_id", F.col("offset"), F.col("length"), "ids")
    return needed.groupBy("sequence_id").applyInArrow(
        _laid_out(length, pad),
        "sequence_id long, ids array<long>, length long, ends array<long>",
    )
