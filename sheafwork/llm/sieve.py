"""Taking rows by a list of ids without exchanging the rows.

The ids set bits of a bitmap of bounded size, which every task has. Rows whose bits are not set
are left out where they are read; what passes still has to be joined with the list. When the
list is so long that the bitmap fills up, more rows pass, and nothing else changes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CELLS_PER_ID = 8
#: 2**27 cells are 16 MB.
MOST_CELLS = 1 << 27
_HASHES = 3
_SECTION = 1 << 15


def _cells(key: str, cells: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(n)), F.lit(cells).cast("long")) for n in range(_HASHES)]


def _bitmap(ids: DataFrame, key: str, cells: int) -> np.ndarray:
    """The bits; a section of 32,768 reaches the driver as one row, whatever the number of ids."""
    cell = ids.select(F.explode(F.array(*_cells(key, cells))).alias("cell"))
    sections = cell.groupBy((F.col("cell") / _SECTION).cast("long").alias("section")).agg(
        F.bitmap_construct_agg(F.col("cell") % _SECTION).alias("bits")
    )
    merged = np.zeros(-(-cells // _SECTION) * _SECTION // 8, np.uint8)
    for row in sections.toLocalIterator():
        start = row.section * _SECTION // 8
        merged[start : start + _SECTION // 8] = np.frombuffer(row.bits, np.uint8)
    return merged


def sifted(rows: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """The rows whose ``key`` may be among ``ids(key)``, and all that are; rows without one are left out."""
    cells = min(MOST_CELLS, max(_SECTION, CELLS_PER_ID * ids.count()))
    held = rows.sparkSession.sparkContext.broadcast(_bitmap(ids, key, cells))
    names = [f"_cell{n}" for n in range(_HASHES)]
    asked = rows.where(F.col(key).isNotNull()).withColumns(dict(zip(names, _cells(key, cells))))

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            for name in names:
                places = batch[name].to_numpy()
                keep &= (held.value[places >> 3] >> (places & 7).astype(np.uint8) & 1).astype(bool)
            yield batch.drop_columns(names).filter(pa.array(keep))

    return asked.mapInArrow(passing, rows.schema)
