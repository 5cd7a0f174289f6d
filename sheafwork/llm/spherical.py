"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; a vector passes it when it lies in a cap around the direction.
Directions are tuples of a random product code: the coordinates are turned at random and
cut into blocks, each block has its own small code of unit directions, and a filter is
one direction from each. The cap is as wide as the vector's nearest filter and a margin.
The filters that a vector passes are listed by decoding: what a choice in one block loses
against the best one uses up the margin for the others. Vectors meet on filters that both
pass, and every meeting is verified in double precision.

The margin is that of a pair at the least cosine: their inner products with a direction
differ by about their distance over the root of the dimension, and ``MARGIN`` times the
deviation of the difference of two such inner products is allowed. In simulations with
2 to 256 dimensions none of 6,000 pairs at the least cosine was missed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.components import components
from sheafwork.llm.tables import written

LEAST_COSINE = 0.98
MARGIN = 2.0
TILE = 512
_BLOCKS = 2
_LEAST_CODES = 64
_SEED = 20


def codes_per_block(largest_label: int) -> int:
    """Directions in a block's code: filters grow with the vectors of a label."""
    return max(_LEAST_CODES, math.ceil(largest_label ** (1 / _BLOCKS)))


def margin(dim: int) -> float:
    """What a vector's filters may lose against its best one."""
    return MARGIN * math.sqrt(2) * math.sqrt(2 - 2 * LEAST_COSINE) / math.sqrt(dim)


def _codes(dim: int, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """A random rotation and the blocks' codes; the same on every executor."""
    rng = np.random.default_rng(_SEED + dim)
    rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
    blocks = np.array_split(np.arange(dim), min(_BLOCKS, dim))
    codes = []
    for block in blocks:
        code = rng.standard_normal((size, len(block)))
        codes.append(code / np.linalg.norm(code, axis=1, keepdims=True) / math.sqrt(len(blocks)))
    return rotation, codes


def list_decode(vectors: np.ndarray, codes: list[np.ndarray], slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Row and filter of every filter that comes within ``slack`` of the row's best."""
    cuts = np.cumsum([code.shape[1] for code in codes])[:-1]
    rows, lost = np.arange(len(vectors)), np.zeros(len(vectors))
    filters = np.zeros(len(vectors), np.int64)
    for part, code in zip(np.split(vectors, cuts, axis=1), codes):
        scores = part @ code.T
        losses = scores.max(1, keepdims=True) - scores
        total = lost[:, None] + losses[rows]
        keep, chosen = np.nonzero(total <= slack)
        rows, lost, filters = rows[keep], total[keep, chosen], filters[keep] * len(code) + chosen
    return rows, filters


def _listed(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    schema = pa.schema([("node", pa.int64()), ("filters", pa.list_(pa.int64()))])
    codes: dict[int, tuple[np.ndarray, list[np.ndarray]]] = {}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = batch["unit"].to_pylist()
            nodes = np.array(batch["node"])
            lengths = np.array([len(unit) for unit in units])
            for dim in np.unique(lengths):
                if dim not in codes:
                    codes[dim] = _codes(int(dim), size)
                rotation, code = codes[dim]
                own = np.flatnonzero(lengths == dim)
                for part in np.array_split(own, -(-len(own) // 256)):
                    turned = np.array([units[k] for k in part]) @ rotation
                    row, found = list_decode(turned, code, margin(int(dim)))
                    lists = np.split(found, np.searchsorted(row, np.arange(1, len(part))))
                    yield pa.record_batch([nodes[part], [np.sort(x) for x in lists]], schema=schema)

    return rows


def _linked(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Links within one tile of a bucket, as sums for each node and a forest.

    A pair counts only in the first filter that both pass. ``side`` is 0 for the tile's
    rows, 1 for its columns, 2 for both.
    """
    side, ids = rows["side"].to_numpy(), rows["node"].to_numpy()
    down, across = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
    units = np.array(rows["unit"].tolist())
    near = units[down] @ units[across].T >= LEAST_COSINE
    near &= ids[down][:, None] != ids[across][None, :]
    if not near.any():
        return pd.DataFrame({"node": [], "links": [], "other": []})
    sizes = rows["filters"].map(len).to_numpy()
    passed = np.concatenate(rows["filters"].tolist())
    holder = np.repeat(np.arange(len(rows)), sizes)
    earlier = passed < key[1]
    _, column = np.unique(passed[earlier], return_inverse=True)
    passes = np.zeros((len(rows), column.max(initial=-1) + 1), np.float32)
    passes[holder[earlier], column] = 1
    first = near & (passes[down] @ passes[across].T == 0)
    weights = rows["copies"].to_numpy()
    links = np.zeros(len(rows), np.int64)
    links[down] += first @ weights[across]
    if len(down) != len(rows):
        links[across] += first.T @ weights[down]
    edges = _forest(near, down, across, ids)
    counted = np.flatnonzero(links)
    return pd.DataFrame(
        {
            "node": np.concatenate([ids[counted], ids[edges[:, 0]]]),
            "links": np.concatenate([links[counted], np.zeros(len(edges), np.int64)]),
            "other": pd.array([pd.NA] * len(counted) + ids[edges[:, 1]].tolist(), "Int64"),
        }
    )


def _forest(near: np.ndarray, down: np.ndarray, across: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Links that connect what ``near`` connects, at most a few for each node.

    The smallest id spreads; a link is listed when an id came over it.
    """
    least = ids.copy()
    found = []
    while True:
        before = least.copy()
        for own, other, link in ((down, across, near), (across, down, near.T)):
            offered = np.where(link, least[other][None, :], np.iinfo(np.int64).max)
            best = offered.argmin(1)
            value = offered[np.arange(len(own)), best]
            better = value < least[own]
            least[own[better]] = value[better]
            found.append(np.stack([own[better], other[best[better]]], 1))
        if (least == before).all():
            return np.concatenate(found)


def _units(vectors: DataFrame) -> DataFrame:
    """``(vec_id, label, unit)`` of all rows; ``unit`` is null where nothing can link."""
    values = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", values.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    known = F.col("label").isNotNull() & F.col("vec_id").isNotNull() & finite
    # Scaled by its largest component first, so that no square overflows or vanishes.
    top = F.array_max(F.transform("v", F.abs))
    rows = rows.withColumn("top", F.when(known & (top > 0), top))
    rows = rows.withColumn("v", F.when(F.col("top").isNotNull(), F.transform("v", lambda x: x / F.col("top"))))
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x))
    unit = F.transform("v", lambda x: x / F.col("norm"))
    return rows.withColumn("norm", norm).select("vec_id", "label", unit.alias("unit"))


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors(vec_id,
    embedding, label)``.

    Vectors are linked when their labels are equal and not null and their cosine is 0.98
    or more. Vectors that are null, empty, zero or hold null, NaN or infinite components
    link with nothing, nor do rows without ``vec_id``; vectors of different lengths never
    meet. Vectors with equal unit vectors stand as one node with its number of copies;
    links among them are counted without being listed. Rows with the same ``vec_id`` count
    as one vector each in others' links and come back as often as they came. Buckets are
    cut into tiles of ``TILE`` by ``TILE`` nodes, which give sums and a forest, not pairs.
    """
    rows = written(_units(vectors))
    known = rows.where("unit IS NOT NULL")
    groups = written(
        known.groupBy("label", "unit").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
    )
    largest = groups.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    listed = _listed(codes_per_block(largest))
    lists = groups.select("node", "unit").mapInArrow(listed, "node long, filters array<long>")
    nodes = groups.withColumn("dim", F.size("unit"))
    passing = written(nodes.join(lists, "node").withColumn("own", F.explode("filters")))
    key = ["label", "own", "dim"]
    sizes = passing.groupBy(*key).count().where("count > 1")
    parts = sizes.select(*key, F.ceil(F.col("count") / TILE).cast("int").alias("parts"))
    meeting = passing.join(parts, key).withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    meeting = meeting.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    side = F.when(F.col("part") == F.col("other"), 2).when(F.col("part") < F.col("other"), 0).otherwise(1)
    tiles = meeting.select(
        *key,
        F.least("part", "other").alias("down"),
        F.greatest("part", "other").alias("across"),
        side.alias("side"),
        "node",
        "copies",
        "unit",
        "filters",
    )
    found = written(
        tiles.groupBy(*key, "down", "across").applyInPandas(_linked, "node long, links long, other long")
    )
    joined = components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    members = known.join(groups, ["label", "unit"]).select("vec_id", "node", "copies")
    members = members.join(counts, "node", "left").join(
        joined.withColumnRenamed("component", "root"), "node", "left"
    )
    members = members.select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("root", "node").alias("component_id"),
    )
    alone = rows.where("unit IS NULL").select("vec_id", F.lit(0).cast("long"), "vec_id")
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    return members.union(alone).withColumn("kept", kept)
