"""Near-duplicate documents by fast similarity sketching.

The sketch has one value per bin. In the first rounds every shingle is thrown into a
random bin and each bin keeps its smallest; each later round throws all shingles into
one given bin. Rounds go on until no bin is empty, so even a set of one shingle fills
every coordinate, and two sets agree in a coordinate with the probability of their
Jaccard similarity, as concentrated as for a large set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafwork.llm.components import components
from sheafwork.llm.hashing import mixed, raw, seeds, shingle_set
from sheafwork.llm.sieve import sifted
from sheafwork.llm.tables import written

BINS = 72
ROWS = 3
# Sets with similarity 0.75 agree in 54 of 72 bins on average, with deviation 3.7.
# Fewer than 37 is more than 4.6 deviations below: a chance of 2e-6.
LEAST_AGREEING = 37
# Rows and bytes of shingle hashes that a tile has of each side, about.
TILE_ROWS = 512
TILE_BYTES = 8 << 20

_ROUNDS = seeds(2 * BINS, 0)
_BAND = seeds(BINS // ROWS, 1_000)
_EMPTY = np.uint64(2**64 - 1)

_SKETCHED = (
    "doc_id long, n_shingles long, digest binary, prints binary, bands array<long>"
)


def sketch(values: np.ndarray) -> np.ndarray:
    """One 64-bit value per bin for a set of hashes that is not empty."""
    bins = np.full(BINS, _EMPTY)
    empty = np.ones(BINS, bool)
    for turn, seed in enumerate(_ROUNDS):
        thrown = mixed(values ^ seed)
        if turn < BINS:
            least = np.full(BINS, _EMPTY)
            places = (thrown & np.uint64(0xFFFFFFFF)) * np.uint64(BINS) >> np.uint64(32)
            np.minimum.at(least, places.astype(np.int64), thrown)
            fresh = empty & (least != _EMPTY)
            bins[fresh] = least[fresh]
            empty &= ~fresh
        elif empty[turn - BINS]:
            bins[turn - BINS] = thrown.min()
            empty[turn - BINS] = False
        if not empty.any():
            break
    return bins


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_shingles", pa.int64()),
            ("digest", pa.binary()),
            ("prints", pa.binary()),
            ("bands", pa.list_(pa.int64())),
        ]
    )
    for batch in batches:
        sizes, digests, prints, bands = [], [], [], []
        for text in raw(batch["text"]):
            values = shingle_set(text)
            sizes.append(len(values))
            if not len(values):
                digests.append(None), prints.append(None), bands.append(None)
                continue
            bins = mixed(sketch(values))
            key = bins[0::ROWS]
            for row in range(1, ROWS):
                key = mixed(key + bins[row::ROWS])
            digests.append(xxhash.xxh3_128_digest(values.tobytes()))
            prints.append((bins & np.uint64(255)).astype(np.uint8).tobytes())
            bands.append(mixed(key ^ _BAND).view(np.int64))
        yield pa.record_batch(
            [batch["doc_id"].cast(pa.int64()), sizes, digests, prints, bands], schema=schema
        )


def _prints(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, BINS)


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sets of nodes from texts with the node's id; a text that has another set is left out."""
    for batch in batches:
        sets = [shingle_set(text) for text in raw(batch["text"])]
        own = [len(x) > 0 and xxhash.xxh3_128_digest(x.tobytes()) == y for x, y in zip(sets, batch["digest"].to_pylist())]
        columns = [batch["node"], pa.array([x.tobytes() for x in sets], pa.binary())]
        yield pa.record_batch(columns, names=["node", "shingles"]).filter(pa.array(own, pa.bool_()))


def _sets(wanted: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """``(node, shingles)`` of the nodes in ``wanted(node)``, computed once and written.

    The join is by sorting whatever the sizes, so that its two Python steps are different stages and a
    task has one worker.
    """
    named = written(wanted.distinct().join(nodes.select("node", "first", "digest"), "node"))
    named = named.withColumnRenamed("first", "doc_id")
    texts = sifted(docs, "doc_id", named.select("doc_id")).join(named.hint("merge"), "doc_id")
    texts = texts.select("node", "digest", "text")
    return written(texts.mapInArrow(_shingled, "node long, shingles binary").dropDuplicates(["node"]))


def _first_links(shared: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links ``(a, b)`` of nodes to the first of a bucket: a pair for each of a node's buckets at most."""
    firsts = shared.groupBy("key").agg(F.min("node").alias("a"))
    stars = shared.join(firsts, "key").select("a", F.col("node").alias("b")).where("a < b")
    stars = written(stars.distinct())
    sizes = stars.groupBy("a").agg(F.count("*").alias("n"))
    # A star is cut into tiles of one row, its centre, which each of them has.
    sizes = sizes.select("a", F.ceil(F.col("n") / TILE_ROWS).cast("int").alias("tiles"))
    across = F.pmod(F.xxhash64("b"), "tiles").cast("int").alias("across")
    ends = stars.join(sizes, "a").select("a", across, F.lit(1).alias("side"), F.col("b").alias("node"))
    centres = sizes.select("a", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("across"))
    centres = centres.select("a", "across", F.lit(0).alias("side"), F.col("a").alias("node"))
    tiles = ends.union(centres).select(F.col("a").alias("key"), F.lit(0).alias("down"), "across", "side", "node")
    tiles = tiles.join(nodes.select("node", F.col("node").alias("component"), "prints"), "node")
    return _verified(tiles, nodes, docs)


def _tiles(members: DataFrame) -> DataFrame:
    """``(key, down, across, side, node, component, prints)``: buckets with several components, in tiles.

    A bucket's largest component needs no comparison with itself. So the rows of a tile (side 0) are of
    the other components, its columns (side 1) of all, and a bucket whose members are joined but
    for a few costs little more than its members.
    """
    held = members.groupBy("key", "component").agg(
        F.count("*").alias("n"), F.sum(8 * F.col("n_shingles")).alias("bytes")
    )
    several = held.groupBy("key").agg(
        F.max_by("component", F.struct("n", "component")).alias("major"),
        F.max(F.struct("n", "component", "bytes")).alias("most"),
        F.sum("n").alias("n"),
        F.sum("bytes").alias("bytes"),
        F.count("*").alias("components"),
    )

    def parts(rows: Column, size: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(rows / TILE_ROWS), F.ceil(size / TILE_BYTES)).cast("int")

    several = several.where("components > 1").select(
        "key",
        "major",
        parts(F.col("n"), F.col("bytes")).alias("columns"),
        parts(F.col("n") - F.col("most.n"), F.col("bytes") - F.col("most.bytes")).alias("rows"),
    )
    rows = members.join(several, "key")

    def placed(side: int, own: str, other: str) -> DataFrame:
        part = F.pmod(F.xxhash64("node", F.lit(side)), own).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        down, across = (part, every) if side == 0 else (every, part)
        chosen = rows.where("component <> major") if side == 0 else rows
        return chosen.select(
            "key",
            down.alias("down"),
            across.alias("across"),
            F.lit(side).alias("side"),
            "node",
            "component",
            "prints",
        )

    return placed(0, "rows", "columns").union(placed(1, "columns", "rows"))


def _looking_alike(tile: pa.Table) -> pa.Table:
    """The tile's members whose sketch agrees with one of another component across."""
    side, component, prints = tile["side"].to_numpy(), tile["component"].to_numpy(), _prints(tile["prints"])
    across, keep = np.flatnonzero(side == 1), np.zeros(len(side), bool)
    for i in np.flatnonzero(side == 0):
        agree = (prints[across] == prints[i]).sum(1) >= LEAST_AGREEING
        found = across[agree & (component[across] != component[i])]
        keep[found] = True
        keep[i] = len(found) > 0
    return tile.filter(pa.array(keep))


def _tile_links(tile: pa.Table) -> pa.Table:
    """Links that join the components of a tile as far as its pairs do: a forest, so few.

    A member is compared with all across that look alike and are not joined to it yet, on the full sets.
    """
    side, node, prints = tile["side"].to_numpy(), tile["node"].to_numpy(), _prints(tile["prints"])
    _, component = np.unique(tile["component"].to_numpy(), return_inverse=True)
    top = np.arange(component.max() + 1)
    sets = [np.frombuffer(x, np.uint64) for x in tile["shingles"].to_pylist()]
    sizes = np.array([len(x) for x in sets])
    known, places = np.unique(np.concatenate(sets), return_inverse=True)
    ends = np.cumsum(sizes)
    across = np.flatnonzero(side == 1)
    columns = np.concatenate([places[ends[j] - sizes[j] : ends[j]] for j in across])
    starts = np.r_[0, np.cumsum(sizes[across])[:-1]]
    held, links = np.zeros(len(known), bool), []
    for i in np.flatnonzero(side == 0):
        agree = (prints[across] == prints[i]).sum(1) >= LEAST_AGREEING
        if not (agree & (top[component[across]] != top[component[i]])).any():
            continue
        own = places[ends[i] - sizes[i] : ends[i]]
        held[own] = True
        shared = np.add.reduceat(held[columns], starts, dtype=np.int64)
        held[own] = False
        for j in across[agree & (100 * shared >= 75 * (sizes[i] + sizes[across] - shared))]:
            one, two = top[component[i]], top[component[j]]
            if one != two:
                links.append((node[i], node[j]))
                top[top == two] = one
    return pa.table(dict(zip("ab", np.array(links, np.int64).reshape(-1, 2).T)))


_TILES = "key long, down int, across int, side int, node long, component long, prints binary"


def _verified(tiles: DataFrame, nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Links ``(a, b)`` that join the components of each tile; only members that look alike get their sets."""
    columns = ["key", "down", "across", "side", "node", "component", "prints"]
    tiles = tiles.select(columns).groupBy("key", "down", "across")
    alike = written(tiles.applyInArrow(_looking_alike, _TILES))
    whole = alike.join(_sets(alike.select("node"), nodes, docs), "node")
    return written(whole.groupBy("key", "down", "across").applyInArrow(_tile_links, "a long, b long"))


def _other_links(shared: DataFrame, nodes: DataFrame, docs: DataFrame, joined: DataFrame) -> DataFrame:
    """Links that join nodes of a bucket which are still in different components."""
    members = shared.join(joined, "node", "left").join(nodes.select("node", "n_shingles", "prints"), "node")
    members = members.withColumn("component", F.coalesce("component", "node"))
    return _verified(_tiles(written(members)), nodes, docs)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs(doc_id, text)``.

    Documents are linked when their sets of five-word shingles have a Jaccard
    similarity of 0.75 or more. Equal sets are one node, whichever documents have them. Nodes that
    share a band are candidates. First each is tried with the first of each bucket; then, in the buckets
    that still hold several components, all pairs across them are compared, in tiles, by their
    sketches and then on the full sets, and a tile gives no more links than it takes to join
    its components. So no link of a shared bucket is left out, and a large group of copies is
    not compared pair by pair once it is joined. A pair at 0.75 exactly shares none of the 24 bands
    with probability 2e-6. In a bucket, members outside its largest component cost a comparison
    with every member.

    Null and empty texts have no shingles and are linked with nothing. Rows with the
    same ``doc_id`` are one document, linked as any of its texts is, and come back as often as
    they came; rows without ``doc_id`` are dropped from the graph and come back alone. Further
    columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = written(docs.mapInArrow(_sketched, _SKETCHED))
    sets = rows.where("digest IS NOT NULL AND doc_id IS NOT NULL")
    first = sets.groupBy("digest").agg(F.min("doc_id").alias("first"))
    sketches = sets.join(first, "digest").where("doc_id = first").dropDuplicates(["digest"])
    node = F.monotonically_increasing_id().alias("node")
    nodes = written(sketches.select(node, "digest", "first", "n_shingles", "prints", "bands"))
    banded = nodes.select("node", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    shared = written(banded.join(buckets, "key"))
    links = _first_links(shared, nodes, docs)
    joined = components(links)
    links = links.union(_other_links(shared, nodes, docs, joined))

    # Several texts of one id are one document.
    known = written(sets.select("doc_id", "digest").join(nodes.select("digest", "node"), "digest"))
    ids = known.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    same = known.join(ids.select("doc_id", "a"), "doc_id").select("a", F.col("node").alias("b"))
    joined = components(links.union(same))
    labelled = nodes.select("node", "first").join(joined, "node", "left")
    labelled = written(labelled.select("node", "first", F.coalesce("component", "node").alias("component")))
    least = labelled.groupBy("component").agg(F.min("first").alias("component_id"))
    answers = known.join(labelled.join(least, "component").select("node", "component_id"), "node")
    answers = answers.groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    found = rows.select("doc_id", "n_shingles").join(answers, "doc_id", "left")
    component_id = F.coalesce("component_id", "doc_id")
    return found.select(
        "doc_id",
        "n_shingles",
        component_id.alias("component_id"),
        F.coalesce(component_id == F.col("doc_id"), F.lit(True)).alias("kept"),
    )
