"""Small files packed into row groups of a bounded size."""

import random

import pyarrow.parquet as pq
import pytest

from sheafwork import sources
from sheafwork.sources import packing


def files(folder, sizes):
    folder.mkdir()
    rng = random.Random(4)
    for number, size in enumerate(sizes):
        sub = folder / f"d {number % 7}"
        sub.mkdir(exist_ok=True)
        text = "".join(rng.choice("abcdé<> \n") for _ in range(size))
        (sub / f"f{number:05}.html").write_bytes(("﻿" * (number % 5 == 0) + text).encode())


def groups(folder):
    """Uncompressed bytes and names of each row group of each file."""
    out = []
    for path in sorted(folder.glob("*.parquet")):
        file = pq.ParquetFile(path)
        for n in range(file.num_row_groups):
            names = file.read_row_group(n, ["doc_id"]).column("doc_id").to_pylist()
            out.append((file.metadata.row_group(n).total_byte_size, names))
    return out


@pytest.mark.parametrize("parts", [100_000, 300])
def test_files_come_back_in_bounded_groups(spark, tmp_path, monkeypatch, parts):
    monkeypatch.setattr(packing, "_FILES_PER_PART", parts)
    rng = random.Random(2)
    sizes = [rng.choice((0, 1, 50, 400, 900)) for _ in range(1_500)] + [20_000, 9_000, 60_000]
    rng.shuffle(sizes)
    files(tmp_path / "in", sizes)
    limit = 16_384
    source = f"{tmp_path}/in/*"
    packed = sources.pack_documents(spark, source, f"{tmp_path}/out", limit, glob="*.html")
    scanned = sources.scan_documents(spark, source, glob="*.html")
    assert sorted(map(tuple, packed.collect())) == sorted(map(tuple, scanned.collect()))
    found = groups(tmp_path / "out")
    assert all(size <= limit or len(names) == 1 for size, names in found)
    assert sum(len(names) == 1 for _, names in found) == 3
    assert all(names == sorted(names) for _, names in found)
    several = sorted((names[0], names[-1]) for _, names in found if len(names) > 1)
    assert all(one[1] < two[0] for one, two in zip(several, several[1:]))
    # No more groups than twice the fewest possible, beside the files that are alone.
    assert len(several) <= 2 + sum(size for size, names in found if len(names) > 1) // (limit // 2)


def test_one_file_and_none(spark, tmp_path):
    files(tmp_path / "in", [10])
    assert sources.pack_documents(spark, f"{tmp_path}/in/*", f"{tmp_path}/one").count() == 1
    none = sources.pack_documents(spark, f"{tmp_path}/in/*", f"{tmp_path}/none", glob="*.txt")
    assert none.count() == 0 and sources.read_packed(spark, f"{tmp_path}/none").columns == ["doc_id", "html"]


def test_listing_opens_no_file(spark, tmp_path):
    files(tmp_path / "in", [10, 20])
    plan = packing.file_sizes(spark, f"{tmp_path}/in/*")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_packs_are_numbered_without_a_gap(spark):
    rng = random.Random(9)
    rows = [(f"{i:04}", rng.choice((1, 30, 49, 50, 51, 200))) for i in range(500)]
    found = packing.assigned(spark.createDataFrame(rows, "doc_id string, bytes long"), 100).collect()
    packs = {}
    for row in found:
        packs.setdefault(row.pack, []).append(row.bytes)
    assert sorted(packs) == list(range(len(packs)))
    assert all(sum(sizes) <= 100 or len(sizes) == 1 for sizes in packs.values())
    assert sorted((row.doc_id, row.bytes) for row in found) == rows
