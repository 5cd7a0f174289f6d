import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheafwork.llm import exact, fuse
from sheafwork.llm.hashing import mixed
from sheafwork.llm.tables import written
from tests.llm import data

HOSTILE = data.texts() + [
    (20, "a b"),
    (21, "ab"),
    (22, "a  b"),
    (23, "a \tb"),
    (24, " ab"),
    (25, "\x1cab"),
    (26, "\v\f\r\n\t "),
    (None, "only without id"),
    (None, "only  without id"),
    (-(2**63), "edge"),
    (2**63 - 1, "edge"),
    (30, "repeated"),
    (30, "repeated"),
    (30, "repea ted"),
]


def brute_force(rows):
    groups = {}
    for doc_id, text in rows:
        normal = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(normal, []).append((-len(text or ""), doc_id is None, doc_id or 0))
    out = []
    for doc_id, text in rows:
        normal = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        chars, missing, first = best = min(groups[normal])
        kept = (-len(text or ""), doc_id is None, doc_id or 0) == best
        digest = hashlib.sha256(normal.encode()).hexdigest()
        out.append((doc_id, None if missing else first, len(groups[normal]), kept, digest))
    return sorted(out, key=repr)


def result(frame, **options):
    found = exact.deduplicate(frame, **options).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("batches", [1, 2, 4])
def test_hostile_rows(spark, batches):
    assert result(data.documents(spark, HOSTILE), batches=batches) == brute_force(HOSTILE)


def test_no_rows(spark):
    assert result(data.documents(spark, [])) == []


def test_texts_with_one_digest(spark):
    """Digests of two values: whatever passes the filters is told apart by its bytes."""
    found = exact.deduplicate(
        data.documents(spark, HOSTILE), digest=lambda text: (F.char_length(text) % 2).cast("string").cast("binary")
    )
    rows = sorted([tuple(row)[:4] for row in found.collect()], key=repr)
    assert rows == sorted([row[:4] for row in brute_force(HOSTILE)], key=repr)


def test_large_group(spark):
    rows = [(i, "the same text" if i % 3 else f"text {i // 6}") for i in range(3_000)]
    assert result(data.documents(spark, rows)) == brute_force(rows)


def test_screening_spares_new_texts(spark):
    old = written(exact.classes(exact.keyed(data.documents(spark, [(i, f"old {i}") for i in range(9_000)]))))
    new = exact.classes(exact.keyed(data.documents(spark, [(i, f"new {i}") for i in range(5_000)] + [(9, "old 9")])))
    known = exact.snapshot(old)
    assert known.filters.count() == known.buckets == 3
    passed = exact.screened(new, known).count()
    assert 1 <= passed <= 60  # 1/256 of 5,000 and the one that is there
    assert exact.matched(new, known).count() == 1


@pytest.mark.parametrize("count", [0, 1, 2, 3, 5, 17, 100, 1_000, 50_000])
def test_filter(count):
    keys = mixed(np.arange(count, dtype=np.uint64))
    held = fuse.build(np.r_[keys, keys])
    assert fuse.holds(held, keys).all()
    others = fuse.holds(held, mixed(np.arange(10**6, 10**6 + 50_000, dtype=np.uint64)))
    assert others.mean() < (0.01 if count else 1e-9)
    assert count < 10_000 or len(held) < 1.25 * count
