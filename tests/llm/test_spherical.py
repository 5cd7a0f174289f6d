import math

import numpy as np

from sheafwork.llm import spherical
from tests.llm import data

SCHEMA = "vec_id long, embedding array<float>, label int, node long, unit int, filters string, own int"


def brute_force(rows):
    units = []
    for vec_id, vector, label, *_ in rows:
        good = vec_id is not None and label is not None and vector
        good = good and all(x is not None and math.isfinite(x) for x in vector) and any(vector)
        if good:
            v = np.array(vector, np.float32).astype(float)
            v = v / np.abs(v).max()
            units.append(v / np.linalg.norm(v))
        else:
            units.append(None)
    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            if units[i] is None or units[j] is None or rows[i][2] != rows[j][2]:
                continue
            if len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.98:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    out = []
    for i in range(n):
        same = [rows[j][0] for j in range(n) if find(j) == find(i)]
        least = min(same) if len(same) > 1 else rows[i][0]
        out.append((rows[i][0], links[i], least, rows[i][0] is None or rows[i][0] == least))
    return sorted(out, key=repr)


def result(spark, rows):
    frame = spark.createDataFrame([(*row, 1, 2, "x", 3) for row in rows], SCHEMA)
    return sorted((tuple(row) for row in spherical.near_duplicates(frame).collect()), key=repr)


def test_given_vectors(spark):
    frame = spark.read.parquet(f"{data.SF_DIR}/embeddings.parquet")
    rows = [(r.vec_id, list(r.embedding), r.label) for r in frame.collect()]
    assert result(spark, rows) == brute_force(rows)


def test_hostile_rows(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((6, 24))
    rows = [(100 + k, (base[k % 6] + rng.normal(0, 0.03, 24)).tolist(), k % 2) for k in range(60)]
    rows += [(200 + k, (base[0] * (k + 1)).tolist(), 0) for k in range(10)]
    rows += [
        (1, None, 1),
        (2, [], 1),
        (3, [0.0] * 24, 1),
        (4, [None, *[1.0] * 23], 1),
        (5, [math.nan, *[1.0] * 23], 1),
        (6, [math.inf, *[1.0] * 23], 1),
        (7, base[0].tolist(), None),
        (None, base[0].tolist(), 0),
        (9, base[0].tolist(), 0),
        (9, base[0].tolist(), 0),
        (9, None, 0),
        (10, [1e-30] * 24, 0),
        (11, [1e30] * 24, 0),
        (12, [1.0] * 24, 0),
        (13, [1.0], 0),
        (14, [3.0], 0),
        (15, [-3.0], 0),
        (16, [1.0, 2.0, 3.0], 0),
        (17, [1.0, 2.0, 3.1], 0),
    ]
    assert result(spark, rows) == brute_force(rows)


def test_buckets_are_tiled(spark, monkeypatch):
    """A group much larger than a tile, with copies."""
    monkeypatch.setattr(spherical, "TILE", 16)
    rng = np.random.default_rng(4)
    centre = rng.standard_normal(32)
    rows = [(k, (centre + rng.normal(0, 0.11, 32)).tolist(), 7) for k in range(90)]
    rows += [(500 + k, centre.tolist(), 7) for k in range(20)]
    rows += [(700 + k, rng.standard_normal(32).tolist(), 7) for k in range(50)]
    assert result(spark, rows) == brute_force(rows)


def test_recall_at_the_least_cosine():
    rng = np.random.default_rng(5)
    for dim in (3, 24, 64):
        rotation, codes = spherical._codes(dim, 64)
        one = rng.standard_normal((500, dim))
        one /= np.linalg.norm(one, axis=1, keepdims=True)
        step = rng.standard_normal((500, dim))
        step -= (step * one).sum(1, keepdims=True) * one
        step /= np.linalg.norm(step, axis=1, keepdims=True)
        two = 0.98 * one + math.sqrt(1 - 0.98**2) * step
        lists = []
        for side in (one, two):
            row, found = spherical.list_decode(side @ rotation, codes, spherical.margin(dim))
            lists.append([set(found[row == k]) for k in range(500)])
        assert all(a & b for a, b in zip(*lists))


def test_decoding_lists_all_filters():
    rng = np.random.default_rng(6)
    _, codes = spherical._codes(12, 5)
    vectors = rng.standard_normal((40, 12))
    row, found = spherical.list_decode(vectors, codes, 0.8)
    a, b = (part @ code.T for part, code in zip(np.split(vectors, [6], axis=1), codes))
    full = (a[:, :, None] + b[:, None, :]).reshape(40, -1)
    full = full.max(1, keepdims=True) - full
    assert set(zip(row, found)) == set(zip(*np.nonzero(full <= 0.8)))


def test_no_rows(spark):
    assert result(spark, []) == []
