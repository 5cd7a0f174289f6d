import random

import numpy as np
import pyarrow as pa

from sheafwork.llm import minhash
from sheafwork.llm.components import components
from tests.llm import data


def shingles(text):
    words = (text or "").encode().lower().split()
    width = min(5, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if words else set()


def brute_force(rows):
    sets = [shingles(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][0] == rows[j][0] is not None
            shared = len(sets[i] & sets[j])
            if same or shared and 100 * shared >= 75 * len(sets[i] | sets[j]):
                if rows[i][0] is not None and rows[j][0] is not None:
                    root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        least = min((rows[j][0] for j in range(len(rows)) if find(j) == find(i)), key=lambda x: x or 0)
        out.append((doc_id, len(sets[i]), least, doc_id == least))
    return sorted(out, key=repr)


def result(frame):
    return sorted((tuple(row) for row in minhash.near_duplicates(frame).collect()), key=repr)


def test_hostile_rows(spark):
    assert result(data.documents(spark)) == brute_force(data.texts())


def test_given_documents(spark):
    docs = spark.read.parquet(f"{data.SF_DIR}/documents.parquet")
    assert result(docs) == brute_force([(row.doc_id, row.text) for row in docs.collect()])


def test_chain_of_edits_and_groups(spark):
    """Neighbours of a chain are links, its ends are not; a bucket holds two groups."""
    words = data.prose(7, 100).split()
    rows = []
    for step in range(12):
        words[step * 8] = f"new{step}"
        rows.append((100 - step, " ".join(words)))
    rows += [(200 + k, data.prose(8, 60) + f" tail{k % 7} end{k % 3}") for k in range(60)]
    assert result(data.documents(spark, rows)) == brute_force(rows)


def look_alikes(seed, count, edits):
    """Copies of one text with so many words changed that about a third of the pairs are links."""
    rng = random.Random(seed)
    base, rows = data.prose(seed, 150).split(), []
    for number in range(count):
        words = base[:]
        for _ in range(rng.randint(0, edits)):
            words[rng.randrange(150)] = f"edit{rng.randrange(60)}"
        rows.append((seed * 10_000 + number, " ".join(words)))
    return rows


def test_look_alikes(spark, monkeypatch):
    """Buckets with links and look-alikes, in one tile and in several."""
    rows = [row for seed in range(3) for row in look_alikes(seed + 1, 120, 4 + 4 * seed)]
    expected = brute_force(rows)
    assert len({row[2] for row in expected}) > 30
    assert result(data.documents(spark, rows)) == expected
    monkeypatch.setattr(minhash, "TILE_ROWS", 16)
    monkeypatch.setattr(minhash, "TILE_BYTES", 20_000)
    assert result(data.documents(spark, rows)) == expected


def test_texts_of_one_id(spark):
    """A document is linked as any of its texts is."""
    x, y = data.prose(1, 100), data.prose(2, 100)
    rows = [(1, x), (2, y), (10, x + " tail"), (10, y + " tail"), (10, ""), (11, y + " other"), (12, None), (12, "a b")]
    rows += [(13, "a b"), (None, x), (None, None)]
    assert result(data.documents(spark, rows)) == brute_force(rows)
    assert [row[2] for row in result(data.documents(spark, rows)) if row[0] == 10] == [1, 1, 1]


def test_tile_links_are_a_forest():
    sets = [np.arange(100, dtype=np.uint64) + np.uint64(k) for k in range(0, 40, 2)]
    prints = np.zeros((40, minhash.BINS), np.uint8).tobytes()
    tile = pa.table(
        {
            "side": [0] * 20 + [1] * 20,
            "node": list(range(20)) * 2,
            "component": list(range(20)) * 2,
            "prints": [prints[: minhash.BINS]] * 40,
            "shingles": [x.tobytes() for x in sets] * 2,
        }
    )
    found = minhash._tile_links(tile).to_pylist()
    assert len(found) == 19 and {x for row in found for x in row.values()} == set(range(20))


def test_no_rows(spark):
    assert result(data.documents(spark, [])) == []


def test_components(spark):
    pairs = [(i, i + 1) for i in range(1, 40)] + [(90, 80), (80, 90), (7, 7), (None, 3), (60, 70)]
    found = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {row.node: row.component for row in found} == (
        {i: 1 for i in range(1, 41)} | {80: 80, 90: 80, 60: 60, 70: 60}
    )
