import hashlib
import os
import random

import numpy as np

from sheafwork.llm import sharing, suffixes
from tests.llm import data


def brute_force(rows):
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for doc_id, text in texts:
        if doc_id is not None:
            for at in range(len(text) - 49):
                window = text[at : at + 50]
                first[window] = min(first.get(window, doc_id), doc_id)
    out = []
    for doc_id, text in texts:
        gone = np.zeros(len(text), bool)
        if doc_id is not None:
            for at in range(len(text) - 49):
                if first[text[at : at + 50]] < doc_id:
                    gone[at : at + 50] = True
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(bool(g) and not p for g, p in zip(gone, [False, *gone]))
        out.append((doc_id, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(frame):
    return sorted((tuple(row) for row in suffixes.deduplicate(frame).drop("kept").collect()), key=repr)


def test_given_documents(spark):
    docs = spark.read.parquet(f"{data.SF_DIR}/documents.parquet")
    assert result(docs) == brute_force([(row.doc_id, row.text) for row in docs.collect()])


def hostile():
    rng = random.Random(9)
    rows = data.texts()
    long = data.prose(70, 60)
    for k in range(80):
        a, b = sorted(rng.randrange(len(long)) for _ in range(2))
        rows.append((1000 - k, data.prose(k, rng.randrange(6)) + long[a:b] + data.prose(-k, rng.randrange(6))))
    rows += [(2000 + k, "ab" * (20 + k)) for k in range(12)] + [(2100 + k, "z" * (45 + 7 * k)) for k in range(4)]
    rows += [(2200, "é" * 40), (2201, "x" + "é" * 30), (2202, "a" * 49), (2203, "a" * 50), (2204, "a" * 51)]
    return rows


def test_hostile_rows(spark):
    assert result(data.documents(spark, hostile())) == brute_force(hostile())


def test_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(sharing, "DOCS_PER_BLOCK", 7)
    monkeypatch.setattr(suffixes, "_SLICE_BYTES", 500)
    rows = [row for row in hostile() if len(row[1] or "") < 5_000]
    assert result(data.documents(spark, rows)) == brute_force(rows)


def test_longest_previous_factors():
    """Against all pairs: random bytes of few letters, a common prefix, ties, one document."""
    rng = random.Random(4)
    for size in (0, 1, 2, 40, 300):
        for documents in (1, 3, size + 1):
            starts = [rng.choice(["", "a" * 20, "b" * 24, "ab" * 24]) for _ in range(size)]
            texts = [(x + data.prose(rng.randrange(9), 20)).encode()[:50] for x in starts]
            rows = sorted(x.ljust(50, rng.choice([b"a", b"b"])) for x in texts)
            docs = [rng.randrange(documents) for _ in rows]
            matrix = np.frombuffer(b"".join(rows), np.uint8).reshape(-1, 50)
            found = suffixes.longest_previous_factors(matrix, np.array(docs, np.int64)).tolist()
            for row, doc, length in zip(rows, docs, found):
                best = max((len(os.path.commonprefix([row, r])) for r, d in zip(rows, docs) if d < doc), default=0)
                assert length == best if best >= suffixes.GRAM else length < suffixes.GRAM


def test_all_of_one_order():
    """Nearest smaller documents far away: ascending and descending ones, equal suffixes."""
    size = 5000
    matrix = np.full((size, 50), 97, np.uint8)
    for docs in (np.arange(size), np.arange(size)[::-1]):
        assert (suffixes.longest_previous_factors(matrix, docs) == np.where(docs > 0, 50, 0)).all()


def test_no_rows(spark):
    assert result(data.documents(spark, [])) == []
    assert result(data.documents(spark, [(1, "short"), (2, None)])) == brute_force([(1, "short"), (2, None)])
