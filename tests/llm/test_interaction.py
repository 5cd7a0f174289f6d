import itertools
import re
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from sheafwork.llm import interaction
from tests.llm import data
from tests.llm.test_exact import HOSTILE


def brute_force(rows, labels):
    marks = {}
    for doc_id, quality, toxic in labels:
        if doc_id is not None:
            good, bad = marks.get(doc_id, (False, False))
            marks[doc_id] = (good or quality == 1, bad or toxic == 1)
    judged = []
    for doc_id, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        earlier = [i for i, t, _ in rows if (t or "") == text and i is not None]
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": doc_id is not None and min(earlier) < doc_id,
        }
        judged.append((source or "", {k for k, v in fails.items() if v}, *marks.get(doc_id, (False, False))))
    out = []
    for part in {row[0] for row in judged}:
        own, shares, steps = [row[1:] for row in judged if row[0] == part], dict.fromkeys("ABCDE", 0), []
        for order in map("".join, itertools.permutations("ABCDE")):
            for step, name in enumerate(order, 1):
                left = [row for row in own if not row[0] & set(order[: step - 1])]
                here = [row for row in left if name in row[0]]
                redundant = sum(name in row[0] for row in own) - len(here)
                alone = sum(row[0] == {name} for row in own)
                shares[name] += len(here)
                lost = (sum(row[1] for row in here), sum(row[2] for row in here))
                steps.append((part, order, step, len(left) - len(here), len(here), redundant, alone, *lost))
        out += [(*row, shares[row[1][row[2] - 1]]) for row in steps]
    return sorted(out)


def hostile():
    long_ = data.prose(1, 300)
    more = [(100 + i, long_ if i % 3 else data.prose(i, 250), f"s{i % 2}") for i in range(40)]
    more += [(200, "same word " * 150, "s1"), (201, "A B C " * 100, ""), (202, "a|b", "s0"), (203, long_ + " #", "new")]
    return [(i, t, None if k % 4 else "s0") for k, (i, t) in enumerate(HOSTILE)] + more


LABELS = [(i, i % 2, i % 3 == 0) for i in range(1, 230)] + [(5, 1, 1), (None, 1, 1), (6, None, None), (9_999, 1, 1)]


def result(spark, rows, labels=LABELS, **options):
    wide = [(i, t, s, i, "x", b"1", 1, "y") for i, t, s in rows]
    kinds = "doc_id long, text string, source string, mask long, part string, digest binary, quality int, toxic string"
    frame = spark.createDataFrame(wide, kinds)
    marks = [(i, q, None if t is None else int(t), "z") for i, q, t in labels]
    marks = spark.createDataFrame(marks, "doc_id long, quality int, toxic int, source string")
    return sorted(map(tuple, interaction.audit(frame, marks, **options).collect()))


def test_hostile_rows(spark):
    assert result(spark, hostile()) == brute_force(hostile(), LABELS)


def test_texts_with_one_digest(spark):
    found = result(spark, hostile(), digest=lambda text: bytes([len(text) % 2]) * 16)
    assert found == brute_force(hostile(), LABELS)


def test_full_sketch(spark, monkeypatch):
    """Cells that are all taken clear no text, and nothing else changes."""
    monkeypatch.setattr(interaction, "MOST_CELLS", 3)
    assert result(spark, hostile()) == brute_force(hostile(), LABELS)


@pytest.mark.parametrize("labels", [[], LABELS])
def test_no_rows(spark, labels):
    assert result(spark, [], labels) == []


def test_unique_texts_stay(spark):
    """The sketch clears nearly all texts that no other row has."""
    rows = [(i, f"text number {i}", "s") for i in range(4_000)] + [(5_000 + i, "copy", "s") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    cells = interaction.CELLS_PER_TEXT * 4_050
    marked = interaction.marked(docs, cells, interaction.xxhash.xxh3_128_digest)
    sketch = interaction.several(marked, cells)
    found = interaction.repeated(docs, sketch, cells, interaction.xxhash.xxh3_128_digest).collect()
    assert [row.first for row in found if row.text == "copy"] == [5_000]
    assert len(found) < 400


def test_no_files_are_written(spark):
    """Each file written costs a process that for a moment counts as large as the executor."""
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.rglob("*.parquet"))
    assert result(spark, hostile()) == brute_force(hostile(), LABELS)
    assert set(shared.rglob("*.parquet")) == before


def test_changed_input_is_read_again(spark, tmp_path):
    path = str(tmp_path / "docs.parquet")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for rows in hostile(), hostile()[::-2]:
        columns = dict(zip(("doc_id", "text", "source"), map(list, zip(*rows))))
        pq.write_table(pa.table(columns), path)
        found = interaction.audit(spark.read.parquet(path), marks).collect()
        assert sorted(map(tuple, found)) == brute_force(rows, [])
