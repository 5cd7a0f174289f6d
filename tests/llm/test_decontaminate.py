import random

import numpy as np
import pytest

from sheafwork.llm import decontaminate
from tests.llm import data


def distances(item, text):
    """Edits of the best passage that ends at each place."""
    row = list(range(len(item) + 1))
    out = [row[-1]]
    column = row
    for char in text:
        before, column = column, [0]
        for k in range(1, len(item) + 1):
            column.append(
                min(before[k - 1] + (item[k - 1] != char), before[k] + 1, column[k - 1] + 1)
            )
        out.append(column[-1])
    return out


def edited(text, number, rng):
    chars = list(text)
    for _ in range(number):
        place = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[place] = "#"
        elif kind == 1:
            del chars[place]
        else:
            chars.insert(place, "+")
    return "".join(chars)


ITEMS = [(k, data.prose(40 + k, n)) for k, n in enumerate([12, 25, 40, 60, 4])]
ITEMS += [(10, None), (11, ""), (12, "short"), (13, ITEMS[0][1]), (None, data.prose(60, 15))]


def bench(spark, rows=ITEMS):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], "item_id long, text string, start int, doc_id int")


@pytest.mark.parametrize("seed", range(4))
def test_passages_against_full_alignment(spark, seed):
    rng = random.Random(seed)
    rows = []
    for k in range(25):
        item = ITEMS[rng.randrange(5)][1]
        inside = edited(item, rng.randrange(0, 8), rng)
        rows.append((k, data.prose(rng.random(), rng.randrange(30)) + "\n" + inside.upper() + " " + data.prose(k, 9)))
    found = decontaminate.passages(data.documents(spark, rows), bench(spark)).collect()
    found = {(r.doc_id, r.item_id): r for r in found}
    for doc_id, text in rows:
        plain = "".join(map(chr, decontaminate.folded(text)))
        for item_id, item in ITEMS:
            if not item or len(item) < 10:
                continue
            best = min(distances(item, plain))
            row = found.get((doc_id, item_id))
            assert (row is not None) == (best <= decontaminate.edits_allowed(len(item)))
            if row:
                assert row.edits == best == distances(item, plain[row.start : row.end])[-1]


def test_hostile_rows(spark):
    rows = data.texts() + [(50, ITEMS[3][1]), (51, ITEMS[1][1] + ITEMS[1][1]), (52, (ITEMS[0][1] + " ") * 50)]
    found = decontaminate.passages(data.documents(spark, rows), bench(spark)).collect()
    counts = {}
    for row in found:
        counts[row.doc_id, row.item_id] = counts.get((row.doc_id, row.item_id), 0) + 1
        assert row.edits == 0
    assert counts == {(50, 3): 1, (51, 1): 2, (52, 0): 50, (52, 13): 50}


def test_passages_are_cut(spark):
    rows = data.texts() + [(50, "before " + ITEMS[3][1] + "\nafter"), (51, ITEMS[2][1])]
    docs = data.documents(spark, rows)
    clean = decontaminate.decontaminate(docs, bench(spark))
    assert clean.schema == docs.schema
    texts = {row.doc_id: row.text for row in clean.collect()}
    assert (texts[50], texts[51], texts[4], texts[5]) == ("before after", "", None, "")
    assert texts[11] == dict(data.texts())[11]


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 150)
    found = decontaminate.passages(data.documents(spark, [(1, x) for _, x in ITEMS[:4]]), bench(spark)).collect()
    assert sorted((r.item_id, r.edits) for r in found) == [(0, 0), (1, 0), (2, 0), (3, 0), (13, 0)]


@pytest.mark.parametrize("turned", [False, True])
def test_items_that_overlap_are_cut_whole(spark, monkeypatch, turned):
    """An item that is half of another one is cut with it, in one block or in two."""
    whole = data.prose(77, 40)
    items = [(1, whole[: len(whole) // 2]), (2, whole)]
    docs = data.documents(spark, [(1, f"before {whole} after")])
    for size in (1 << 20, 20):
        monkeypatch.setattr(decontaminate, "BLOCK_CHARS", size)
        # One partition, so that the items come in this order.
        given = bench(spark, items[::-1] if turned else items).coalesce(1)
        assert [r.text for r in decontaminate.decontaminate(docs, given).collect()] == ["before after"]


PERIODIC = [(1, "la " * 9 + "la"), (2, "1010" * 6), (3, "ab" * 5), (4, "x" * 40), (5, "na na na na batman " * 2)]


def left_over(items, text):
    plain = "".join(map(chr, decontaminate.folded(text)))
    return [i for i, item in items if min(distances(item, plain)) <= decontaminate.edits_allowed(len(item))]


@pytest.mark.parametrize("seed", range(3))
def test_items_and_texts_that_repeat_themselves(spark, seed):
    """No passage is left between those found, and no item in a text that was cleaned."""
    rng = random.Random(seed)
    rows = [(1, "before " + "la " * 40 + "after"), (2, "10" * 70), (3, "x" * 500), (4, "la " * 2_000)]
    for k in range(10, 30):
        parts = [edited(rng.choice(PERIODIC)[1] * rng.randrange(1, 4), rng.randrange(3), rng) for _ in range(4)]
        rows.append((k, data.prose(k, 4).join(parts)))
    docs, given = data.documents(spark, rows), bench(spark, PERIODIC)
    found = {}
    for row in decontaminate.passages(docs, given).collect():
        found.setdefault((row.doc_id, row.item_id), []).append((row.start, row.end, row.edits))
    for (doc_id, text), (item_id, item) in ((r, i) for r in rows for i in PERIODIC):
        if len(text) > 2_000:
            continue
        plain, at = "".join(map(chr, decontaminate.folded(text))), 0
        for start, end, edits in sorted(found.get((doc_id, item_id), [])) + [(len(plain), len(plain), None)]:
            assert at <= start
            assert min(distances(item, plain[at:start])) > decontaminate.edits_allowed(len(item))
            assert edits is None or distances(item, plain[start:end])[-1] == edits
            at = end
    clean = {row.doc_id: row.text for row in decontaminate.decontaminate(docs, given).collect()}
    assert not any(left_over(PERIODIC, text) for text in clean.values())
    assert (clean[1], clean[4]) == ("before after", "")


def test_halves_that_meet_by_a_cut(spark):
    """An item around another one is gone as well."""
    outer, inner = data.prose(70, 30), data.prose(71, 20)
    half = outer.index(" ", len(outer) // 2)
    text = f"before {outer[:half]} {inner}{outer[half:]} after"
    docs, given = data.documents(spark, [(1, text)]), bench(spark, [(1, outer), (2, inner)])
    assert [r.text for r in decontaminate.decontaminate(docs, given).collect()] == ["before after"]


def test_a_column_with_the_name_used_inside(spark):
    frame = spark.createDataFrame([(1, f"a {ITEMS[2][1]} b", "x", 2)], "doc_id long, text string, decontaminate_spans string, item_id int")
    assert [tuple(r) for r in decontaminate.decontaminate(frame, bench(spark)).collect()] == [(1, "a b", "x", 2)]


def test_no_rows(spark):
    assert decontaminate.passages(data.documents(spark, []), bench(spark)).collect() == []
    assert decontaminate.passages(data.documents(spark), bench(spark, [])).collect() == []
    assert np.all(decontaminate.folded("A\n É") == [97, 32, 32, 233])
