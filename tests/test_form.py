"""A hand-written form with known counts, read from a file."""

import os

import pytest
from pyspark.sql import functions as F

from sheafwork import operators as op
from sheafwork import plans, sources

FORM = os.path.join(os.path.dirname(__file__), "data", "form.html")


@pytest.fixture(scope="module")
def form(spark):
    return sources.scan_documents(spark, FORM)


@pytest.fixture(scope="module")
def items(form):
    return op.list_items(op.sections(form))


def test_scan(form):
    (row,) = form.collect()
    with open(FORM, encoding="utf-8") as file:
        assert row["html"] == file.read()
    assert row["doc_id"].endswith("/tests/data/form.html")


def test_metadata(form):
    row = op.document_metadata(form).drop("doc_id").first()
    assert tuple(row) == ("en", "UTF-8", "Rain gauge log", "Rain gauge log, station 12")


def test_text(form):
    text = op.document_text(form).first()["text"]
    assert text.startswith("Rain gauge log Rain gauge log, station 12 Fill in after each storm. 1.")
    assert text.endswith("Signed: Keep for ten years.")
    assert "padding" not in text


def test_headings(form):
    rows = op.parse_heading(op.sections(form)).orderBy("pos").collect()
    assert [(r["pos"], r["no"], r["title"], r["marker"]) for r in rows] == [
        (1, 1, "Readings", "millimetres"),
        (2, 2, "Instrument", None),
        (3, 3, "Observer", None),
    ]


def test_counts_per_section(items):
    slots = op.unfilled(op.label_values(items))
    counts = slots.groupBy("pos").agg(
        F.count("*"),
        F.count_if(F.contains("content", F.lit('class="highlight"'))),
        F.count_if(F.contains("content", F.lit('class="placeholder"'))),
        F.count_if("is_unfilled"),
        F.count("label"),
    )
    assert [tuple(row) for row in counts.orderBy("pos").collect()] == [
        (1, 5, 2, 2, 3, 3),
        (2, 1, 0, 1, 1, 0),
        (3, 3, 2, 1, 2, 2),
    ]


def test_slots(items):
    rows = op.slots(items).orderBy("pos", "item").collect()
    assert [tuple(row)[1:] for row in rows] == [
        (1, 1, "Depth", "17", None, False),
        (1, 2, None, None, "Hourly", True),
        (1, 3, "Peak", None, "highest hour", True),
        (1, 4, None, None, "second highest", True),
        (1, 5, "Lull", "from 3:10 to 4:25", None, False),
        (2, 1, None, None, "serial: on the base plate", True),
        (3, 1, "Shift", None, "dawn or dusk", True),
        (3, 2, None, "windy, cold", None, False),
        (3, 3, "Signed", None, None, True),
    ]


def test_tree(form):
    rows = op.item_tree(op.sections(form)).orderBy("pos", "item").collect()
    places = [(r["pos"], r["item"], r["depth"], r["parent_item"]) for r in rows]
    assert places == [
        (1, 1, 1, None),
        (1, 2, 1, None),
        (1, 3, 2, 2),
        (1, 4, 2, 2),
        (1, 5, 2, 2),
        (2, 1, 1, None),
        (3, 1, 1, None),
        (3, 2, 1, None),
        (3, 3, 1, None),
    ]


def test_completeness(form, items):
    slots = op.slots(items)
    assert tuple(op.completeness(slots).first()) == (9, 3, 1 / 3)
    assert tuple(op.completeness_documents(form).drop("doc_id").first()) == (9, 3, 1 / 3)
    per_section = op.completeness(slots, "pos").orderBy("pos").collect()
    assert [tuple(row) for row in per_section] == [(1, 5, 2, 0.4), (2, 1, 0, 0.0), (3, 3, 1, 1 / 3)]


def test_wide(form, items):
    labels = ["Depth", "Shift", "Lull", "Unknown"]
    long_way = op.wide(op.slots(items), labels).drop("doc_id").first()
    row_local = op.wide_documents(form, labels).drop("doc_id").first()
    assert tuple(long_way) == tuple(row_local) == ("17", None, "from 3:10 to 4:25", None)
    assert op.label_map(form).first()["slots"] == {"Depth": "17", "Lull": "from 3:10 to 4:25"}


def test_document_slots(form, items):
    assert plans.document_slots(form).exceptAll(op.slots(items)).isEmpty()
