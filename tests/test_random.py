"""Operators against brute force on generated input."""

import random
import re

import pytest

from sheafwork import operators as op
from sheafwork import plans

TAGS = ["<ul>", '<UL class="x">', "<ol>", "</ul>", "</OL >", "<li>", "<li a=b>", "<LI>", "</li>"]
OTHER = ["x", " ", "<link>", "<b>y</b>", "<ul <li>", "<ul ", "</ol ", "<ul", "<!-- <li> -->", "<style>ul{}</style>", "<ulx>"]
ITEM = r"<li(?:\s[^>]*)?>"


def brute_tree(html):
    """Walk the tags one by one with a stack."""
    html = re.sub(r"(?is)<style>.*?</style>|<!--.*?-->", " ", html)
    stack, last, item, found = [], None, 0, []
    while html:
        li = re.match(f"(?i){ITEM}", html)
        edge = re.match(rf"(?i)<(/?)[ou]l(\s((?!{ITEM})[^>])*)?(>|(?={ITEM})|\Z)", html)
        if li:
            item += 1
            last = item
            found.append((item, len(stack), stack[-1] if stack else None))
        elif edge and not edge.group(1):
            stack.append(last)
            last = None
        elif edge and stack:
            last = stack.pop()
        html = html[(li or edge).end() :] if li or edge else html[1:]
    return found


def test_tree(spark):
    rng = random.Random(5)
    pages = [
        "".join(rng.choice(TAGS if rng.random() < 0.8 else OTHER) for _ in range(rng.randint(0, 40)))
        for _ in range(3000)
    ]
    frame = spark.createDataFrame(list(enumerate(pages)), "doc_id int, html string")
    found = {}
    for row in op.item_tree(frame.repartition(8)).orderBy("doc_id", "item").collect():
        place = (row["item"], row["depth"], row["parent_item"])
        found.setdefault(row["doc_id"], []).append(place)
    for key, page in enumerate(pages):
        assert found.get(key, []) == brute_tree(page), page
    plain_items = op.list_items(frame).drop("depth", "parent_item")
    assert op.item_tree(frame).drop("depth", "parent_item").exceptAll(plain_items).isEmpty()


def test_long_and_deep_sections(spark):
    wide = "<ul>" + "<li>a<ul><li>b</li></ul></li>" * 50_000 + "</ul>"
    deep = "<ul><li>a" * 600
    frame = spark.createDataFrame([(1, wide), (2, deep)], "doc_id int, html string")
    rows = op.item_tree(frame).select("doc_id", "item", "depth", "parent_item").collect()
    places = {(r["doc_id"], r["item"]): (r["depth"], r["parent_item"]) for r in rows}
    assert len(places) == len(rows) == 100_600
    for item in range(1, 100_001):
        assert places[1, item] == ((1, None) if item % 2 else (2, item - 1))
    for item in range(1, 601):
        assert places[2, item] == (item, item - 1 or None)


def brute_slot(text):
    """Label and value by walking the characters."""
    text = " ".join(text.split())
    inside = [False] * len(text)
    for bracket in re.finditer(r"\[[^\]]*\]", text):
        inside[bracket.start() : bracket.end()] = [True] * len(bracket.group())
    label, value = None, text
    for i, char in enumerate(text):
        if char == ":" and not inside[i]:
            words = re.sub(r"\[[^\]]*\]", " ", text[:i])
            label = " ".join(words.split()) or None
            value = text[i + 1 :].strip() if label else text
            break
    if re.fullmatch(r"\[[^\]]*\]", value):
        return label, None, value[1:-1].strip() or None
    return label, value or None, None


def test_slots(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choice("ab:[] ") for _ in range(rng.randint(0, 14))) for _ in range(5000)]
    pages = [(i, f"<ul><li>{text}</li></ul>") for i, text in enumerate(texts)]
    frame = spark.createDataFrame(pages, "doc_id int, html string").repartition(8)
    rows = plans.document_slots(frame).collect()
    assert len(rows) == len(texts)
    for row in rows:
        expected = brute_slot(texts[row["doc_id"]])
        assert (row["label"], row["value"], row["hint"]) == expected, texts[row["doc_id"]]
        assert row["is_unfilled"] == (row["value"] is None)


@pytest.fixture(scope="module")
def rendered(spark):
    rng = random.Random(7)
    alphabet = "ab:[]<>&; \n\té가/\"'="
    words = ["&amp;", "<li>", "</li>", "<h2>1. x</h2>", "<ul>", '<span class="placeholder">', "-->"]

    def value():
        if rng.random() < 0.15:
            return None
        return "".join(
            rng.choice(words) if rng.random() < 0.2 else rng.choice(alphabet)
            for _ in range(rng.randint(0, 12))
        )

    values = [(i, value(), value(), value()) for i in range(4000)]
    form = op.Form(
        "T",
        (
            op.Section("S", (op.Slot("h", "A", "a"), op.Group("g", (op.Slot("h", "B", "b"),)))),
            op.Section("U", (op.Slot("i", "C", "c"),), marker="m"),
        ),
    )
    frame = spark.createDataFrame(values, "k int, a string, b string, c string")
    return values, op.render(frame.repartition(8), form, "k")


def squeezed(value):
    return None if value is None else " ".join(re.split(r"[ \t\r\n\f]+", value)).strip(" ") or None


def test_render_reads_back(rendered):
    values, pages = rendered
    expected = {row[0]: tuple(map(squeezed, row[1:])) for row in values}
    for rows in (op.wide(plans.document_slots(pages), "ABC"), op.wide_documents(pages, "ABC")):
        assert {row[0]: tuple(row)[1:] for row in rows.collect()} == expected


def test_rendered_tree(rendered):
    values, pages = rendered
    tree = op.item_tree(op.sections(pages))
    places = tree.groupBy("pos", "item", "depth", "parent_item").count().collect()
    assert {tuple(row) for row in places} == {
        (1, 1, 1, None, len(values)),
        (1, 2, 1, None, len(values)),
        (1, 3, 2, 2, len(values)),
        (2, 1, 1, None, len(values)),
    }
