"""Pages made of starts without ends: a pattern that ran on to the end of the page
for each of them would take minutes here."""

import time

import pytest

from sheafwork import operators as op
from sheafwork import plans

SIZE = 150_000
ITEM = "<ul><li>"
PAGES = {
    "less": "<" * SIZE,
    "tags": "<a" * (SIZE // 2),
    "scripts": "<script>" * (SIZE // 8),
    "comments": "<!--" * (SIZE // 4),
    "open items": "<li " * (SIZE // 4),
    "open lists": "<ul " * (SIZE // 4) + "<li>x",
    "open headings": "<h2 " * (SIZE // 4),
    "titles": "<title>" * (SIZE // 7),
    "h1": "<h1>" * (SIZE // 4),
    "meta": "<meta " * (SIZE // 6),
    "html": "<html " * (SIZE // 6),
    "heading": "<h2>1. " + "a (" * (SIZE // 3) + "</h2>",
    "white space": " \n" * (SIZE // 2),
    "brackets": ITEM + "[" * SIZE,
    "bracketed colons": ITEM + "[:" * (SIZE // 2) + "]:",
    "colons": ITEM + "a:" * (SIZE // 2),
    "placeholders": ITEM + '<span class="placeholder">' * (SIZE // 26),
    "spans": ITEM + "placeholder " + "<span " * (SIZE // 6) + ">",
    "entities": ITEM + "a: " + "&amp;lt;" * (SIZE // 8),
    "items": "<ul>" + "<li>x</li>" * (SIZE // 10) + "</ul>",
}


@pytest.mark.parametrize(
    "operator",
    [
        op.document_metadata,
        op.document_text,
        lambda pages: op.parse_heading(op.sections(pages)),
        plans.document_slots,
        op.item_tree,
        lambda pages: op.wide_documents(pages, ["a"]),
    ],
    ids=["metadata", "text", "headings", "slots", "tree", "wide"],
)
def test_hostile_pages(spark, operator):
    pages = spark.createDataFrame(list(PAGES.items()), "doc_id string, html string")
    rows = operator(pages.repartition(8, "doc_id"))
    start = time.monotonic()
    rows.write.format("noop").mode("overwrite").save()
    assert time.monotonic() - start < 60
