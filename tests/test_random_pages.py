"""Page queries against their SQL on generated pages the given tables do not have."""

import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as contract
from tests.test_oracle import rows_of

PARTS = [
    "<!DOCTYPE html>",
    '<html lang="{w}">',
    "<HTML class='c' LANG={w}>",
    '<html lang="">',
    '<meta charset="{w}">',
    "<META content='text/html; charset={w}' http-equiv=content-type>",
    "<meta name=viewport>",
    "<title>{w}</title>",
    "<TITLE >{w}\n{w}</TITLE >",
    "<title>",
    "<h1><b>{w}</b> {w}</h1>",
    "<h1 id=a>{w}</H1>",
    "<h1>",
    "<style>li {{ {w} }}</style>",
    "<script>'<style>{w}</style>' <li></script>",
    "<SCRIPT src=a>{w}</SCRIPT >",
    "<script>",
    "<!-- {w} <li> -->",
    "<!--",
    "<!-->",
    "<!--->",
    "-->",
    "<p>{w}</p>",
    "<br/>",
    "<a href='x>y'>{w}</a>",
    "{w} < {w}",
    "<>",
    "&amp;&#91;",
    "\t",
    "\r\n",
    "  ",
    "<ul>",
    "</ul>",
    "<li>{w}",
    "<LI class=x>{w}</LI>",
    "<li>{w}</li>",
    "</li >",
    "<link rel=a>",
    "<li",
    "é가",
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    rng = random.Random(8)

    def page():
        parts = rng.choices(PARTS, k=rng.randint(0, 25))
        return "".join(part.format(w=rng.choice("abcde") * 2) for part in parts)

    pages = [page() for _ in range(4000)]
    path = tmp_path_factory.mktemp("generated")
    table = pa.table({"page_id": range(len(pages)), "url": ["u"] * len(pages), "html": pages})
    pq.write_table(table, path / "pages.parquet")
    return str(path)


@pytest.mark.parametrize("name", ["page_metadata", "page_text", "page_list_items"])
def test_page_query(spark, folder, name):
    frame = contract.queries()[name](spark, folder)
    sql = contract.oracle_sql()[name].replace("pages", f"'{folder}/pages.parquet'")
    result = duckdb.sql(sql)
    expected = rows_of(result.columns, result.fetchall())
    found = rows_of(frame.columns, frame.collect())
    differing = [pair for pair in zip(found, expected) if pair[0] != pair[1]]
    assert not differing[:3]
    assert len(found) == len(expected)
