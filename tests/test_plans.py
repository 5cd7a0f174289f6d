"""What the optimizer makes of the queries."""

import re

import pytest

import __spark_entry__ as contract
from sheafwork import operators as op
from sheafwork import plans, shared_folder, sources
from tests.test_oracle import QUERIES

SF_DIR = "/root/testdata/sf0.001"
HIDDEN = "|!--(?:-?>"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def pages(spark):
    return sources.documents_from_pages(spark.read.parquet(f"{SF_DIR}/pages.parquet"))


@pytest.fixture(scope="module")
def forms(spark):
    return plans.customer_documents(spark.read.parquet(f"{SF_DIR}/customer.parquet"))


def test_row_local_operators_do_not_shuffle(pages, forms):
    for frame in (
        op.document_metadata(pages),
        op.document_text(pages),
        op.list_items(pages),
        op.item_tree(pages),
        forms,
        op.parse_heading(op.sections(forms)),
        op.item_tree(op.sections(forms)),
        plans.document_slots(forms),
        op.wide_documents(forms, ["Name"]),
        op.completeness_documents(forms),
        op.label_map(forms),
    ):
        plan = plan_of(frame)
        for operator in ("Exchange", "Sort", "Window", "Join", "Python"):
            assert operator not in plan


def test_aggregations_shuffle_partial_results_once(pages, forms):
    slots = plans.document_slots(forms)
    for frame in (
        plans.items_per_language(pages),
        op.completeness(slots, "label"),
        op.completeness(slots, "doc_id"),
        op.wide(slots, ["Name", "Balance"]),
    ):
        plan = plan_of(frame)
        assert plan.count("Exchange") == 1
        assert "partial_" in plan.split("Exchange")[1]


def test_only_needed_columns_are_read(pages, forms):
    assert "ReadSchema: struct<page_id:bigint,html:string>" in plan_of(op.document_text(pages))
    assert "ReadSchema: struct<html:string>" in plan_of(plans.items_per_language(pages))
    wide = op.wide_documents(forms, ["Name"]).select("Name")
    assert "c_nationkey" in plan_of(wide)
    assert "c_comment" not in plan_of(wide)


def test_a_filter_on_the_key_reaches_the_scan(pages):
    plan = plan_of(op.item_tree(pages).where("doc_id = 7"))
    assert "PushedFilters: [IsNotNull(page_id), EqualTo(page_id,7)]" in plan


def test_a_document_is_scanned_once_for_its_items(pages):
    for frame in (op.list_items(pages), op.item_tree(pages), op.sections(pages)):
        assert plan_of(frame).count(HIDDEN) == 1
    counted = plan_of(plans.items_per_language(pages))
    assert counted.count(HIDDEN) == 1
    assert "charset" not in counted


def test_a_filter_on_a_result_does_not_repeat_the_work(forms):
    slots, wide = plans.document_slots(forms), op.wide_documents(forms, ["Name", "Nation"])
    for frame, condition in (
        (slots, "is_unfilled AND label LIKE '%a%' AND hint LIKE '%b%'"),
        (slots, "value = 'a' OR label = 'b'"),
        (wide, "Name = 'a' AND Nation = 'b'"),
    ):
        plan = plan_of(frame.where(condition))
        assert plan.count(HIDDEN) == plan.count(r"\G(?!\A)") == 1


def test_slots_are_generated_code_throughout(forms):
    lines = plan_of(plans.document_slots(forms)).splitlines()
    outside = [line for line in lines if re.match(r"[\s:+-]*(Project|Filter|Generate) ", line)]
    assert not outside


def test_registered_queries_do_not_deal_rows_out(spark):
    for name in QUERIES:
        if not name.startswith(("stream", "supplier", "manifest")):
            plan = plan_of(contract.queries()[name](spark, SF_DIR))
            assert "RoundRobin" not in plan
            assert plan.count("Exchange ") <= 1 and ("Exchange " not in plan or "partial_" in plan)


def test_shared_folder_is_the_one_named(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark), shared_folder(spark)
    assert first.startswith(named + "/") and first != second


def test_queries_read_whole_tables():
    for sql in contract.oracle_sql().values():
        assert not re.search(r"(?i)\blimit\b|%\s*\d|\bsample\b", sql)
