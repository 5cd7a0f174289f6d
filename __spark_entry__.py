
from __future__ import annotations

import functools
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sheafwork import operators as op  # noqa: E402
from sheafwork import drop_folder, plans, shared_folder, sources, streaming  # noqa: E402
from sheafwork.sources.documents import PAGES_SCHEMA  # noqa: E402

try:
    import corpus_pipeline
    from sheafwork.llm import queries as llm_queries
except ImportError:
    corpus_pipeline = llm_queries = None

#: Files that a stream takes into one micro-batch.
FILES_PER_TRIGGER = 1_000
SUPPLIER_LABELS = ["Key", "Name", "Balance"]
FORM_LABELS = ["Name", "Segment", "Balance", "Nation"]
PAGES_PER_FILE = 1_000
#: Orders arrive by their time, give or take this much.
ORDER_DELAY = "90 days"
#: Small, so that the given suppliers fill several groups.
GROUP_BYTES = 64 << 10


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.documents_from_pages(_table(spark, sf_dir, "pages"))


def _forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.customer_documents(_table(spark, sf_dir, "customer"))


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    return plans.text_documents(documents)


def _run_stream(spark: SparkSession, rows: DataFrame, folder: str) -> DataFrame:
    with streaming.listing_by_core(spark):
        query = streaming.append_available(rows, f"{folder}/rows", f"{folder}/progress")
        query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(f"{folder}/rows")


def page_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.document_metadata(_pages(spark, sf_dir))


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.document_text(_pages(spark, sf_dir))


def page_list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.list_items(_pages(spark, sf_dir))


def page_item_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = op.item_tree(_pages(spark, sf_dir))
    return tree.select("doc_id", "item", "depth", "parent_item", "text")


def items_per_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.items_per_language(_pages(spark, sf_dir))


def _manifest_files(spark: SparkSession, sf_dir: str) -> str:
    folder = shared_folder(spark)
    rows = plans.page_manifest(_table(spark, sf_dir, "pages"))
    rows.write.options(**sources.WRITE_OPTIONS).csv(f"{folder}/files")
    return folder


def manifest_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the page addresses as manifest files, scan them, join the paths."""
    folder = _manifest_files(spark, sf_dir)
    return op.manifest_path(sources.scan_manifest(spark, f"{folder}/files", multi_line=True))


def stream_manifest_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`manifest_paths` with the files read as a stream."""
    folder = _manifest_files(spark, sf_dir)
    rows = sources.stream_manifest(spark, f"{folder}/files", FILES_PER_TRIGGER, multi_line=True)
    result = _run_stream(spark, op.manifest_path(rows), folder)
    drop_folder(spark, f"{folder}/files")
    return result


def stream_page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List items of the page table read as a file stream."""
    # As a pattern the path may name one file or a folder of them.
    reader = spark.readStream.schema(PAGES_SCHEMA).option("maxFilesPerTrigger", FILES_PER_TRIGGER)
    pages = reader.parquet(f"{sf_dir}/pages.parque[t]")
    items = op.list_items(sources.documents_from_pages(pages))
    rows = items.select("doc_id", "item", "text")
    return _run_stream(spark, rows, shared_folder(spark))


def _supplier_files(spark: SparkSession, sf_dir: str) -> str:
    """A file for each supplier's form."""
    folder = shared_folder(spark)
    forms = plans.supplier_documents(_table(spark, sf_dir, "supplier"))
    sources.write_documents(forms, f"{folder}/files")
    return folder


def supplier_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan HTML files, one a supplier, and read each into a row by what it says."""
    folder = _supplier_files(spark, sf_dir)
    files = sources.scan_documents(spark, f"{folder}/files")
    return op.wide_documents(files, SUPPLIER_LABELS).select(*SUPPLIER_LABELS)


def stream_supplier_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`supplier_files` with the files read as a stream."""
    folder = _supplier_files(spark, sf_dir)
    files = sources.stream_documents(
        spark, f"{folder}/files", max_files_per_trigger=FILES_PER_TRIGGER
    )
    rows = op.wide_documents(files, SUPPLIER_LABELS).select(*SUPPLIER_LABELS)
    result = _run_stream(spark, rows, folder)
    drop_folder(spark, f"{folder}/files")
    return result


def packed_supplier_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`supplier_files` with the small files packed into Parquet first."""
    folder = _supplier_files(spark, sf_dir)
    files = sources.pack_documents(spark, f"{folder}/files", f"{folder}/packed", GROUP_BYTES)
    drop_folder(spark, f"{folder}/files")
    return op.wide_documents(files, SUPPLIER_LABELS).select(*SUPPLIER_LABELS)


def manifest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write careless manifests of the page addresses, scan them once into good rows and rejects."""
    folder = shared_folder(spark)
    files = plans.careless_manifests(_table(spark, sf_dir, "pages"), PAGES_PER_FILE)
    files.write.partitionBy("part").text(f"{folder}/files")
    rows = sources.scan_manifest_checked(spark, f"{folder}/files")
    good, rejects = sources.store_checked(rows, f"{folder}/rows")
    drop_folder(spark, f"{folder}/files")
    none = F.lit(None).cast("string")
    part = F.regexp_extract("file", "/part=([0-9]+)/", 1).cast("int")
    return good.select("*", none.cast("int").alias("part"), none.alias("row"), none.cast("int").alias("fields")).union(
        rejects.select(none, none, none, part, "row", "fields")
    )


def stream_order_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Completeness by label and day of order over a stream whose state expires."""
    orders = _table(spark, sf_dir, "orders")
    reader = spark.readStream.schema(orders.schema).option("maxFilesPerTrigger", FILES_PER_TRIGGER)
    forms = plans.order_documents(reader.parquet(f"{sf_dir}/orders.parque[t]"))
    slots = plans.document_slots(forms, "ordered_at")
    counts = op.completeness_windows(slots, "label", time="ordered_at", width="1 day", delay=ORDER_DELAY)
    folder = shared_folder(spark)
    streaming.upsert_available(counts, f"{folder}/rows", f"{folder}/progress").awaitTermination()
    stored = streaming.stored(spark, f"{folder}/rows", counts.schema)
    return streaming.latest(stored, "window_start", "label")


def stream_wide_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`form_wide_record` over a stream that brings each document's slots in two batches.

    The second batch is stored twice, as after a driver that was lost before it could say so.
    """
    folder = shared_folder(spark)
    slots = plans.document_slots(_forms(spark, sf_dir)).select("doc_id", "pos", "item", "label", "value")
    stream = spark.readStream.schema(slots.schema).parquet(f"{folder}/slots/*")

    def parts(rows: DataFrame) -> DataFrame:
        return op.wide_parts(rows, FORM_LABELS)

    for name, which in ("first", "pos > 1"), ("second", "pos <= 1"):
        slots.where(which).write.parquet(f"{folder}/slots/{name}")
        query = streaming.upsert_available(stream, f"{folder}/rows", f"{folder}/progress", parts, "append")
        query.awaitTermination()
    streaming.store(parts(spark.read.schema(slots.schema).parquet(f"{folder}/slots/second")), f"{folder}/rows", 1)
    stored = streaming.stored(spark, f"{folder}/rows", parts(slots).schema)
    return op.wide_of_parts(stored, FORM_LABELS)


def form_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _forms(spark, sf_dir)


def form_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.parse_heading(op.sections(_forms(spark, sf_dir)))


def form_item_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = op.item_tree(op.sections(_forms(spark, sf_dir)))
    return tree.select("doc_id", "pos", "item", "depth", "parent_item", "text")


def form_label_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.document_slots(_forms(spark, sf_dir))


def form_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels and values before unfilled slots are told apart."""
    items = op.list_items(op.sections(_forms(spark, sf_dir)))
    return op.label_values(items).select("doc_id", "pos", "item", "text", "label", "value")


def form_unfilled(spark: SparkSession, sf_dir: str) -> DataFrame:
    slots = plans.document_slots(_forms(spark, sf_dir))
    return slots.where("is_unfilled").select("doc_id", "pos", "item", "label", "hint")


def form_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.completeness(plans.document_slots(_forms(spark, sf_dir)), "pos", "label")


def form_document_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.completeness_documents(_forms(spark, sf_dir))


def form_wide_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.wide(plans.document_slots(_forms(spark, sf_dir)), FORM_LABELS)


def form_wide_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.wide_documents(_forms(spark, sf_dir), FORM_LABELS)


def form_label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The maps of labels that are not known in advance, as rows."""
    maps = op.label_map(_forms(spark, sf_dir))
    return maps.select("doc_id", F.explode("slots").alias("label", "value"))


def text_form_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts rendered into a form."""
    return _texts(spark, sf_dir)


def text_label_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts through a form and back."""
    return plans.document_slots(_texts(spark, sf_dir)).select("doc_id", "label", "value")


def entry(spark: SparkSession) -> DataFrame:
    """List items per page language on /root/testdata/sf0.001."""
    return items_per_language(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        query.__name__: query
        for query in (
            page_metadata,
            page_text,
            page_list_items,
            page_item_tree,
            items_per_language,
            manifest_paths,
            stream_manifest_paths,
            stream_page_items,
            supplier_files,
            stream_supplier_files,
            packed_supplier_files,
            manifest_rejects,
            stream_order_completeness,
            stream_wide_record,
            form_html,
            form_sections,
            form_item_tree,
            form_labels,
            form_unfilled,
            form_label_values,
            form_completeness,
            form_document_completeness,
            form_wide_record,
            form_wide_documents,
            form_label_map,
            text_form_html,
            text_label_values,
        )
    } | _llm_queries()


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm_queries is None:
        return {}
    named = llm_queries.QUERIES | {"pipeline": corpus_pipeline.run}
    return {name: _importable(query) for name, query in named.items()}


def _importable(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query with this folder on the path of Python tasks, wherever it is called from."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root = os.path.dirname(os.path.abspath(__file__))
        spark.sparkContext.environment.setdefault("PYTHONPATH", root)
        return query(spark, sf_dir)

    return run


def _llm_sql() -> dict[str, str]:
    if llm_queries is None:
        return {}
    pipeline = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return llm_queries.ORACLE_SQL | pipeline


# Pages. The SQL spells its patterns out so that it does not depend on the library.

_HIDDEN = (
    r"'(?is)<script(?:\s[^>]*)?>.*?(?:</script\s*>|\z)"
    r"|<style(?:\s[^>]*)?>.*?(?:</style\s*>|\z)|<!-->|<!--->|<!--.*?(?:-->|--!>|\z)'"
)
_TEXT_OF = (
    r"trim(regexp_replace(regexp_replace({}, '<[a-zA-Z/!?][^>]*(?:>|\z)', ' ', 'g'),"
    r" '[ \t\r\n\f]+', ' ', 'g'))"
)

_PARTS = rf"""
parts AS (
  SELECT page_id AS doc_id, string_split_regex(
    regexp_replace(regexp_replace(html, '<[a-zA-Z/!?][^>]*\z', ''), {_HIDDEN}, ' ', 'g'),
    '(?i)<li(?:\s[^>]*)?>') AS part
  FROM pages),
fragments AS (
  SELECT doc_id, unnest(generate_series(0, len(part) - 1)) AS item, unnest(part) AS fragment
  FROM parts),
items AS (
  SELECT *, string_split_regex(fragment, '(?i)</li\s*>|<h2(?:\s[^>]*)?>')[1] AS content FROM fragments)
"""

_PAGE_ITEMS = f"WITH {_PARTS} SELECT {{columns}} FROM items WHERE item > 0"

# Forms. Every section's markup is written out once for a customer.

_FORMS = r"""
c AS (
  SELECT c_custkey AS doc_id, c_name AS name,
    CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_mktsegment END AS segment,
    CASE WHEN c_acctbal >= 0 THEN CAST(CAST(c_acctbal AS DECIMAL(12, 2)) AS VARCHAR) END AS balance,
    CAST(c_nationkey AS VARCHAR) AS nation
  FROM customer)
"""


def _hint(text: str) -> str:
    return f'<span class="placeholder">[{text}]</span>'


_NL = "' || chr(10) || '"
_BODY_1 = (
    f"""'{_NL}<div>{_NL}<ul>{_NL}"""
    f"""<li><span class="highlight">Name:</span> ' || coalesce(name, '{_hint("enter a name")}') || '</li>{_NL}"""
    f"""<li><span class="highlight">Segment:</span> ' || coalesce(segment, '{_hint("enter a market segment")}')"""
    f""" || '</li>{_NL}</ul>{_NL}</div>{_NL}'"""
)
_BODY_2 = (
    f"""'{_NL}<div>{_NL}<ul>{_NL}"""
    f"""<li><span class="highlight">[Main account]</span>{_NL}<ul>{_NL}"""
    f"""<li>Balance: ' || coalesce(balance, '{_hint("enter a balance")}') || '</li>{_NL}"""
    f"""<li>Nation: ' || coalesce(nation, '{_hint("enter a nation")}') || '</li>{_NL}</ul>{_NL}</li>{_NL}"""
    f"""<li><span class="highlight">Others:</span> {_hint("list other accounts")}</li>{_NL}</ul>{_NL}</div>{_NL}'"""
)
_BODY_3 = (
    f"""'{_NL}<div>{_NL}<ul>{_NL}"""
    f"""<li>{_hint("anything else")}</li>{_NL}</ul>{_NL}</div>{_NL}</body>{_NL}</html>{_NL}'"""
)
_HEAD_OF = (
    f"""'<!DOCTYPE html>{_NL}<html lang="en">{_NL}<head>{_NL}<meta charset="UTF-8">{_NL}"""
    f"""<title>TITLE</title>{_NL}</head>{_NL}<body>{_NL}<h1>TITLE</h1>{_NL}'"""
)
_HEAD = _HEAD_OF.replace("TITLE", "Customer record")
_HEADINGS = ["1. Profile", "2. Accounts", "3. Remarks (optional)"]



def _escaped(column: str, hint: str) -> str:
    text = column
    for char, entity in ("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("[", "&#91;"), ("]", "&#93;"):
        text = f"replace({text}, '{char}', '{entity}')"
    blank = rf"coalesce(regexp_matches({column}, '^[ \t\r\n\f]*\z'), true)"
    return f"CASE WHEN {blank} THEN '{_hint(hint)}' ELSE {text} END"


_TEXT_HTML = (
    "SELECT doc_id, "
    + _HEAD_OF.replace("TITLE", "Text record")
    + f""" || '<h2>1. Origin</h2>{_NL}<div>{_NL}<ul>{_NL}"""
    + f"""<li><span class="highlight">Language:</span> ' || {_escaped("lang", "language")} || '</li>{_NL}"""
    + f"""<li><span class="highlight">Source:</span> ' || {_escaped("source", "source")} || '</li>{_NL}"""
    + f"""</ul>{_NL}</div>{_NL}<h2>2. Content</h2>{_NL}<div>{_NL}<ul>{_NL}"""
    + f"""<li><span class="highlight">Text:</span> ' || {_escaped("text", "whole text")} || '</li>{_NL}"""
    + f"""</ul>{_NL}</div>{_NL}</body>{_NL}</html>{_NL}' AS html FROM documents"""
)

_SLOTS = r"""
slots AS (
  SELECT doc_id, 1 AS pos, 1 AS item, 1 AS depth, NULL::INTEGER AS parent_item,
    'Name' AS label, name AS value, 'enter a name' AS ask, 'Name: ' AS before FROM c
  UNION ALL SELECT doc_id, 1, 2, 1, NULL, 'Segment', segment, 'enter a market segment', 'Segment: ' FROM c
  UNION ALL SELECT doc_id, 2, 1, 1, NULL, NULL, NULL, 'Main account', '' FROM c
  UNION ALL SELECT doc_id, 2, 2, 2, 1, 'Balance', balance, 'enter a balance', 'Balance: ' FROM c
  UNION ALL SELECT doc_id, 2, 3, 2, 1, 'Nation', nation, 'enter a nation', 'Nation: ' FROM c
  UNION ALL SELECT doc_id, 2, 4, 1, NULL, 'Others', NULL, 'list other accounts', 'Others: ' FROM c
  UNION ALL SELECT doc_id, 3, 1, 1, NULL, NULL, NULL, 'anything else', '' FROM c)
"""

_WIDE = f"""WITH {_FORMS}
SELECT doc_id, name AS "Name", segment AS "Segment", balance AS "Balance", nation AS "Nation" FROM c"""


def oracle_sql() -> dict[str, str]:
    manifest = r"""
SELECT CAST(page_id AS VARCHAR) AS mid,
  CASE WHEN url LIKE '%/%' THEN url[: length(url) - strpos(reverse(url), '/') + 1] END AS base_directory,
  nullif(split_part(url, '/', -1), '') AS file_name,
  CASE WHEN url LIKE '%/%' AND url NOT LIKE '%/' THEN url END AS path
FROM pages"""
    supplier = """
SELECT CAST(s_suppkey AS VARCHAR) AS "Key", s_name AS "Name",
  CASE WHEN s_acctbal >= 0 THEN CAST(CAST(s_acctbal AS DECIMAL(12, 2)) AS VARCHAR) END AS "Balance"
FROM supplier"""
    section = """SELECT doc_id, {pos} AS pos, '{heading}' AS heading, {body} AS body,
      {pos} AS no, '{title}' AS title, {marker} AS marker FROM c"""
    return {
        # Read from the markup without its hidden parts, field by field with plain cuts.
        "page_metadata": rf"""
WITH seen AS (
  SELECT page_id AS doc_id, regexp_replace(html, {_HIDDEN}, ' ', 'g') AS html FROM pages),
tags AS (
  SELECT *, regexp_extract(html, '(?i)<html\s[^<>]*lang[^<>]*>') AS tag,
    regexp_extract(html, '(?i)<meta\s[^<>]*charset[^<>]*>') AS meta FROM seen)
SELECT doc_id, nullif(regexp_extract(tag, '(?i)\slang=["'']?([^"''<>\s]+)', 1), '') AS lang,
  nullif(regexp_extract(meta, '(?i)[\s;]charset=["'']?([^"''<>;\s]+)', 1), '') AS charset,
  """
        + ", ".join(
            "nullif({}, '') AS {}".format(
                _TEXT_OF.format(
                    rf"regexp_extract(html, '(?is)<{tag}(?:\s[^<>]*)?>(.*?)</{tag}\s*>', 1)"
                ),
                tag,
            )
            for tag in ("title", "h1")
        )
        + " FROM tags",
        "page_text": rf"""
SELECT page_id AS doc_id, trim(regexp_replace(regexp_replace(html,
  {_HIDDEN[:-1]}|<[a-z/!?][^>]*(?:>|\z)', ' ', 'g'), '[ \t\r\n\f]+', ' ', 'g')) AS text
FROM pages""",
        "page_list_items": _PAGE_ITEMS.format(
            columns="doc_id, 0 AS pos, CAST(item AS INTEGER) AS item, fragment, content, "
            + _TEXT_OF.format("content")
            + " AS text"
        ),
        "page_item_tree": f"""WITH {_PARTS},
nets AS (
  SELECT *, len(regexp_extract_all(fragment, '(?i)<[ou]l[\\s>]')) - len(regexp_extract_all(fragment, '(?i)</[ou]l[\\s>]')) AS net
  FROM items),
depths AS (
  SELECT *, sum(net) OVER (PARTITION BY doc_id ORDER BY item ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS depth
  FROM nets),
parents AS (
  SELECT *, CASE WHEN depth = 2 THEN last_value(CASE WHEN depth = 1 THEN item END IGNORE NULLS) OVER (
    PARTITION BY doc_id ORDER BY item ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) END AS parent_item
  FROM depths)
SELECT doc_id, CAST(item AS INTEGER) AS item, CAST(depth AS INTEGER) AS depth,
  CAST(parent_item AS INTEGER) AS parent_item, {_TEXT_OF.format("content")} AS text
FROM parents WHERE item > 0""",
        "items_per_language": f"""WITH {_PARTS}
SELECT nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang, count(*) AS items
FROM items JOIN pages ON page_id = doc_id WHERE item > 0 GROUP BY 1""",
        "manifest_paths": manifest,
        "stream_manifest_paths": manifest,
        "supplier_files": supplier,
        "stream_supplier_files": supplier,
        "packed_supplier_files": supplier,
        "manifest_rejects": r"""
WITH named AS (
  SELECT page_id, CAST(page_id AS VARCHAR) AS mid, url, split_part(url, '/', -1) AS name,
    left(url, CAST(length(url) - length(split_part(url, '/', -1)) AS INTEGER)) AS base
  FROM pages WHERE url IS NOT NULL),
marked AS (
  SELECT *, url LIKE '%#%' AS short, url LIKE '%?%' AND url NOT LIKE '%#%' AS long FROM named)
SELECT CASE WHEN NOT short AND NOT long THEN mid END AS mid,
  CASE WHEN NOT short AND NOT long THEN nullif(base, '') END AS base_directory,
  CASE WHEN NOT short AND NOT long THEN nullif(name, '') END AS file_name,
  CASE WHEN short OR long THEN CAST(page_id // 1000 AS INTEGER) END AS part,
  CASE WHEN short THEN mid || ',' || url WHEN long THEN replace(mid || ',' || base || ',' || name, '?', ',') END AS row,
  CASE WHEN short THEN 2 WHEN long THEN 4 END AS fields
FROM marked""",
        "stream_order_completeness": r"""
WITH slots AS (
  SELECT o_orderdate, 'Customer' AS label, CAST(o_custkey AS VARCHAR) AS value FROM orders
  UNION ALL SELECT o_orderdate, 'Status', CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END FROM orders
  UNION ALL SELECT o_orderdate, 'Priority', CASE WHEN o_orderpriority NOT LIKE '%NOT SPECIFIED%' THEN o_orderpriority END
    FROM orders)
SELECT date_trunc('day', o_orderdate)::TIMESTAMP AS window_start, label, count(*) AS slots, count(value) AS filled,
  count(value) / count(*) AS ratio
FROM slots WHERE o_orderdate IS NOT NULL GROUP BY ALL""",
        "stream_wide_record": _WIDE,
        "form_label_map": f"""WITH {_FORMS}, {_SLOTS}
SELECT doc_id, label, value FROM slots WHERE label IS NOT NULL AND value IS NOT NULL""",
        "stream_page_items": _PAGE_ITEMS.format(
            columns="doc_id, CAST(item AS INTEGER) AS item, " + _TEXT_OF.format("content") + " AS text"
        ),
        "form_html": f"WITH {_FORMS} SELECT doc_id, "
        + _HEAD
        + "".join(
            f" || '<h2>{heading}</h2>' || {body}"
            for heading, body in zip(_HEADINGS, (_BODY_1, _BODY_2, _BODY_3))
        )
        + " AS html FROM c",
        "form_sections": f"WITH {_FORMS} "
        + " UNION ALL ".join(
            section.format(pos=pos, heading=_HEADINGS[pos - 1], body=body, title=title, marker=marker)
            for pos, title, marker, body in (
                (1, "Profile", "NULL", _BODY_1),
                (2, "Accounts", "NULL", _BODY_2),
                (3, "Remarks", "'optional'", _BODY_3),
            )
        ),
        "form_item_tree": f"""WITH {_FORMS}, {_SLOTS}
SELECT doc_id, pos, item, depth, parent_item, before || coalesce(value, '[' || ask || ']') AS text FROM slots""",
        "form_labels": f"""WITH {_FORMS}, {_SLOTS}
SELECT doc_id, pos, item, before || coalesce(value, '[' || ask || ']') AS text, label,
  CASE WHEN pos = 2 AND item = 1 THEN '[' || ask || ']' ELSE value END AS value FROM slots""",
        "form_unfilled": f"""WITH {_FORMS}, {_SLOTS}
SELECT doc_id, pos, item, label, ask AS hint FROM slots WHERE value IS NULL""",
        "form_label_values": f"""WITH {_FORMS}, {_SLOTS}
SELECT doc_id, pos, item, label, value, CASE WHEN value IS NULL THEN ask END AS hint,
  value IS NULL AS is_unfilled FROM slots""",
        "form_completeness": f"""WITH {_FORMS}, {_SLOTS}
SELECT pos, label, count(*) AS slots, count(value) AS filled, count(value) / count(*) AS ratio
FROM slots GROUP BY pos, label""",
        "form_document_completeness": f"""WITH {_FORMS}, {_SLOTS}
SELECT doc_id, count(*) AS slots, count(value) AS filled, count(value) / count(*) AS ratio
FROM slots GROUP BY doc_id""",
        "form_wide_record": _WIDE,
        "form_wide_documents": _WIDE,
        "text_form_html": _TEXT_HTML,
        "text_label_values": r"""
WITH s AS (
  SELECT doc_id, 'Language' AS label, lang AS value FROM documents
  UNION ALL SELECT doc_id, 'Source', source FROM documents
  UNION ALL SELECT doc_id, 'Text', text FROM documents)
SELECT doc_id, label, nullif(trim(regexp_replace(value, '[ \t\r\n\f]+', ' ', 'g')), '') AS value FROM s""",
    } | _llm_sql()
