"""Jobs over form documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafwork.operators.items import list_items
from sheafwork.operators.render import Form, Group, Section, Slot, render
from sheafwork.operators.sections import sections
from sheafwork.operators.slots import slots

CUSTOMER_FORM = Form(
    title="Customer record",
    sections=(
        Section(
            "Profile",
            (
                Slot("enter a name", "Name", "name"),
                Slot("enter a market segment", "Segment", "segment"),
            ),
        ),
        Section(
            "Accounts",
            (
                Group(
                    "Main account",
                    (
                        Slot("enter a balance", "Balance", "balance"),
                        Slot("enter a nation", "Nation", "nation"),
                    ),
                ),
                Slot("list other accounts", "Others"),
            ),
        ),
        Section("Remarks", (Slot("anything else"),), marker="optional"),
    ),
)

TEXT_FORM = Form(
    title="Text record",
    sections=(
        Section(
            "Origin",
            (Slot("language", "Language", "lang"), Slot("source", "Source", "source")),
        ),
        Section("Content", (Slot("whole text", "Text", "text"),)),
    ),
)


def customer_documents(customer: DataFrame) -> DataFrame:
    """A form per customer.

    Household customers leave the segment open, and a negative balance is not
    disclosed, so both kinds of slot occur.
    """
    balance = F.col("c_acctbal").cast("decimal(12,2)")
    rows = customer.select(
        "c_custkey",
        F.col("c_name").alias("name"),
        F.when(F.col("c_mktsegment") != "HOUSEHOLD", F.col("c_mktsegment")).alias("segment"),
        F.when(balance >= 0, balance).alias("balance"),
        F.col("c_nationkey").alias("nation"),
    )
    return render(rows, CUSTOMER_FORM, "c_custkey")


SUPPLIER_FORM = Form(
    title="Supplier record",
    sections=(
        Section("Supplier", (Slot("key", "Key", "s_suppkey"), Slot("name", "Name", "s_name"))),
        Section("State", (Slot("balance, if any", "Balance", "balance"),), marker="optional"),
    ),
)


def supplier_documents(supplier: DataFrame) -> DataFrame:
    """A form per supplier; a negative balance is not disclosed."""
    balance = F.col("s_acctbal").cast("decimal(12,2)")
    rows = supplier.select("s_suppkey", "s_name", F.when(balance >= 0, balance).alias("balance"))
    return render(rows, SUPPLIER_FORM, "s_suppkey")


ORDER_FORM = Form(
    title="Order record",
    sections=(
        Section(
            "Order",
            (
                Slot("customer", "Customer", "o_custkey"),
                Slot("status, once settled", "Status", "status"),
                Slot("priority", "Priority", "priority"),
            ),
        ),
    ),
)


def order_documents(orders: DataFrame) -> DataFrame:
    """(doc_id, ordered_at, html): a form per order with the time of the order.

    Open orders have no status yet, and a priority that is not specified is left open.
    """
    priority = F.col("o_orderpriority")
    rows = orders.select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderdate").cast("timestamp").alias("ordered_at"),
        F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("status"),
        F.when(~F.contains(priority, F.lit("NOT SPECIFIED")), priority).alias("priority"),
    )
    return render(rows, ORDER_FORM, "o_orderkey", "ordered_at")


def text_documents(documents: DataFrame) -> DataFrame:
    """A form per text, holding the whole of it."""
    return render(documents, TEXT_FORM, "doc_id")


def document_slots(documents: DataFrame, *keep: str) -> DataFrame:
    """Slots of whole documents, those before the first heading included.

    Columns named in ``keep`` are carried along.
    """
    bodies = sections(documents, *keep, preamble=True)
    return slots(list_items(bodies, *keep), *keep)
