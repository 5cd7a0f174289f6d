"""Keys that hold a third of all rows."""

from pyspark.sql import functions as F

from sheafwork import operators as op
from sheafwork import plans, shuffle_partitions

ROWS = 60_000


def pairs(spark):
    """Two thirds of the rows spread over documents, one third in one of them."""
    hot = F.col("id") % 3 == 0
    return spark.range(ROWS).select(
        F.when(hot, -1).otherwise(F.col("id")).alias("doc_id"),
        F.col("id").cast("int").alias("pos"),
        F.lit(1).alias("item"),
        F.when(F.col("id") % 2 == 0, "A").otherwise("B").alias("label"),
        F.when(F.col("id") >= 100, F.col("id").cast("string")).alias("value"),
    )


def test_wide_with_a_hot_document(spark):
    rows = {row["doc_id"]: tuple(row)[1:] for row in op.wide(pairs(spark), "AB").collect()}
    assert rows.pop(-1) == ("102", "105")
    expected = {
        i: ((None, None) if i < 100 else (str(i), None) if i % 2 == 0 else (None, str(i)))
        for i in range(ROWS)
        if i % 3
    }
    assert rows == expected


def test_a_hot_key_is_one_row_per_task_after_the_partial_step(spark):
    frame = op.completeness(pairs(spark).repartition(8), "label")
    assert frame.orderBy("label").collect() == [
        ("A", ROWS // 2, ROWS // 2 - 50, (ROWS // 2 - 50) / (ROWS // 2)),
        ("B", ROWS // 2, ROWS // 2 - 50, (ROWS // 2 - 50) / (ROWS // 2)),
    ]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    final, partial = plan.split("Exchange hashpartitioning(label")
    assert "functions=[partial_count(1)" in partial


def test_copies_of_a_document_keep_apart(spark):
    """Copies that share a key do not mix, since nothing is grouped by it."""
    html = "<ul><li>a<ul><li>b</li></ul></li></ul>"
    copies = spark.range(3000).select(F.lit(7).alias("doc_id"), F.lit(html).alias("html"))
    tree = op.item_tree(copies).groupBy("item", "depth", "parent_item").count()
    assert {tuple(row) for row in tree.collect()} == {(1, 1, None, 3000), (2, 2, 1, 3000)}


def test_hot_language(spark):
    pages = spark.range(9000).select(
        F.col("id").alias("doc_id"),
        F.concat(
            F.lit("<html lang='"),
            F.when(F.col("id") % 3 == 0, "aa").otherwise(F.col("id").cast("string")),
            F.lit("'><ul><li>x<li>y</ul>"),
        ).alias("html"),
    )
    counts = {row["lang"]: row["items"] for row in plans.items_per_language(pages).collect()}
    assert counts.pop("aa") == 6000
    assert len(counts) == 6000 and set(counts.values()) == {2}


def test_one_long_document_among_short_ones(spark):
    long_list = "<ul>" + "<li>x</li>" * 30_000 + "</ul>"
    pages = spark.range(10_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") == 5, long_list).otherwise("<ul><li>x</ul>").alias("html"),
    )
    counts = op.item_tree(pages).groupBy("doc_id", "depth").count()
    assert counts.where("count <> 1").collect() == [(5, 1, 30_000)]
    assert counts.count() == 10_000


def test_shuffle_partitions_follow_the_input():
    assert shuffle_partitions(0) == 200
    assert shuffle_partitions(1 << 40) == 4096
    assert shuffle_partitions(100 * 10**12) == 372_530
