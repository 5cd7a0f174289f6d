"""Documents written as many small files, and streams of them."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from sheafwork import drop_folder, sources, streaming
from sheafwork.sources import documents

LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def texts(folder):
    return sorted(path.read_text() for path in Path(folder).glob("**/*.txt"))


def test_files_of_one_row_group_are_written_by_many_tasks(spark, tmp_path):
    rows = spark.range(900).select(
        F.col("id").alias("s_suppkey"), F.concat(F.lit("S"), "id").alias("s_name"), F.lit(-1.5).alias("s_acctbal")
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    folder = contract._supplier_files(spark, str(tmp_path))
    names = [path.name for path in Path(folder.removeprefix("file:")).glob("files/**/*.txt")]
    tasks = [name.split("-")[1] for name in names]
    assert len(names) == 900
    assert len(set(tasks)) == -(-900 // documents.FILES_PER_TASK)
    drop_folder(spark, folder)


@pytest.mark.parametrize("name", ["supplier_files", "stream_supplier_files", "packed_supplier_files"])
def test_queries_give_a_row_for_each_supplier(spark, tmp_path, name):
    rows = spark.range(600).select(
        F.col("id").alias("s_suppkey"), F.concat(F.lit("S"), "id").alias("s_name"), F.col("id").cast("double").alias("s_acctbal")
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "supplier.parquet"))
    found = contract.queries()[name](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, found)) == sorted((str(i), f"S{i}", f"{i}.00") for i in range(600))


def test_forms_of_one_key_share_a_file_by_the_task_they_come_from(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(documents, "FILES_PER_TASK", 2)
    forms = spark.createDataFrame([(1, "b"), (None, "d"), (1, "a"), (2, "c"), (None, "a")], "doc_id long, html string")
    sources.write_documents(forms.coalesce(1), str(tmp_path / "one"))
    assert texts(tmp_path / "one") == ["b\na\n", "c\n", "d\na\n"]
    parts = spark.sparkContext.parallelize([(2, "e"), (2, "d"), (2, "c")], 2)
    sources.write_documents(spark.createDataFrame(parts, "doc_id long, html string"), str(tmp_path / "two"))
    assert texts(tmp_path / "two") == ["d\nc\n", "e\n"]


def test_no_documents_make_no_file(spark, tmp_path):
    sources.write_documents(spark.createDataFrame([], "doc_id long, html string"), str(tmp_path / "none"))
    assert texts(tmp_path / "none") == []


def test_a_batch_lists_its_files_in_few_tasks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for number in range(100):
        (tmp_path / "in" / f"{number}.html").write_text(str(number))
    before = spark.conf.get(LISTING, None)
    files = sources.stream_documents(spark, str(tmp_path / "in"))
    with streaming.listing_by_core(spark):
        query = streaming.append_available(files, str(tmp_path / "out"), str(tmp_path / "progress"))
        query.awaitTermination()
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup(str(query.runId))]
    tasks = [tracker.getStageInfo(stage).numTasks for job in jobs for stage in job.stageIds]
    assert tasks and max(tasks) <= 4 * spark.sparkContext.defaultParallelism < 100
    assert spark.conf.get(LISTING, None) == before
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100
