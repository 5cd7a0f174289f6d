from sheafwork.llm import sieve


def test_all_wanted_rows_pass_and_few_others(spark):
    rows = spark.range(20_000).selectExpr("id", "cast(id as string) AS text").union(spark.sql("SELECT NULL, 'none'"))
    wanted = spark.range(0, 20_000, 100)
    found = {row.id for row in sieve.sifted(rows, "id", wanted).collect()}
    assert found >= set(range(0, 20_000, 100))
    assert None not in found and len(found) < 2_000


def test_no_ids_and_a_full_bitmap(spark, monkeypatch):
    rows = spark.range(100).selectExpr("id", "'x' AS text")
    assert sieve.sifted(rows, "id", spark.range(0)).count() == 0
    monkeypatch.setattr(sieve, "MOST_CELLS", 2)
    assert sieve.sifted(rows, "id", spark.range(90)).count() == 100
