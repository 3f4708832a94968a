"""Shared steps: tasks of bounded size, no second evaluation."""

from pyspark.sql import functions as F

from bitext.operators import ranking as R
from bitext.sources import tables as TB


def test_large_tables_are_dealt_to_tasks_of_bounded_size(spark, monkeypatch):
    df = spark.range(0, 30_000, 1, 2)  # 240,000 bytes
    monkeypatch.setattr(TB, "SPREAD_BYTES", 1000)
    assert TB.spread(df).rdd.getNumPartitions() == 240
    monkeypatch.setattr(TB, "SPREAD_BYTES", 1 << 30)
    assert TB.spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_rank_by_hash_evaluates_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def costly(x):
        seen.add(1)
        return x

    df = spark.range(2000).select("id", costly.asNondeterministic()("id").alias("v"))
    ranked = R.hash_rank(df, "id", 42).collect()
    assert seen.value == 2000
    key = R.hash_key(42, "id")
    want = [r["id"] for r in spark.range(2000).orderBy(key, "id").collect()]
    assert [r["id"] for r in sorted(ranked, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in ranked) == list(range(2000))
