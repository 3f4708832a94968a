"""Rows by position, attention by type and layer, and the metric stream."""

import pytest
from pyspark.sql import functions as F

from bitext.session import scratch_path
from bitext.sources import attention_store as ATS
from bitext.sources import row_store as RS
from bitext.sources import snapshots as SN
from bitext.streaming import metric_sink as MS


def files(spark, path):
    return spark.read.parquet(path).select(F.col("_metadata.file_path")).distinct().count()


def test_a_lookup_opens_the_files_that_hold_its_rows(spark):
    path = scratch_path(spark, "rows")
    rows = spark.range(5000).selectExpr("id AS rank", "id * 7 AS k").repartition(11, "k")
    RS.write_rows(rows, path, rows_per_file=100)
    index = spark.read.parquet(f"{path}/index").orderBy("first").collect()
    assert [(r["first"], r["last"], r["rows"]) for r in index] == [(i, i + 99, 100) for i in range(0, 5000, 100)]
    assert files(spark, f"{path}/rows") == 50
    batch = range(1200, 1300)  # a batch in rank order: one file of fifty
    assert len(RS.files_of(spark, path, batch)) == 1
    assert sorted(map(tuple, RS.read_rows(spark, path, batch).collect())) == [(i, i * 7) for i in batch]
    apart = [0, 99, 100, 4999, 4999, 77_777, -3]
    assert len(RS.files_of(spark, path, apart)) == 3
    assert sorted(map(tuple, RS.read_rows(spark, path, apart).collect())) == [(i, i * 7) for i in (0, 99, 100, 4999)]
    assert RS.read_rows(spark, path, []).collect() == [] and RS.read_rows(spark, path, [5000]).columns == ["rank", "k"]
    with pytest.raises(ValueError):
        RS.files_of(spark, path, range(RS.MAX_POSITIONS + 1))


def test_an_empty_store(spark):
    path = scratch_path(spark, "rows")
    RS.write_rows(spark.range(0).selectExpr("id AS rank", "id AS k"), path)
    assert RS.read_rows(spark, path, [0, 1]).collect() == []


def test_a_selection_reads_its_own_folder(spark):
    path = scratch_path(spark, "attention")
    cells = spark.range(2 * 4 * 3 * 3).selectExpr(
        "1 AS seq_id", "int(id div 36) AS layer", "int(id div 9 % 4) AS head", "int(id div 3 % 3) AS row", "int(id % 3) AS column", "id / 72 AS value")
    ATS.write_attention([cells.withColumn("type", F.lit(t)) for t in ("encoder", "decoder", "cross")], path)
    assert spark.read.parquet(path).count() == 3 * 72
    some = ATS.read_attention(spark, path, "decoder", layers=[1], heads=[0, 2])
    plan = some._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: [") : plan.index("PushedFilters")]
    assert "type" in filters and "layer" in filters and "In(head" in plan
    want = cells.where("layer = 1 AND head IN (0, 2)").withColumn("type", F.lit("decoder")).select(*ATS.COLUMNS)
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, want.collect()))
    done = ATS.read_attention(spark, path, "decoder", layers=[1], heads=[0, 2])
    done._jdf.collectToPython()
    scan = done._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().get("numPartitions").get().value() == 1  # one folder of six


METRICS = [("t", s, s // 20, float(s % 7)) for s in range(1, 101)]


def drop_files(spark, root, lo, hi):
    rows = spark.createDataFrame([m for m in METRICS if lo <= m[1] < hi], MS.METRIC_SCHEMA)
    rows.coalesce(1).write.mode("append").parquet(f"{root}/in")


def state(spark, root):
    losses = sorted((r["epoch"], round(r["loss"], 9), r["steps"]) for r in MS.epoch_losses(spark, root).collect())
    return losses, sorted(map(tuple, MS.logged(spark, root).collect()))


def expected(hi):
    rows = [m for m in METRICS if m[1] < hi]
    by = {e: [m[3] for m in rows if m[2] == e] for e in {m[2] for m in rows}}
    return sorted((e, round(sum(v) / len(v), 9), len(v)) for e, v in by.items()), sorted((t, s, v) for t, s, _, v in rows if s % 10 == 0)


def test_metric_stream_over_several_runs(spark):
    root = scratch_path(spark, "ms")
    drop_files(spark, root, 1, 30)
    drop_files(spark, root, 30, 55)
    MS.metric_stream(spark, f"{root}/in", root, every=10, files_per_trigger=1)
    assert state(spark, root) == expected(55)
    drop_files(spark, root, 55, 101)
    MS.metric_stream(spark, f"{root}/in", root, every=10)
    MS.metric_stream(spark, f"{root}/in", root, every=10)  # nothing new
    assert state(spark, root) == expected(101)
    assert len(SN.list_versions(spark, f"{root}/epochs")) == MS.KEEP_LAST


@pytest.mark.parametrize("after_pointer", [False, True])
def test_a_killed_batch_is_repeated_once(spark, monkeypatch, after_pointer):
    """Killed between the write and the pointer, or between the pointer and the stream's own commit."""
    root = scratch_path(spark, "ms")
    drop_files(spark, root, 1, 30)
    MS.metric_stream(spark, f"{root}/in", root, every=10)
    drop_files(spark, root, 30, 75)
    move = SN._point_to

    def killed(spark, folder, version):
        if after_pointer:
            move(spark, folder, version)
        raise RuntimeError("killed")

    monkeypatch.setattr(SN, "_point_to", killed)
    with pytest.raises(Exception, match="killed"):
        MS.metric_stream(spark, f"{root}/in", root, every=10)
    monkeypatch.setattr(SN, "_point_to", move)
    assert state(spark, root) == expected(75 if after_pointer else 30)
    drop_files(spark, root, 75, 101)
    MS.metric_stream(spark, f"{root}/in", root, every=10)
    assert state(spark, root) == expected(101)
