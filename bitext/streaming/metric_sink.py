"""Metric log and epoch losses kept by a stream, exactly once.

Every micro-batch writes two folders named by its batch id, each overwritten if the
batch is run again: its sampled log rows, and a snapshot of the sums per epoch, which
is that of the batch before plus its own.  The snapshot's pointer moves last.  A run
killed at any point repeats the batch over the same base, so nothing is lost or
counted twice; readers take log folders up to the pointer only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitext.operators.metrics import LOG_EVERY, log_metrics
from bitext.sources import snapshots as SN

METRIC_SCHEMA = "tag string, step bigint, epoch bigint, value double"
KEEP_LAST = 2  # the newest snapshot and its base, which a repeated batch needs
LOG_SCHEMA = "tag string, step bigint, value double"


def write_batch(batch: DataFrame, batch_id: int, root: str, every: int = LOG_EVERY) -> None:
    """One micro-batch: log rows, sums per epoch, pointer, in this order."""
    spark = batch.sparkSession
    batch = batch.persist()
    try:
        log_metrics(batch, every).write.mode("overwrite").parquet(f"{root}/log/batch={batch_id}")
        sums = batch.groupBy("epoch").agg(F.sum("value").alias("total"), F.count("value").alias("steps"))
        base = [v for v in SN.list_versions(spark, f"{root}/epochs") if v < batch_id]
        if base:
            known = SN.read_snapshot(spark, f"{root}/epochs", base[-1])
            sums = known.unionByName(sums).groupBy("epoch").agg(F.sum("total").alias("total"), F.sum("steps").alias("steps"))
        SN.write_snapshot(sums, f"{root}/epochs", batch_id, keep_last=KEEP_LAST)
    finally:
        batch.unpersist()


def metric_stream(spark: SparkSession, in_dir: str, root: str, every: int = LOG_EVERY, files_per_trigger: int | None = None):
    """Take the metric files that have arrived in ``in_dir`` into ``root``, then stop."""
    reader = spark.readStream.schema(METRIC_SCHEMA)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    q = (reader.parquet(in_dir).writeStream.foreachBatch(lambda df, n: write_batch(df, n, root, every))
         .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def epoch_losses(spark: SparkSession, root: str) -> DataFrame:
    """``(epoch, loss, steps)`` of what the pointer names."""
    kept = SN.read_snapshot(spark, f"{root}/epochs")
    return kept.select("epoch", (F.col("total") / F.col("steps")).alias("loss"), "steps")


def logged(spark: SparkSession, root: str) -> DataFrame:
    """``(tag, step, value)`` of the batches up to the pointer."""
    last = SN.latest_version(spark, f"{root}/epochs")
    rows = spark.read.schema(f"{LOG_SCHEMA}, batch bigint").parquet(f"{root}/log")
    return rows.where(F.col("batch") <= F.lit(-1 if last is None else last)).drop("batch")
