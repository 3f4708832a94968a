"""Loss bookkeeping: metric log, per-epoch and running losses, batch-mean loss,
corpus summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bitext.functions import text as T

LOG_EVERY = 50  # fixed value


def log_metrics(metrics: DataFrame, every: int = LOG_EVERY, path: str | None = None) -> DataFrame:
    """Rows whose step is a multiple of ``every``; appended to ``path`` when given."""
    out = metrics.where(F.col("step") % every == 0).select("tag", "step", "value")
    if path is not None:
        out.write.mode("append").parquet(path)
    return out


def epoch_loss(metrics: DataFrame) -> DataFrame:
    """Mean step loss per epoch (partial + final aggregate)."""
    return metrics.groupBy("epoch").agg(F.avg("value").alias("loss"), F.count(F.lit(1)).alias("steps"))


def running_loss(metrics: DataFrame, value_col: str = "value", exact: bool = False) -> DataFrame:
    """Running mean inside an epoch (window bounded by the steps of one epoch).

    ``exact``: ``value_col`` holds integer hundredths; the mean is the exact
    integer quotient rounded half-up to 6 places.
    """
    w = Window.partitionBy("epoch").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    if not exact:
        return metrics.select("step", "epoch", F.avg(value_col).over(w).alias("running_loss"))
    s, n = F.sum(value_col).over(w), F.count(F.lit(1)).over(w)
    e6 = F.floor((s * 20000 + n) / (2 * n)).cast("bigint")  # round(s / 100 / n, 6) * 1e6, half-up
    return metrics.select("step", "epoch", (e6 / F.lit(1e6)).alias("running_loss"))


def batch_loss_mean(losses: DataFrame, max_batches: int = 100, batch_col: str = "batch_id",
                    loss_col: str = "loss") -> DataFrame:
    """Mean of per-batch mean losses over the first ``max_batches`` batches; each
    batch weighs the same whatever its size (not token-weighted)."""
    per = losses.where(F.col(batch_col) < max_batches).groupBy(batch_col).agg(F.avg(loss_col).alias("bl"))
    return per.agg(F.avg("bl").alias("loss"), F.count(F.lit(1)).alias("batches"))


def corpus_stats(pairs: DataFrame, by: str = "split") -> DataFrame:
    """Sentence and word-length summaries per split, and token counts if ids are there."""
    sw, tw = T.word_count("src"), T.word_count("tgt")
    return pairs.groupBy(by).agg(
        F.count(F.lit(1)).alias("pairs"),
        F.sum(sw).cast("bigint").alias("src_words"),
        F.sum(tw).cast("bigint").alias("tgt_words"),
        F.max(sw).cast("int").alias("max_src_words"),
        F.max(tw).cast("int").alias("max_tgt_words"),
        F.avg(sw).alias("avg_src_words"),
        *[f(F.size(f"{s}_ids")).cast(t).alias(f"{n}{s}_tokens")
          for f, t, n in ((F.sum, "bigint", ""), (F.max, "int", "max_")) for s in ("src", "tgt")
          if f"{s}_ids" in pairs.columns],
    )
