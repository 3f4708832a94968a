"""Attention analysis over the long table ``(seq_id, type, layer, head, row, column, value)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Label format and the placeholder for a missing token.
LABEL_FORMAT = "%03d %s"
BLANK = "<blank>"


def attention_long(attn: DataFrame, tokens: DataFrame, n: int = 20, key: str = "seq_id") -> DataFrame:
    """Rows/columns below ``n`` with labels ``"%03d token"``; missing tokens read
    ``<blank>``.  ``tokens`` is ``(key, pos, token)``; joined twice on (key, position)."""
    a = attn.where((F.col("row") < n) & (F.col("column") < n))
    rt = tokens.select(key, F.col("pos").alias("row"), F.col("token").alias("_rt"))
    ct = tokens.select(key, F.col("pos").alias("column"), F.col("token").alias("_ct"))
    j = a.join(rt, [key, "row"], "left").join(ct, [key, "column"], "left")
    return j.withColumn("row_token", F.format_string(LABEL_FORMAT, F.col("row"), F.coalesce("_rt", F.lit(BLANK)))) \
        .withColumn("col_token", F.format_string(LABEL_FORMAT, F.col("column"), F.coalesce("_ct", F.lit(BLANK)))) \
        .drop("_rt", "_ct")


def attention_select(attn: DataFrame, typ: str, layers=None, heads=None) -> DataFrame:
    """Choose a type, layers and heads (prunes partitions when stored by type/layer)."""
    out = attn.where(F.col("type") == typ)
    if layers is not None:
        out = out.where(F.col("layer").isin(list(layers)))
    if heads is not None:
        out = out.where(F.col("head").isin(list(heads)))
    return out


def attention_entropy(attn: DataFrame, key: str = "seq_id") -> DataFrame:
    """Mean over rows of ``-sum p ln p`` per head, then mean over heads per layer."""
    rows = attn.groupBy(key, "type", "layer", "head", "row").agg(
        F.sum(F.when(F.col("value") > 0, -F.col("value") * F.log("value")).otherwise(0.0)).alias("h")
    )
    heads = rows.groupBy("type", "layer", "head").agg(F.avg("h").alias("h"))
    return heads.groupBy("type", "layer").agg(F.avg("h").alias("entropy"), F.count(F.lit(1)).alias("heads"))


def attention_sink(attn: DataFrame, key: str = "seq_id") -> DataFrame:
    """Mean peak weight per head and the share of rows whose peak is column 0."""
    # the first column holds the peak if nothing exceeds it: plain maxima need no sorted cells
    peak = attn.groupBy(key, "type", "layer", "head", "row").agg(
        F.max("value").alias("peak"), F.max(F.when(F.col("column") == 0, F.col("value"))).alias("first"),
    )
    sink = F.coalesce(F.col("first") >= F.col("peak"), F.lit(False)).cast("double")
    return peak.groupBy("type", "layer", "head").agg(F.avg("peak").alias("mean_peak"), F.avg(sink).alias("sink_share"))


def attention_align(attn: DataFrame, key: str = "seq_id") -> DataFrame:
    """Best source column per target row (ties to the smaller column)."""
    return attn.groupBy(key, "type", "layer", "head", "row").agg(
        F.max_by(F.col("column"), F.struct(F.col("value"), -F.col("column"))).alias("best_column")
    )


def attention_valid(attn: DataFrame, lens: DataFrame, key: str = "seq_id") -> DataFrame:
    """Keep columns below the sequence's valid (non-pad) length."""
    return attn.join(lens, key).where(F.col("column") < F.col("valid_len")).drop("valid_len")
