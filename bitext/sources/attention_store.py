"""Attention weights stored by type and layer, so that a selection opens its folders only."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitext.operators.attention_stats import attention_select

COLUMNS = ["seq_id", "type", "layer", "head", "row", "column", "value"]


def write_attention(parts: Iterable[DataFrame], path: str) -> None:
    """Append long weight tables below ``path/type=…/layer=…``, rows of a file sorted by head.

    Each part (one model stack or layer) is a job of its own; the head order makes
    Parquet's row-group bounds tell heads apart within a file.
    """
    for part in parts:
        part.select(*COLUMNS).sortWithinPartitions("type", "layer", "head").write.partitionBy("type", "layer").mode("append").parquet(path)


def read_attention(spark: SparkSession, path: str, typ: str, layers=None, heads=None) -> DataFrame:
    """Weights of one type, of some layers and heads: type and layer prune folders,
    heads are pushed to the scan."""
    stored = spark.read.parquet(path).withColumn("layer", F.col("layer").cast("int"))
    return attention_select(stored, typ, layers, heads).select(*COLUMNS)
