"""Scaled dot-product attention over a long vector table.

Input rows are ``(seq_id, pos, vec)``.  Vectors are split into heads, queries are
joined with keys/values of the SAME sequence (equi-join on ``seq_id, head``, the
mask as a residual predicate), softmax is a window over one query row, and the
output is a weighted sum over the (bounded) keys of that row.  The join is the
only shuffle: the window and the final aggregation are clustered on keys the
join partitioning already satisfies.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bitext.functions import vectors as V
from bitext.sources.tables import parts_of

CELL_TASK_BYTES = 1 << 20  # estimated bytes of the query vectors of one task


def heads_long(df: DataFrame, vec: str, h: int, key: str = "seq_id", pos: str = "pos", name: str = "x") -> DataFrame:
    """``(key, head, pos, name)``: one row per head slice."""
    return df.select(key, F.col(pos).alias(pos), F.posexplode(V.split_heads(vec, h)).alias("head", name)).select(
        key, F.col("head").cast("int").alias("head"), pos, name
    )


def scores(q: DataFrame, kv: DataFrame, mask: str = "none", key: str = "seq_id", dk: int = 8,
           valid: DataFrame | None = None) -> DataFrame:
    """``(key, head, row, column, score, v)`` for the allowed (row, column) cells.

    ``mask``: 'none' (self), 'causal' (column <= row) or 'valid' (column < valid_len,
    with ``valid`` = ``(key, valid_len)``).
    """
    # rows are few bytes and cells many: tasks by the size of the queries, not as many as other shuffles
    parts = max(int(q.sparkSession.conf.get("spark.sql.shuffle.partitions")), parts_of(q, CELL_TASK_BYTES))
    qq = q.select(key, "head", F.col("pos").alias("row"), F.col("x").alias("q")).repartition(parts, key, "head")
    kk = kv.select(key, "head", F.col("pos").alias("column"), F.col("x").alias("k"), F.col("v")).repartition(parts, key, "head")
    j = qq.join(kk, [key, "head"])
    if mask == "causal":
        j = j.where(F.col("column") <= F.col("row"))
    elif mask == "valid":
        j = j.join(valid, key).where(F.col("column") < F.col("valid_len")).drop("valid_len")
    return j.select(key, "head", "row", "column", (V.dot("q", "k") / F.lit(math.sqrt(dk))).alias("score"), "v")


def softmax_rows(s: DataFrame, key: str = "seq_id") -> DataFrame:
    """Softmax of ``score`` over the cells of one query row (max-shifted)."""
    w = Window.partitionBy(key, "head", "row")
    e = s.withColumn("_e", F.exp(F.col("score") - F.max("score").over(w)))
    return e.withColumn("weight", F.col("_e") / F.sum("_e").over(w)).drop("_e")


def weighted_values(wts: DataFrame, key: str = "seq_id", dk: int = 8) -> DataFrame:
    """``(key, head, row, out)``: sum of ``weight * v`` over the row's columns.

    A query row has at most seq_len columns, so the collected list is bounded.
    """
    g = wts.groupBy(key, "head", "row").agg(
        F.array_sort(F.collect_list(F.struct("column", "weight", "v"))).alias("_c")
    )
    zero = F.array_repeat(F.lit(0.0), dk)
    out = F.aggregate(
        "_c", zero, lambda acc, x: F.zip_with(acc, x["v"], lambda a, b: a + x["weight"] * b)
    )
    return g.select(key, "head", "row", out.alias("out"))


def attention(df: DataFrame, vec: str = "vec", h: int = 8, mask: str = "none", key: str = "seq_id",
              kv_df: DataFrame | None = None, kv_vec: str | None = None, valid: DataFrame | None = None,
              dk: int | None = None):
    """Multi-head attention with Q = K = V from ``vec`` (or K = V from ``kv_df``).

    Returns ``(weights, outputs)``: the long weight table and per-row outputs
    with heads concatenated back (``flatten`` of the head outputs in order).
    """
    q = heads_long(df, vec, h, key)
    src = kv_df if kv_df is not None else df
    kv = heads_long(src, kv_vec or vec, h, key).withColumn("v", F.col("x"))
    if dk is None:
        probe = q.select(F.size("x").alias("n")).limit(1).collect()  # head width, one row
        dk = probe[0]["n"] if probe else 1
    s = scores(q, kv, mask, key, dk, valid)
    wts = softmax_rows(s, key)
    outs = weighted_values(wts, key, dk)
    return wts.drop("v", "score"), outs


def merge_heads(outs: DataFrame, key: str = "seq_id") -> DataFrame:
    """Concatenate head outputs back to one vector per position (bounded: h heads)."""
    g = outs.groupBy(key, "row").agg(F.array_sort(F.collect_list(F.struct("head", "out"))).alias("_h"))
    return g.select(key, F.col("row").alias("pos"), F.flatten(F.transform("_h", lambda x: x["out"])).alias("vec"))
