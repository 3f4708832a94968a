"""Model rows, batches stacked per batch id, padding statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitext.functions import layout as L


def model_rows(encoded: DataFrame, seq_len: int = L.SEQ_LEN, src_ids: str = "src_ids", tgt_ids: str = "tgt_ids",
               keep=("pair_id",)) -> DataFrame:
    """All fields of a pair: three layout arrays, padding masks as valid lengths
    plus the encoder mask, and the two texts.  Row-local."""
    enc = L.encoder_input(src_ids, seq_len)
    dec = L.decoder_input(tgt_ids, seq_len)
    return encoded.select(
        *keep,
        enc.alias("encoder_input"),
        dec.alias("decoder_input"),
        L.labels(tgt_ids, seq_len).alias("labels"),
        L.padding_mask(enc).alias("encoder_mask"),
        (F.size(src_ids) + 2).cast("int").alias("encoder_valid_len"),
        (F.size(tgt_ids) + 1).cast("int").alias("decoder_valid_len"),
        F.col("src").alias("src_text"),
        F.col("tgt").alias("tgt_text"),
    )


def collate(rows: DataFrame, batch_col: str = "batch_id", rank_col: str = "rank", cols=None) -> DataFrame:
    """Stack the members of each batch in rank order.  A batch is bounded by the
    batch size, so each group is small whatever the data size."""
    cols = cols or [c for c in rows.columns if c not in (batch_col, rank_col)]
    packed = F.struct(F.col(rank_col).alias("_r"), *[F.col(c) for c in cols])
    g = rows.groupBy(batch_col).agg(F.array_sort(F.collect_list(packed)).alias("_m"))
    return g.select(batch_col, *[F.col(f"_m.{c}").alias(c) for c in cols])


def padding_stats(rows: DataFrame, batch_col: str = "batch_id", arr: str = "decoder_input") -> DataFrame:
    """Share of PAD positions per batch."""
    pads = F.size(F.filter(arr, lambda x: x == 1))
    return rows.groupBy(batch_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(pads).cast("bigint").alias("pad_positions"),
        F.sum(F.size(arr)).cast("bigint").alias("positions"),
    ).withColumn("pad_share", F.round(F.col("pad_positions") / F.col("positions"), 6))
