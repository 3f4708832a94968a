"""Queries of §2.9 (layout) plus validate/truncate, next-token pairs and n-grams."""

from __future__ import annotations

from pyspark.sql import functions as F

from bitext.functions import layout as L
from bitext.operators import layout as LO
from bitext.operators import sample as S
from bitext.operators.clean import filter_token_length, truncate_ids, validate_fit
from bitext.plans.catalog import query
from bitext.operators.ranking import ordered_rank
from bitext.plans.q_tokenize import encoded_pairs
from bitext.session import scratch_path, written
from bitext.sources import row_store as RS

SEQ = L.SEQ_LEN


def fit_pairs(spark, sf):
    """Encoded kept pairs that pass the token filter."""
    return filter_token_length(encoded_pairs(spark, sf), SEQ)


@query("encoder_input")
def q_encoder_input(spark, sf):
    return fit_pairs(spark, sf).select("pair_id", L.encoder_input("src_ids", SEQ).alias("encoder_input"))


@query("decoder_input")
def q_decoder_input(spark, sf):
    return fit_pairs(spark, sf).select("pair_id", L.decoder_input("tgt_ids", SEQ).alias("decoder_input"))


@query("labels")
def q_labels(spark, sf):
    return fit_pairs(spark, sf).select("pair_id", L.labels("tgt_ids", SEQ).alias("labels"))


@query("padding_mask")
def q_padding_mask(spark, sf):
    return fit_pairs(spark, sf).select(
        "pair_id", L.padding_mask(L.encoder_input("src_ids", SEQ)).alias("encoder_mask")
    )


@query("causal_mask")
def q_causal_mask(spark, sf):
    """One causal mask per distinct decoder length (masks depend only on the length)."""
    lens = fit_pairs(spark, sf).select((F.size("tgt_ids") + 1).cast("int").alias("size")).distinct()
    return lens.select("size", L.causal_mask(F.col("size")).alias("mask"))


@query("decoder_mask")
def q_decoder_mask(spark, sf):
    """Decoder mask per distinct valid length (pads are a suffix, so the length decides)."""
    rows = fit_pairs(spark, sf).select(L.decoder_input("tgt_ids", SEQ).alias("d"))
    one = rows.groupBy(L.valid_len("d").alias("valid_len")).agg(F.min("d").alias("d"))  # at most SEQ rows
    return one.select("valid_len", L.decoder_mask("d").alias("mask"))


@query("model_rows")
def q_model_rows(spark, sf):
    return LO.model_rows(fit_pairs(spark, sf), SEQ)


LOOKUP_EVERY, LOOKUPS = 97, 100  # row_lookup: the positions 0, 97, ... of a hundred requests


@query("row_lookup")
def q_row_lookup(spark, sf):
    """All model rows stored by position; a hundred positions read from the files that hold them."""
    # written first: the ranks' ranges are sampled, which would encode everything twice
    fit = written(fit_pairs(spark, sf), "fit-pairs")
    rows = LO.model_rows(ordered_rank(fit, ["pair_id"]), SEQ, keep=("rank", "pair_id"))
    path = scratch_path(spark, "model-rows")
    RS.write_rows(rows.select("rank", "pair_id", "encoder_input", "decoder_input", "labels"), path)
    return RS.read_rows(spark, path, range(0, LOOKUP_EVERY * LOOKUPS, LOOKUP_EVERY))


def train_batches(spark, sf, cols=("*",)):
    fit = fit_pairs(spark, sf).where(F.col("split") == "train").select(*cols)
    return S.assign_batches(fit, "pair_id", epoch=1)


@query("collate")
def q_collate(spark, sf):
    """Every array of a batch: three layouts, the encoder mask and the decoder's valid lengths."""
    rows = LO.model_rows(train_batches(spark, sf), SEQ, keep=("batch_id", "rank", "pair_id"))
    return LO.collate(rows, cols=["pair_id", "encoder_input", "decoder_input", "labels", "encoder_mask", "decoder_valid_len"])


@query("padding_stats")
def q_padding_stats(spark, sf):
    b = train_batches(spark, sf, ("pair_id", "tgt_ids")).select("batch_id", L.decoder_input("tgt_ids", SEQ).alias("decoder_input"))
    return LO.padding_stats(b)


@query("validate_fit")
def q_validate_fit(spark, sf):
    _, rejects = validate_fit(encoded_pairs(spark, sf), SEQ, mode="split")
    return rejects.select(
        "pair_id", F.size("src_ids").cast("int").alias("src_len"), F.size("tgt_ids").cast("int").alias("tgt_len")
    )


@query("truncate_ids")
def q_truncate_ids(spark, sf):
    return encoded_pairs(spark, sf).select("pair_id", truncate_ids("src_ids", SEQ - 2).alias("src_ids"))


@query("next_token_pairs")
def q_next_token_pairs(spark, sf):
    seq = F.concat(F.array(F.lit(5).cast("int")), F.col("tgt_ids"), F.array(F.lit(4).cast("int")))
    d = fit_pairs(spark, sf).select("pair_id", F.posexplode(L.next_token_pairs(seq)).alias("pos", "p"))
    return d.select("pair_id", F.col("pos").cast("int").alias("pos"), F.col("p.prev").alias("prev"),
                    F.col("p.next").alias("next"))


@query("ngrams")
def q_ngrams(spark, sf):
    return fit_pairs(spark, sf).select("pair_id", L.ngrams("tgt_ids", 3).alias("grams"))
