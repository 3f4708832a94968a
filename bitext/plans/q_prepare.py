"""Queries of §2.1–2.3 and 2.7: scans, cleaning, filters, samples, splits, batches."""

from __future__ import annotations

from pyspark.sql import functions as F

from bitext.functions import text as T
from bitext.operators import clean as C
from bitext.operators import sample as S
from bitext.plans.catalog import query
from bitext.plans.prepare import prepare
from bitext.session import scratch_path
from bitext.sources import fixtures as X
from bitext.sources.tables import PAIR_SCHEMA, normalize_pairs, read_pairs, sentences, write_pairs

SAMPLE_N = 5000  # seeded_sample: the size of the sample is the feature



def kept_split(spark, sf):
    """Kept pairs of all pairs with their split (the prepared corpus)."""
    return prepare(X.pairs(spark, sf))


@query("scan_pairs")
def scan_pairs(spark, sf):
    """Pairs stored as Parquet, JSON lines and TSV files (a third each), read back."""
    root = scratch_path(spark, "pairs")
    third = F.pmod(F.xxhash64("pair_id"), F.lit(3))
    parts = []
    for i, fmt in enumerate(("parquet", "json", "tsv")):
        write_pairs(X.pairs(spark, sf).where(third == i), f"{root}/{fmt}", fmt)
        parts.append(read_pairs(spark, f"{root}/{fmt}", fmt, schema=PAIR_SCHEMA))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("normalize_pairs")
def q_normalize_pairs(spark, sf):
    """Half of the pairs in a nested struct, half in flat language columns."""
    nested = X.pairs_nested(spark, sf).where("pair_id % 2 = 0")
    flat = X.pairs(spark, sf).where("pair_id % 2 = 1").withColumnsRenamed({"src": "en", "tgt": "ar"})
    return normalize_pairs(nested, "src", "tgt").unionByName(normalize_pairs(flat, "en", "ar"))


@query("monolingual")
def q_monolingual(spark, sf):
    return sentences(X.pairs(spark, sf), "tgt")


@query("clean_noise")
def q_clean_noise(spark, sf):
    return C.clean_pairs(X.pairs_noisy(spark, sf))


@query("strip_text")
def q_strip_text(spark, sf):
    d = X.pairs_noisy(spark, sf).select("pair_id", T.ustrip(F.concat("src", F.lit("\t\n"))).alias("text"))
    return d.select("pair_id", "text", F.length("text").cast("int").alias("n_chars"))


@query("filter_word_count")
def q_filter_word_count(spark, sf):
    return C.filter_word_count(X.pairs(spark, sf))


@query("over_length_flag")
def q_over_length(spark, sf):
    d = C.flag_over_length(X.pairs(spark, sf), col="src")
    return d.select("pair_id", T.word_count("src").cast("int").alias("n_words"), "over_length")


@query("seeded_sample")
def q_seeded_sample(spark, sf):
    return S.sample_n(X.pairs(spark, sf), "pair_id", SAMPLE_N)


@query("train_val_split")
def q_split(spark, sf):
    return kept_split(spark, sf).select("pair_id", "split")


@query("subset_by_key")
def q_subset(spark, sf):
    keys = kept_split(spark, sf).where(F.col("split") == "val").select("pair_id")
    return S.subset(X.pairs(spark, sf), keys)


@query("epoch_batches")
def q_epoch_batches(spark, sf):
    train = kept_split(spark, sf).where(F.col("split") == "train").select("pair_id")
    return S.assign_batches(train, "pair_id", epoch=1)


@query("ordered_batches")
def q_ordered_batches(spark, sf):
    val = kept_split(spark, sf).where(F.col("split") == "val").select("pair_id")
    return S.assign_batches(val, "pair_id", 64, shuffle=False)


@query("limit_batches")
def q_limit_batches(spark, sf):
    return S.limit_batches(q_epoch_batches(spark, sf), 100).select("pair_id", "batch_id")


@query("split_check")
def q_split_check(spark, sf):
    d = kept_split(spark, sf).select("pair_id", "split")
    allk = d.select("pair_id")
    tr = d.where("split = 'train'").select("pair_id")
    va = d.where("split = 'val'").select("pair_id")
    union = tr.unionByName(va)
    parts = [
        allk.agg(F.count(F.lit(1)).alias("v")).select(F.lit("all").alias("name"), "v"),
        tr.agg(F.count(F.lit(1)).alias("v")).select(F.lit("train").alias("name"), "v"),
        va.agg(F.count(F.lit(1)).alias("v")).select(F.lit("val").alias("name"), "v"),
        union.distinct().agg(F.count(F.lit(1)).alias("v")).select(F.lit("union").alias("name"), "v"),
        tr.intersect(va).agg(F.count(F.lit(1)).alias("v")).select(F.lit("intersect").alias("name"), "v"),
        allk.exceptAll(union).agg(F.count(F.lit(1)).alias("v")).select(F.lit("missing").alias("name"), "v"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("name", F.col("v").cast("bigint").alias("rows"))
