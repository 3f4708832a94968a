"""Derived inputs built from the driver tables (see FIXTURES.md).

Everything is row-local or a bounded per-key computation, so the fixtures grow
linearly with the tables and never funnel a whole table through one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitext.functions import text as T
from bitext.sources.tables import spread, table

# ---------------------------------------------------------------------------
# Fixed values of the fixtures.
PIECE_SPLIT = r"[.\n]+"  # documents are cut into pieces at dots and newlines
PAIR_ID_STRIDE = 100000  # pair_id = doc_id * stride + piece number
DROP_EVERY = 7  # hyp_ref: every 7th word of the reference is left out
SEQ_LEN_VEC = 12  # vecs: vectors are grouped into sequences of 12 by vec_id
METRIC_EPOCH_STEPS = 500  # metrics: steps per epoch
# ---------------------------------------------------------------------------


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(pair_id, src, tgt)``: odd pieces of a document paired with the next one.

    Pieces come from one array per document (row-local ``transform``), so this
    needs no self-join and no shuffle.  A document with more pieces than
    ``PAIR_ID_STRIDE`` has ids for raises, as its pairs would take those of another.
    """
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    docs = docs.select("doc_id", F.split("text", PIECE_SPLIT).alias("a"))
    too_many = F.raise_error(F.concat(F.lit("too many pieces for the ids of document "), F.col("doc_id"))).cast("boolean")
    docs = docs.where(F.when(F.size("a") <= PAIR_ID_STRIDE, F.size("a") >= 2).otherwise(too_many))
    pieces = docs.select(
        "doc_id",
        F.explode(
            F.expr("transform(sequence(1, size(a) - 1, 2), k -> named_struct('k', k, 's', a[k - 1], 't', a[k]))")
        ).alias("x"),
    )
    return pieces.select(
        (F.col("doc_id") * PAIR_ID_STRIDE + F.col("x.k")).cast("bigint").alias("pair_id"),
        T.ustrip("x.s").alias("src"),
        T.ustrip("x.t").alias("tgt"),
    )


def pairs_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pairs(spark, sf_dir)
    return p.select("pair_id", F.struct("src", "tgt").alias("translation"))


def pairs_noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``src`` padded with two spaces each side, U+0640 put after every ``e`` of ``tgt``."""
    p = pairs(spark, sf_dir)
    return p.select(
        "pair_id",
        F.concat(F.lit("  "), "src", F.lit("  ")).alias("src"),
        F.replace("tgt", F.lit("e"), F.lit("e\u0640")).alias("tgt"),
    )


def pairs_kept(spark: SparkSession, sf_dir: str, max_words: int = 40) -> DataFrame:
    from bitext.operators.clean import filter_word_count

    return filter_word_count(pairs(spark, sf_dir), max_words)


def hyp_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``ref = tgt`` (non-empty); ``hyp`` = the words of ``tgt`` without every 7th."""
    p = pairs(spark, sf_dir).where(F.col("tgt") != "")
    hyp = F.array_join(F.filter(T.words("tgt"), lambda w, i: (i + 1) % DROP_EVERY != 0), " ")
    return p.select("pair_id", hyp.alias("hyp"), F.col("tgt").alias("ref"))


def vecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(seq_id, pos, vec_id, label, vec)``: embeddings grouped into sequences of
    12 consecutive ``vec_id`` values; floats cast to double.

    Sequences are cut from the id itself (no window), so every sequence has at
    most 12 positions however the labels are distributed.
    """
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.expr(f"vec_id div {SEQ_LEN_VEC}").alias("seq_id"),
        (F.col("vec_id") % SEQ_LEN_VEC).cast("int").alias("pos"),
        "vec_id",
        "label",
        F.transform("embedding", lambda x: x.cast("double")).alias("vec"),
    )


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings used as a logit row, ``label`` as the target id."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("logits"), "label"
    )


def weight_rows(spark: SparkSession, n_out: int, n_in: int, salt: int = 0) -> DataFrame:
    """A deterministic weight matrix ``(out, w array<double>[n_in], b)``.

    ``w[out, i] = ((out*31 + i*17 + salt) % 13 - 6) / 13``, ``b = (out % 5 - 2) / 10``.
    It is a parameter table (size n_out x n_in), not data.
    """
    return spark.range(n_out).select(
        F.col("id").cast("int").alias("out"),
        F.transform(
            F.sequence(F.lit(0), F.lit(n_in - 1)),
            lambda i: ((((F.col("id") * 31 + i * 17 + salt) % 13) - 6) / F.lit(13.0)).cast("double"),
        ).alias("w"),
        (((F.col("id") % 5) - 2) / F.lit(10.0)).cast("double").alias("b"),
    )


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(tag, step, epoch, value)`` from ``view`` events, step = rank by (ts, event_id)."""
    from bitext.operators.ranking import ordered_rank

    ev = table(spark, sf_dir, "events").where(F.col("event_type") == "view").select("event_id", "ts", "value")
    ranked = ordered_rank(ev, ["ts", "event_id"], rank_col="r")
    return ranked.select(
        F.lit("Loss/train").alias("tag"),
        (F.col("r") + 1).cast("bigint").alias("step"),
        F.expr(f"r div {METRIC_EPOCH_STEPS}").alias("epoch"),
        F.col("value").cast("double").alias("value"),
    )
