"""Queries of §2.10: vector operators and attention over the embeddings table."""

from __future__ import annotations

from pyspark.sql import functions as F

from bitext.functions import text as T
from bitext.functions import vectors as V
from bitext.operators import attention as A
from bitext.operators import attention_blocks as AB
from bitext.operators import linear as LN
from bitext.operators.clean import filter_word_count
from bitext.plans.catalog import query, r6, r6a
from bitext.sources import fixtures as X

D = 64  # embedding width of the driver table
H = 8
DK = D // H
BROADCAST_BYTES = 64 << 20  # a weight table is broadcast only below this size


def lookup_vectors(tokens, weights, id_col: str, vec_col: str, d: int):
    """Equi-join tokens with a weight table; broadcast only after checking its size."""
    rows = weights.count()
    w = F.broadcast(weights) if rows * d * 8 <= BROADCAST_BYTES else weights
    return tokens.join(w, id_col)


@query("embed_scale")
def q_embed_scale(spark, sf):
    v = X.vecs(spark, sf)
    tokens = v.select("seq_id", "pos", F.col("vec_id").alias("id"))
    weights = v.select(F.col("vec_id").alias("id"), "vec")
    j = lookup_vectors(tokens, weights, "id", "vec", D)
    return j.select("seq_id", "pos", r6a(V.scale("vec", D ** 0.5)).alias("emb"))


def pe_table(spark, sf):
    pos = X.vecs(spark, sf).select("pos").distinct()
    return pos.select("pos", V.positional("pos", D).alias("pe"))


@query("positional_table")
def q_positional_table(spark, sf):
    return pe_table(spark, sf).select("pos", r6a("pe").alias("pe"))


@query("add_positional")
def q_add_positional(spark, sf):
    v = X.vecs(spark, sf)
    # one row per position: bounded by the sequence length
    j = v.join(F.broadcast(pe_table(spark, sf)), "pos")
    return j.select("seq_id", "pos", r6a(V.vec_add("vec", "pe")).alias("vec"))


@query("layer_norm")
def q_layer_norm(spark, sf):
    return X.vecs(spark, sf).select("vec_id", r6a(V.layer_norm("vec")).alias("vec"))


@query("linear")
def q_linear(spark, sf):
    """The weights stay a table: sent to the tasks if small, else multiplied in blocks."""
    out = LN.linear(X.vecs(spark, sf), X.weight_rows(spark, 8, D, 0), "vec_id", "vec")
    return out.select("vec_id", r6a("out").alias("out"))


@query("feed_forward")
def q_feed_forward(spark, sf):
    """Both weight matrices stay tables, whatever their size."""
    w1, w2 = X.weight_rows(spark, 16, D, 0), X.weight_rows(spark, D, 16, 5)
    out = LN.feed_forward(X.vecs(spark, sf), w1, w2, "vec_id", "vec")
    return out.select("vec_id", r6a("out").alias("out"))


@query("split_heads")
def q_split_heads(spark, sf):
    v = X.vecs(spark, sf)
    return v.select("vec_id", F.transform(V.split_heads("vec", H), lambda a: r6a(a)).alias("heads"))


@query("attention_scores")
def q_attention_scores(spark, sf):
    v = X.vecs(spark, sf)
    q = A.heads_long(v, "vec", H)
    kv = q.withColumn("v", F.col("x"))
    s = A.scores(q, kv, "none", dk=DK)
    return s.select("seq_id", "head", "row", "column", r6("score").alias("score"))


@query("attention_self")
def q_attention_self(spark, sf):
    out = AB.attention(X.vecs(spark, sf), "vec", H, "none", max_len=X.SEQ_LEN_VEC)
    return out.select("seq_id", "pos", r6a("vec").alias("vec"))


@query("attention_causal")
def q_attention_causal(spark, sf):
    out = AB.attention(X.vecs(spark, sf), "vec", H, "causal", max_len=X.SEQ_LEN_VEC)
    return out.select("seq_id", "pos", r6a("vec").alias("vec"))


@query("attention_cross")
def q_attention_cross(spark, sf):
    """Target rows attend to layer-normalised source rows of the same sequence;
    source positions at or beyond the count of non-PAD (label <> 1) rows are masked."""
    v = X.vecs(spark, sf)
    src = v.select("seq_id", "pos", V.layer_norm("vec").alias("src_vec"))
    valid = v.groupBy("seq_id").agg(F.count_if(F.col("label") != 1).cast("int").alias("valid_len"))
    keys = src.join(valid, "seq_id").where("pos < valid_len")
    out = AB.attention(v, "vec", H, "none", kv_df=keys, kv_vec="src_vec", max_len=X.SEQ_LEN_VEC)
    return out.select("seq_id", "pos", r6a("vec").alias("vec"))


@query("softmax")
def q_softmax(spark, sf):
    return X.logits(spark, sf).select("vec_id", r6a(V.softmax("logits")).alias("p"))


@query("log_softmax")
def q_log_softmax(spark, sf):
    return X.logits(spark, sf).select("vec_id", r6a(V.log_softmax("logits")).alias("logp"))


@query("smoothed_ce")
def q_smoothed_ce(spark, sf):
    """Mean label-smoothed loss over rows whose label is not PAD (1)."""
    lg = X.logits(spark, sf).where(F.col("label") != 1)
    per = lg.select(V.smoothed_ce_row(V.log_softmax("logits"), F.col("label")).alias("l"))
    return per.agg(r6(F.avg("l")).alias("loss"), F.count(F.lit(1)).alias("rows"))


@query("lr_schedule")
def q_lr_schedule(spark, sf):
    m = X.metrics(spark, sf)
    return m.select("step", F.round(V.lr_schedule(F.col("step") - 1), 12).alias("lr"))


@query("length_penalty")
def q_length_penalty(spark, sf):
    k = filter_word_count(X.pairs(spark, sf))
    n = (T.word_count("tgt") + 2).cast("int")
    return k.select("pair_id", n.alias("len"), r6(V.length_penalty(n)).alias("lp"))
