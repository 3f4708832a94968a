"""Queries of §2.1 (stores, snapshots, metric log), §2.4 (vocabulary lookup),
§2.5/2.6 (losses, corpus statistics), §2.12 (attention analysis) and §2.14 (stream)."""

from __future__ import annotations

from pyspark.sql import functions as F

from bitext.functions import text as T
from bitext.functions import vectors as V
from bitext.functions.pretoken import pretokens
from bitext.operators import attention as A
from bitext.operators import attention_stats as AS
from bitext.operators import bpe as B
from bitext.operators import metrics as M
from bitext.operators.clean import filter_token_length
from bitext.operators.layout import model_rows
from bitext.operators.ranking import ordered_rank
from bitext.plans.catalog import query, r6
from bitext.plans.q_prepare import kept_split
from bitext.plans.q_tokenize import NUM_MERGES, encode_sides, encoded_pairs, tokenizers, train_sentences
from bitext.session import scratch_path
from bitext.sources import attention_store as ATS
from bitext.sources import fixtures as X
from bitext.sources import snapshots as SN
from bitext.sources import vocab_store as VS
from bitext.streaming import metric_sink as MS
from bitext.streaming import prepare_stream as ST

H = 8
N_SHOW = 20  # attention maps show at most 20 tokens per axis (a display limit)


# ----------------------------------------------------------------- metrics
@query("metric_log")
def q_metric_log(spark, sf):
    return M.log_metrics(X.metrics(spark, sf))


@query("epoch_loss")
def q_epoch_loss(spark, sf):
    return M.epoch_loss(X.metrics(spark, sf)).select("epoch", r6("loss").alias("loss"), "steps")


@query("running_loss")
def q_running_loss(spark, sf):
    """Running mean inside an epoch.  The logged values carry two decimals, so the
    running sum is kept exactly in cents and the 6-place mean is rounded half-up
    in integers (a float sum can land on either side of a .5 tie)."""
    m = X.metrics(spark, sf).withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))
    r = M.running_loss(m, value_col="cents", exact=True)
    return r.select("step", "epoch", "running_loss")


@query("batch_loss_mean")
def q_batch_loss_mean(spark, sf):
    lg = X.logits(spark, sf)
    ranked = ordered_rank(lg, ["vec_id"], rank_col="rank").withColumn("batch_id", F.expr("rank div 64"))
    losses = ranked.where(F.col("label") != 1).select(
        "batch_id", V.smoothed_ce_row(V.log_softmax("logits"), F.col("label")).alias("loss"))
    return M.batch_loss_mean(losses, 100).select(r6("loss").alias("loss"), "batches")


@query("corpus_stats")
def q_corpus_stats(spark, sf):
    s = M.corpus_stats(encoded_pairs(spark, sf))
    return s.select("split", "pairs", "src_words", "tgt_words", "max_src_words", "max_tgt_words",
                    r6("avg_src_words").alias("avg_src_words"), "src_tokens", "tgt_tokens", "max_src_tokens", "max_tgt_tokens")


@query("metric_stream")
def q_metric_stream(spark, sf):
    """Epoch losses kept by a stream over metric files in three micro-batches or more."""
    root = scratch_path(spark, "metric-stream")
    X.metrics(spark, sf).repartition(6, "step").write.parquet(f"{root}/in")
    MS.metric_stream(spark, f"{root}/in", root, files_per_trigger=2)
    return MS.epoch_losses(spark, root).select("epoch", r6("loss").alias("loss"), "steps")


# ----------------------------------------------------------------- vocabulary
@query("vocab_lookup")
def q_vocab_lookup(spark, sf):
    """Word -> id through the vocabulary (left join, missing -> UNK) and back
    (id -> token, missing -> <blank>).  The vocabulary is bounded by its
    size parameter and checked before it is broadcast."""
    kept = kept_split(spark, sf)
    tok = tokenizers(kept)["src"]
    vocab = B.vocab_table(spark, tok)
    n = len(tok.vocab)
    vb = F.broadcast(vocab) if n <= 1_000_000 else vocab
    words = kept.select("pair_id", F.posexplode(pretokens("src")).alias("pos", "token"))
    ids = words.join(vb, "token", "left").select("pair_id", F.col("pos").cast("int").alias("pos"), "token",
                                                F.coalesce("id", F.lit(0)).cast("int").alias("id"))
    back = ids.join(vb.select(F.col("id"), F.col("token").alias("back")), "id", "left")
    return back.select("pair_id", "pos", "token", "id", F.coalesce("back", F.lit(AS.BLANK)).alias("back"))


@query("vocab_store")
def q_vocab_store(spark, sf):
    path = scratch_path(spark, "vocab")
    tok, reused = VS.get_or_build_tokenizer(spark, path, train_sentences(spark, sf), num_merges=NUM_MERGES)
    tok2, reused2 = VS.get_or_build_tokenizer(spark, path, train_sentences(spark, sf), num_merges=NUM_MERGES)
    assert not reused and reused2 and tok2.vocab == tok.vocab
    return spark.read.parquet(f"{path}/vocab")


# ----------------------------------------------------------------- snapshots
@query("snapshot_write")
def q_snapshot_write(spark, sf):
    """Three epochs of the epoch-loss table written with keep_last=1: only the
    newest version survives; returns the versions left and their rows."""
    root = scratch_path(spark, "snap")
    m = M.epoch_loss(X.metrics(spark, sf))
    for v in range(3):
        SN.write_snapshot(m.where(F.col("epoch") <= v), root, v)
    rows = [(v, SN.read_snapshot(spark, root, v).count()) for v in SN.list_versions(spark, root)]
    return spark.createDataFrame(rows, "version int, rows bigint")


@query("snapshot_read")
def q_snapshot_read(spark, sf):
    root = scratch_path(spark, "snap")
    m = M.epoch_loss(X.metrics(spark, sf))
    SN.write_snapshot(m, root, 0)
    return SN.read_snapshot(spark, root).select("epoch", r6("loss").alias("loss"), "steps")


# ----------------------------------------------------------------- attention analysis
def attn_parts(spark, sf):
    """Long attention tables of the three kinds (layer 0) over the embedding sequences."""
    v = X.vecs(spark, sf)
    enc, _ = A.attention(v, "vec", H, "none", dk=8)
    dec, _ = A.attention(v, "vec", H, "causal", dk=8)
    src = v.select("seq_id", "pos", V.layer_norm("vec").alias("src_vec"))
    cross, _ = A.attention(v, "vec", H, "valid", kv_df=src, kv_vec="src_vec", valid=valid_lens(spark, sf), dk=8)
    parts = [enc.withColumn("type", F.lit("encoder")), dec.withColumn("type", F.lit("decoder")),
             cross.withColumn("type", F.lit("cross"))]
    return [p.select("seq_id", "type", F.lit(0).alias("layer"), "head", "row", "column", F.col("weight").alias("value")) for p in parts]


def attn_all(spark, sf):
    enc, dec, cross = attn_parts(spark, sf)
    return enc.unionByName(dec).unionByName(cross)


def valid_lens(spark, sf):
    v = X.vecs(spark, sf)
    return v.groupBy("seq_id").agg(F.count_if(F.col("label") != 1).cast("int").alias("valid_len"))


def attn_tokens(spark, sf):
    """``'v' || vec_id`` per position; the last position of each sequence has none."""
    v = X.vecs(spark, sf)
    last = v.groupBy("seq_id").agg(F.max("pos").alias("_last"))
    return v.join(last, "seq_id").where(F.col("pos") < F.col("_last")).select(
        "seq_id", "pos", F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("token"))


@query("attn_long")
def q_attn_long(spark, sf):
    a = AS.attention_select(attn_all(spark, sf), "cross")
    out = AS.attention_long(a, attn_tokens(spark, sf), N_SHOW)
    return out.select("seq_id", "head", "row", "column", r6("value").alias("value"), "row_token", "col_token")


@query("attn_select")
def q_attn_select(spark, sf):
    """Weights are stored by type and layer; the selection reads the decoder's folder only."""
    path = scratch_path(spark, "attention")
    ATS.write_attention(attn_parts(spark, sf), path)
    a = ATS.read_attention(spark, path, "decoder", layers=[0], heads=[0, 1, 2])
    return a.select("seq_id", "head", "row", "column", r6("value").alias("value"))


@query("attn_entropy")
def q_attn_entropy(spark, sf):
    return AS.attention_entropy(attn_all(spark, sf)).select("type", "layer", r6("entropy").alias("entropy"), "heads")


@query("attn_sink")
def q_attn_sink(spark, sf):
    s = AS.attention_sink(attn_all(spark, sf))
    return s.select("type", "layer", "head", r6("mean_peak").alias("mean_peak"), r6("sink_share").alias("sink_share"))


@query("attn_align")
def q_attn_align(spark, sf):
    a = AS.attention_select(attn_all(spark, sf), "cross")
    return AS.attention_align(a).select("seq_id", "head", "row", "best_column")


@query("attn_valid")
def q_attn_valid(spark, sf):
    a = AS.attention_select(attn_all(spark, sf), "encoder")
    return AS.attention_valid(a, valid_lens(spark, sf)).select("seq_id", "head", "row", "column",
                                                                r6("value").alias("value"))


# ----------------------------------------------------------------- stream
@query("stream_prepare")
def q_stream_prepare(spark, sf):
    """Pairs arrive as files in two drops; two availableNow runs over one checkpoint
    give the batch result (clean, word filter, token filter, layout) exactly once."""
    root = scratch_path(spark, "stream")
    stage, inp, out, ck = f"{root}/stage", f"{root}/in", f"{root}/out", f"{root}/ck"
    X.pairs_noisy(spark, sf).repartition("pair_id").write.parquet(stage)
    jvm = spark._jvm
    fs = jvm.org.apache.hadoop.fs.Path(stage).getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted(st.getPath().toString() for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(stage))
                   if st.getPath().getName().endswith(".parquet"))
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(inp))
    half = (len(files) + 1) // 2
    toks = tokenizers(kept_split(spark, sf))

    def layout(pairs):
        enc = encode_sides(pairs.withColumn("split", F.lit(None).cast("string")), toks)
        rows = model_rows(filter_token_length(enc))
        return rows.select("pair_id", "encoder_input", "decoder_input", "labels")

    for drop in (files[:half], files[half:]):
        for f in drop:
            name = f.rsplit("/", 1)[1]
            fs.rename(jvm.org.apache.hadoop.fs.Path(f), jvm.org.apache.hadoop.fs.Path(f"{inp}/{name}"))
        ST.prepare_stream(spark, inp, out, ck, layout=layout)
    ST.prepare_stream(spark, inp, out, ck, layout=layout)  # idle run: nothing new, nothing redone
    return spark.read.parquet(out)
