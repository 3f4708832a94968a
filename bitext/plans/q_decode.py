"""Queries of §2.11 (decoding) and the parameter sweep of §2.12."""

from __future__ import annotations

from pyspark.sql import functions as F

from bitext.config import END_OF_WORD, SPECIAL_TOKENS, UNK_ID
from bitext.functions import text as T
from bitext.functions.layout import SEQ_LEN
from bitext.functions.pretoken import pretokens
from bitext.functions.vectors import LENGTH_PENALTY
from bitext.operators import bleu as BL
from bitext.operators import bpe as B
from bitext.operators import clean as C
from bitext.operators import decode as D
from bitext.operators.sample import argmax
from bitext.plans.catalog import query, r6
from bitext.plans.q_prepare import kept_split
from bitext.plans.q_tokenize import tokenizers

MAX_LEN = SEQ_LEN  # decode budget in tokens, SOS included (as the reference)
# The sweep grid (beam size x n-gram block, then length penalty at beam 4).
GRID_BEAMS = (1, 2, 4, 6)
GRID_NGRAMS = (0, 3)
GRID_ALPHAS = (0.0, 0.6, 1.0)
KEEP = 2 * max(GRID_BEAMS) + MAX_LEN + 1  # successors kept per token: exact for every grid cell
SWEEP_TASKS = 200  # that score the texts of the sweep
EXAMPLES = 5  # compare_methods shows the first rows (the feature is a short report)


def target_sequences(kept):
    ks = kept.where(F.col("split") == "train")
    seq = F.concat(F.array(F.lit(D.SOS)), pretokens("tgt"), F.array(F.lit(D.EOS)))
    return ks.select(seq.alias("tokens"))


def scores(kept):
    return D.bigram_scores(kept.where(F.col("split") == "train").select("tgt"), "tgt")  # their target_sequences


def scorer(kept):
    return D.BigramScorer(scores(kept), keep=KEEP)


def seeds(kept, cfg: int = 0, k: int = D.BEAM_SIZE, ngram: int = D.NO_REPEAT_NGRAM,
          alpha: float = LENGTH_PENALTY):
    """Validation pairs; decoding starts from ``[SOS, first source pre-token]``."""
    val = kept.where(F.col("split") == "val")
    tokens = F.array(F.lit(D.SOS), F.element_at(T.pretokenize("src"), 1))
    return val.select(
        F.lit(cfg).alias("cfg"), F.col("pair_id").alias("sent_id"), tokens.alias("tokens"),
        F.lit(k).alias("k"), F.lit(ngram).alias("ngram"), F.lit(float(alpha)).alias("alpha"),
    )


def grid_rows():
    rows = [(i, k, n, 0.6) for i, (k, n) in enumerate((k, n) for k in GRID_BEAMS for n in GRID_NGRAMS)]
    base = len(rows)
    rows += [(base + j, 4, 3, a) for j, a in enumerate(GRID_ALPHAS)]
    return rows


def with_grid(df):
    """Every row once per grid cell: an explode of the (fixed, 11-cell) grid
    literal, so no join is needed and the row count grows only by the grid size."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("cfg"), F.lit(k).alias("k"), F.lit(n).alias("ngram"), F.lit(a).alias("alpha"))
        for c, k, n, a in grid_rows()
    ])
    g = df.select("*", F.explode(cells).alias("_g"))
    return g.select(*[c for c in df.columns if c not in ("cfg", "k", "ngram", "alpha")],
                    F.col("_g.cfg").alias("cfg"), F.col("_g.k").alias("k"),
                    F.col("_g.ngram").alias("ngram"), F.col("_g.alpha").alias("alpha"))


def text_of(tokens):
    """Hypothesis text: special tokens dropped, pre-tokens joined, detokenized."""
    words = F.filter(tokens, lambda t: ~t.isin(D.SOS, D.EOS))
    return T.detok(F.array_join(words, " "))


@query("score_table")
def q_score_table(spark, sf):
    return scores(kept_split(spark, sf)).select("prev", "token", "cnt", r6("logp").alias("logp"))


@query("argmax_token")
def q_argmax_token(spark, sf):
    return argmax(scores(kept_split(spark, sf)), "prev", "cnt", "token")


@query("topk_candidates")
def q_topk(spark, sf):
    """The best 2k continuations of each sentence in its second round, over all its beams."""
    kept = kept_split(spark, sf)
    sc = scorer(kept)
    nxt = D.beam_step(D.start_state(seeds(kept)), sc, 1, MAX_LEN).where("live")
    top = D.top_candidates(D.expand(nxt, sc, MAX_LEN).where("token is not null"))
    return top.select("sent_id", F.col("pos").cast("int").alias("rk"), "beam", "token", r6("cs").alias("cs"))


@query("greedy_decode")
def q_greedy(spark, sf):
    kept = kept_split(spark, sf)
    return D.greedy(seeds(kept), scorer(kept), MAX_LEN, keys=("sent_id",))


@query("repeat_rate")
def q_repeat_rate(spark, sf):
    """Share of greedy outputs that contain a repeated 3-gram."""
    from bitext.functions.layout import ngrams

    g = q_greedy(spark, sf)
    gr = ngrams("tokens", 3)
    rep = F.size(F.array_distinct(gr)) < F.size(gr)
    return g.agg(r6(F.avg(rep.cast("double"))).alias("rate"), F.count(F.lit(1)).alias("rows"))


@query("ngram_block")
def q_ngram_block(spark, sf):
    ks = kept_split(spark, sf)
    seq = F.concat(F.array(F.lit(D.SOS)), T.pretokenize("tgt"))
    ks = ks.select("pair_id", seq.alias("tokens"))
    return ks.select("pair_id", F.array_sort(D.banned_tokens("tokens", D.NO_REPEAT_NGRAM)).alias("banned"))


def _expand(spark, sf):
    """Candidates of the first round (rows without a token left out)."""
    kept = kept_split(spark, sf)
    return D.expand(D.start_state(seeds(kept)), scorer(kept), MAX_LEN).where("token is not null")


@query("beam_expand")
def q_beam_expand(spark, sf):
    return _expand(spark, sf).select("sent_id", "beam", "token", r6("cs").alias("cs"))


@query("beam_split")
def q_beam_split(spark, sf):
    sp = D.split_candidates(_expand(spark, sf))
    return sp.select("sent_id", F.col("pos").cast("int").alias("rk"), "token", "is_eos",
                     F.col("alive_before").cast("int").alias("alive_before"), r6("cs").alias("cs"))


@query("beam_step")
def q_beam_step(spark, sf):
    kept = kept_split(spark, sf)
    nxt = D.beam_step(D.start_state(seeds(kept)), scorer(kept), 1, MAX_LEN).where("live")
    return nxt.select("sent_id", F.col("beam").cast("int").alias("beam"), "tokens", r6("score").alias("score"))


@query("beam_decode")
def q_beam_decode(spark, sf):
    kept = kept_split(spark, sf)
    out = D.beam_search(seeds(kept), scorer(kept), MAX_LEN)
    return out.select("sent_id", "tokens", r6("norm").alias("norm"))


@query("beam_decode_trigram")
def q_beam_decode_trigram(spark, sf):
    """Beam search under a back-off model whose scores depend on the last two tokens."""
    kept = kept_split(spark, sf)
    texts = kept.where(F.col("split") == "train").select("tgt")  # their target_sequences
    model = D.BackoffScorer(D.context_counts(texts, col="tgt"))
    out = D.beam_search(seeds(kept), model, MAX_LEN)
    return out.select("sent_id", "tokens", r6("norm").alias("norm"))


def subword_tokens(ids, tok):
    """Ids of a tokenizer as token strings (specials included)."""
    names = F.array(*[F.lit(t) for t, _ in sorted(tok.vocab.items(), key=lambda x: x[1])])
    return F.transform(ids, lambda i: F.get(names, i))


def translate(kept, texts, toks, method: str = "beam", k: int = D.BEAM_SIZE, ngram: int = D.NO_REPEAT_NGRAM,
              alpha: float = LENGTH_PENALTY, seq_len: int = SEQ_LEN):
    """Text to text: ``(sent_id, over_length, text)`` for ``texts(sent_id, text)``.

    Subword encoding, cut to ``seq_len - 2`` ids, greedy or beam decoding over
    subwords, decoding to text, detokenising.  The stand-in scorer is a bigram
    model of the target side's subwords; it starts from the first source subword
    (``[UNK]`` where the target side lacks it).
    """
    src, tgt = toks["src"], toks["tgt"]
    train = kept.where(F.col("split") == "train").select(
        F.concat(F.array(F.lit(D.SOS)), subword_tokens(B.encode_col(F.col("tgt"), tgt), tgt), F.array(F.lit(D.EOS))).alias("tokens"))
    sc = D.BigramScorer(D.bigram_scores(train), keep=KEEP)
    ids = C.truncate_ids(B.encode_col(T.ustrip("text"), src), seq_len - 2)
    first = F.get(subword_tokens(ids, src), F.lit(0))
    known = F.array(*[F.lit(t) for t in tgt.vocab])
    seed = F.when(F.array_contains(known, first), first).otherwise(F.lit(SPECIAL_TOKENS[UNK_ID]))
    start = texts.select(
        F.lit(0).alias("cfg"), "sent_id", C.over_length_col("text").alias("over_length"),
        F.array(F.lit(D.SOS), seed).alias("tokens"),
        F.lit(k).alias("k"), F.lit(ngram).alias("ngram"), F.lit(float(alpha)).alias("alpha"))
    if method == "greedy":
        out = D.greedy(start, sc, seq_len, keys=("sent_id",))
    elif method == "beam":
        out = D.beam_search(start, sc, seq_len)
    else:
        raise ValueError(method)
    plain = F.filter("tokens", lambda t: ~t.isin(*SPECIAL_TOKENS))
    text = T.detok(T.ustrip(F.replace(F.array_join(plain, ""), F.lit(END_OF_WORD), F.lit(" "))))
    return out.join(start.select("sent_id", "over_length"), "sent_id").select("sent_id", "over_length", text.alias("text"))


@query("translate_batch")
def q_translate(spark, sf):
    kept = kept_split(spark, sf)
    texts = kept.where(F.col("split") == "val").select(F.col("pair_id").alias("sent_id"), F.col("src").alias("text"))
    return translate(kept, texts, tokenizers(kept))


@query("compare_methods")
def q_compare(spark, sf):
    """Source, target, greedy and beam output side by side for the first rows."""
    kept = kept_split(spark, sf)
    first = seeds(kept).orderBy("sent_id").limit(EXAMPLES)
    sc = scorer(kept)
    g = D.greedy(first, sc, MAX_LEN, keys=("sent_id",)).select("sent_id", text_of(F.col("tokens")).alias("greedy"))
    b = D.beam_search(first, sc, MAX_LEN).select("sent_id", text_of(F.col("tokens")).alias("beam"))
    val = kept.select(F.col("pair_id").alias("sent_id"), F.col("src").alias("source"),
                                       F.col("tgt").alias("target"))
    return first.select("sent_id").join(val, "sent_id").join(g, "sent_id").join(b, "sent_id")


@query("cross_param_grid")
def q_cross_param_grid(spark, sf):
    return with_grid(seeds(kept_split(spark, sf)).drop("tokens")).select("cfg", "sent_id", "k", "ngram", "alpha")


@query("bleu_sweep")
def q_bleu_sweep(spark, sf):
    """BLEU of greedy and of every grid cell, all cells decoded in the same rounds."""
    kept = kept_split(spark, sf)
    s, sc = seeds(kept), scorer(kept)
    beams = D.beam_search(with_grid(s), sc, MAX_LEN)
    greedy = D.greedy(s, sc, MAX_LEN, keys=("sent_id",)).select(F.lit(-1).alias("cfg"), "sent_id", "tokens")
    hyps = beams.select("cfg", "sent_id", "tokens").unionByName(greedy)
    refs = kept.select(F.col("pair_id").alias("sent_id"), F.col("tgt").alias("ref"))
    # many texts to score in few bytes, which adaptive execution would give to one task
    hr = hyps.join(refs, "sent_id").repartition(SWEEP_TASKS, "sent_id").select("cfg", "sent_id", text_of(F.col("tokens")).alias("hyp"), "ref")
    b = BL.corpus_bleu(hr, key="sent_id", by=["cfg"])
    grid = spark.createDataFrame([(-1, 1, 0, 0.0)] + grid_rows(), "cfg int, k int, ngram int, alpha double")
    return b.join(F.broadcast(grid), "cfg").select(
        "cfg", F.when(F.col("cfg") == -1, "greedy").otherwise("beam").alias("method"),
        "k", "ngram", "alpha", r6("bleu").alias("bleu"),
    )
