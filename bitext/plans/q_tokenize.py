"""Queries of §2.8: pre-tokens, word/pair counts, BPE training, vocabulary,
encode, decode, detokenize, round trip, vocabulary store, token filter."""

from __future__ import annotations

from pyspark.sql import functions as F

from bitext.functions import text as T
from bitext.operators import bpe as B
from bitext.operators import bpe_encode as BE
from bitext.operators import bpe_train as BT
from bitext.operators.clean import filter_token_length
from bitext.plans.catalog import query
from bitext.functions.layout import SEQ_LEN
from bitext.plans.prepare import funnel
from bitext.plans.q_prepare import kept_split
from bitext.sources import fixtures as X

NUM_MERGES = 10  # merges of the tokenizer of the queries whose DuckDB twins unroll training
VOCAB_SIZE = 16_000  # fixed value: of the tokenizers that a real run trains (keys *_16k, without twins)

_TRAINED: dict = {}  # (application, corpus fingerprint, merges) -> tokenizers of both sides


def train_sentences(spark, sf, side="src"):
    """Tokenizers are trained on the train split only, before the token filter."""
    return kept_split(spark, sf).where(F.col("split") == "train").select(F.col(side).alias("text"))


def tokenizers(kept, num_merges: int | None = NUM_MERGES) -> dict:
    """Tokenizers of both sides of a prepared corpus, trained in the same rounds; without
    ``num_merges`` up to ``VOCAB_SIZE`` tokens each.

    Trained ones are reused only for a corpus with the same fingerprint.
    """
    sides = F.array(*[F.struct(F.lit(sd).alias("side"), F.col(sd).alias("text")) for sd in ("src", "tgt")])
    words = B.side_words(kept.where(F.col("split") == "train").select(F.inline(sides)))
    key = (kept.sparkSession.sparkContext.applicationId, B.corpus_fingerprint(words), num_merges)
    if key not in _TRAINED:
        _TRAINED[key] = BT.train_on_words(words, VOCAB_SIZE, num_merges)
    return _TRAINED[key]


def tokenizer(spark, sf, side="src", num_merges=NUM_MERGES) -> B.Tokenizer:
    return tokenizers(kept_split(spark, sf), num_merges)[side]


@query("pretokenize")
def q_pretokenize(spark, sf):
    return X.pairs(spark, sf).select("pair_id", T.pretokenize("src").alias("tokens"))


@query("word_freq")
def q_word_freq(spark, sf):
    return B.word_freq(train_sentences(spark, sf))


@query("alphabet")
def q_alphabet(spark, sf):
    return B.alphabet(B.word_freq(train_sentences(spark, sf)))


@query("pair_freq")
def q_pair_freq(spark, sf):
    return B.pair_freq(B.word_symbols(B.word_freq(train_sentences(spark, sf))))


@query("bpe_merge_step")
def q_merge_step(spark, sf):
    """Apply the first learned merge to every word type."""
    tok = tokenizer(spark, sf)
    l, r = tok.merges[0]
    ws = B.word_symbols(B.word_freq(train_sentences(spark, sf)))
    return ws.select("word", "freq", B.merge_col(F.col("s"), l, r).alias("s"))


@query("bpe_train")
def q_bpe_train(spark, sf):
    return tokenizer(spark, sf).merges_df(spark)


@query("vocab_table")
def q_vocab_table(spark, sf):
    return B.vocab_table(spark, tokenizer(spark, sf))


@query("vocab_size")
def q_vocab_size(spark, sf):
    return B.vocab_table(spark, tokenizer(spark, sf)).agg(F.count(F.lit(1)).alias("vocab_size"))


def encode_sides(kept, toks):
    """``src_ids`` and ``tgt_ids`` beside the texts."""
    return kept.select(
        "pair_id", "split", "src", "tgt",
        B.encode_col(F.col("src"), toks["src"]).alias("src_ids"),
        B.encode_col(F.col("tgt"), toks["tgt"]).alias("tgt_ids"),
    )


def encoded_pairs(spark, sf, num_merges=NUM_MERGES):
    kept = kept_split(spark, sf)
    return encode_sides(kept, tokenizers(kept, num_merges))


@query("bpe_encode")
def q_bpe_encode(spark, sf):
    ks = kept_split(spark, sf)
    return ks.select("pair_id", B.encode_col(F.col("src"), tokenizers(ks)["src"]).alias("src_ids"))


@query("bpe_encode_chars")
def q_bpe_encode_chars(spark, sf):
    ks = kept_split(spark, sf)
    return ks.select("pair_id", B.encode_col(F.col("src"), tokenizers(ks, 0)["src"]).alias("src_ids"))


@query("bpe_decode")
def q_bpe_decode(spark, sf):
    ks = kept_split(spark, sf)
    tok = tokenizers(ks)["src"]
    return ks.select("pair_id", B.decode_col(B.encode_col(F.col("src"), tok), tok).alias("text"))


@query("detok")
def q_detok(spark, sf):
    return X.pairs(spark, sf).select("pair_id", T.detok(F.array_join(T.pretokenize("src"), " ")).alias("text"))


@query("roundtrip")
def q_roundtrip(spark, sf):
    ks = kept_split(spark, sf)
    return B.roundtrip_rate(ks, "src", tokenizers(ks)["src"]).select(
        F.round("rate", 6).alias("rate"), F.col("rows").cast("bigint").alias("rows")
    )


@query("funnel")
def q_funnel(spark, sf):
    """Rows left after sampling, the word filter, the split and the token filter."""
    return funnel(X.pairs(spark, sf), encode=lambda kept: encode_sides(kept, tokenizers(kept)), seq_len=SEQ_LEN)


@query("filter_token_length")
def q_filter_token_length(spark, sf):
    enc = encoded_pairs(spark, sf)
    return filter_token_length(enc).select("pair_id", "split")


# ----------------------------------------------------------------- vocabulary of a real run
def encode_sides_large(kept, toks):
    """``src_ids`` and ``tgt_ids`` beside the texts, for large vocabularies."""
    ids = [BE.encode_col(F.col(side), toks[side]).alias(f"{side}_ids") for side in ("src", "tgt")]
    return kept.select("pair_id", "split", "src", "tgt", *ids)


@query("bpe_train_16k")
def q_bpe_train_16k(spark, sf):
    """Merges of both sides up to the vocabulary of a real run: ``(side, rank, left_tok, right_tok)``."""
    toks = tokenizers(kept_split(spark, sf), None)
    tables = [tok.merges_df(spark).select(F.lit(side).alias("side"), "rank", "left_tok", "right_tok") for side, tok in sorted(toks.items())]
    return tables[0].unionByName(tables[1])


@query("bpe_encode_16k")
def q_bpe_encode_16k(spark, sf):
    """Ids of all kept pairs under those vocabularies that pass the token filter."""
    kept = kept_split(spark, sf)
    fit = filter_token_length(encode_sides_large(kept, tokenizers(kept, None)), SEQ_LEN)
    return fit.select("pair_id", "split", "src_ids", "tgt_ids")
