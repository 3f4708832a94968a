"""Byte-pair-encoding tokenizer on Spark: counts, training rounds, encode, decode.

Data layout: a word's symbols are kept as ONE string with a space on both sides
of every symbol, e.g. ``" t  h  e</w> "``.  Merging the pair ``(t, h)`` is then the
built-in ``replace(s, ' t  h ', ' th ')`` – left-to-right and non-overlapping,
exactly like merging a symbol list.  Symbols never contain spaces (pre-tokens are
split at whitespace).

Training works on DISTINCT words only: the corpus-sized work is one
``groupBy(word).count()`` (partial aggregation pre-combines hot words map-side).
The counts of adjacent pairs are kept between rounds: a round picks merges on the
driver from a bounded top list, and only words that hold a merged pair give up the
counts of their old pairs and add those of their new ones.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bitext.config import END_OF_WORD, SPECIAL_TOKENS
from bitext.functions import pretoken as P
from bitext.functions import text as T
from bitext.session import written

N_SPECIAL = len(SPECIAL_TOKENS)
COUNT_BYTES = 32 << 20  # of texts whose words are counted at once


# ----------------------------------------------------------------- word tables
def word_freq(sentences: DataFrame, text_col: str = "text") -> DataFrame:
    """``(word, freq)``: frequency of each pre-token over a sentence table."""
    toks = sentences.select(F.explode(T.pretokenize(text_col)).alias("word"))
    return toks.groupBy("word").agg(F.count(F.lit(1)).alias("freq"))


def chars(col) -> Column:
    """Unicode code points of a string (regex ``.`` matches whole code points)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_extract_all(c, F.lit("(?s)."), 0)


def initial_symbols(col) -> Column:
    """Characters of a word, the last one carrying the end-of-word suffix."""
    cs = chars(col)
    return F.transform(cs, lambda c, i: F.when(i == F.size(cs) - 1, F.concat(c, F.lit(END_OF_WORD))).otherwise(c))


def to_symbol_string(symbols: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(symbols, "  "), F.lit(" "))


def from_symbol_string(s: Column) -> Column:
    """Inverse of ``to_symbol_string`` (outer spaces removed, split at double spaces)."""
    return F.split(F.trim(s), "  ")


def symbol_string(words_joined) -> Column:
    """Symbol string of tab-separated words, built with two regex passes (no lambda):
    every character gets a space on both sides, the last one of each word ``</w>``."""
    c = F.col(words_joined) if isinstance(words_joined, str) else words_joined
    spaced = F.regexp_replace(c, r"([^\t])", " $1 ")
    return F.regexp_replace(spaced, r" (\t|$)", END_OF_WORD + " $1")


def word_symbols(wf: DataFrame) -> DataFrame:
    """``(word, freq, s)`` with ``s`` the symbol string of the unmerged word."""
    return wf.select("word", "freq", symbol_string("word").alias("s"))


def alphabet(wf: DataFrame) -> DataFrame:
    """``(symbol, freq)``: initial symbols, weighted by word frequency."""
    sy = wf.select(F.explode(initial_symbols("word")).alias("symbol"), "freq")
    return sy.groupBy("symbol").agg(F.sum("freq").cast("bigint").alias("freq"))


PAIR_LOOKAHEAD = r" (\S+) (?= (\S+) )"  # a symbol and, without consuming it, the next one


def pair_freq(ws: DataFrame) -> DataFrame:
    """``(left_tok, right_tok, freq)``: adjacent symbol pairs weighted by word frequency.

    Pairs are read off the symbol string with one look-ahead regex (overlapping
    pairs, no lambda), then summed with a partial + final aggregate.
    """
    lefts = F.regexp_extract_all(F.col("s"), F.lit(PAIR_LOOKAHEAD), 1)
    rights = F.regexp_extract_all(F.col("s"), F.lit(PAIR_LOOKAHEAD), 2)
    pr = ws.select("freq", F.explode(F.arrays_zip(lefts.alias("left_tok"), rights.alias("right_tok"))).alias("p"))
    return pr.groupBy(F.col("p.left_tok").alias("left_tok"), F.col("p.right_tok").alias("right_tok")).agg(
        F.sum("freq").cast("bigint").alias("freq")
    )


def merge_col(s: Column, left: str, right: str) -> Column:
    """Apply one merge to a symbol-string column."""
    return F.replace(s, F.lit(f" {left}  {right} "), F.lit(f" {left}{right} "))


def apply_merges_col(s: Column, merges) -> Column:
    for l, r in merges:
        s = merge_col(s, l, r)
    return s


# ----------------------------------------------------------------- training
@dataclass
class Tokenizer:
    """Trained artefacts: merges in rank order and the token -> id map."""

    merges: list = field(default_factory=list)  # [(left, right)]
    vocab: dict = field(default_factory=dict)  # token -> id

    @property
    def id_to_token(self) -> dict:
        return {i: t for t, i in self.vocab.items()}

    def merges_df(self, spark: SparkSession) -> DataFrame:
        rows = [(i, l, r) for i, (l, r) in enumerate(self.merges)]
        schema = "rank int, left_tok string, right_tok string"
        return spark.createDataFrame(rows, schema)

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        rows = sorted(((t, i) for t, i in self.vocab.items()), key=lambda x: x[1])
        return spark.createDataFrame(rows, "token string, id int")


def _choose(cands: list, symbols: set, budget: int) -> list:
    """Exact batch of merges from candidates sorted by (count desc, left, right).

    Walk down while pairs are independent: no shared symbol with a chosen pair,
    not ``(a, a)``, merged string not yet a symbol.  The first pair failing that
    sets ``cut``; chosen pairs with count strictly above ``cut`` are accepted
    (a merge cannot create a pair outnumbering one it conflicts with).  With none
    above the cut, only the top pair is taken.
    """
    chosen, used, made, cut = [], set(), set(), None
    for l, r, c in cands:
        if l == r or l in used or r in used or (l + r) in symbols or (l + r) in made:
            cut = c
            break
        chosen.append((l, r, c))
        used.update((l, r))
        made.add(l + r)
    if cut is None:
        # the list was exhausted: the last candidate bounds what is unseen
        cut = cands[-1][2] if len(cands) > 1 else -1
        if len(cands) > 1:
            chosen = chosen[:-1] if chosen and chosen[-1][2] == cut else chosen
    accepted = [(l, r) for l, r, c in chosen if c > cut]
    if not accepted:
        accepted = [(cands[0][0], cands[0][1])]
    return accepted[:budget]


def _pairs(s: str) -> Column:
    """Adjacent symbol pairs of a symbol string, in order."""
    lefts = F.regexp_extract_all(F.col(s), F.lit(PAIR_LOOKAHEAD), 1)
    rights = F.regexp_extract_all(F.col(s), F.lit(PAIR_LOOKAHEAD), 2)
    return F.arrays_zip(lefts.alias("left_tok"), rights.alias("right_tok"))


def _sum_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("side", "left_tok", "right_tok").agg(F.sum("freq").cast("bigint").alias("freq"))


def _side_pairs(ws: DataFrame, s: str, sign: int = 1) -> DataFrame:
    d = ws.select("side", (F.col("freq") * sign).alias("freq"), F.explode(_pairs(s)).alias("p"))
    return d.select("side", "p.left_tok", "p.right_tok", "freq")


def train_bpe(sentences: DataFrame, vocab_size: int = 16000, num_merges: int | None = None,
              text_col: str = "text", candidates: int = 256) -> Tokenizer:
    """Train merges on a sentence table; see ``train_bpe_sides``."""
    one = sentences.select(F.lit("").alias("side"), F.col(text_col).alias("text"))
    return train_bpe_sides(one, num_merges, vocab_size, candidates=candidates).get("", Tokenizer(vocab=build_vocab([], [])))


def train_bpe_sides(sentences: DataFrame, num_merges: int | None = None, vocab_size: int = 16000,
                    text_col: str = "text", side_col: str = "side", candidates: int = 256,
                    rewrite_every: int = 8) -> dict:
    """Train one tokenizer per value of ``side_col`` in the same Spark rounds.

    ``num_merges`` caps the merges directly; otherwise ``vocab_size`` bounds
    specials + alphabet + merges.  A round takes several merges only where the
    result equals one merge at a time (``_choose``).  The candidate lists of all
    sides come back in one bounded collect (sides x candidates rows).  Pair counts
    are written to the shared folder each round, words every ``rewrite_every``.
    """
    return train_on_words(side_words(sentences, text_col, side_col), num_merges, vocab_size, candidates, rewrite_every)


def count_words(sentences: DataFrame, text_col: str = "text", side_col: str = "side") -> DataFrame:
    """``(side, word, freq)``: counts of some batches of texts each, to be summed."""
    schema = pa.schema([("side", pa.string()), ("word", pa.string()), ("freq", pa.int64())])

    def counted(held: dict[str, list[pa.Array]]) -> Iterator[pa.RecordBatch]:
        for side, parts in held.items():
            words = pa.chunked_array(parts, pa.string()).value_counts()
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(side, pa.string()), len(words)), words.field(0), words.field(1)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = defaultdict(list), 0
        for batch in batches:
            for side in pc.unique(batch["side"]).to_pylist():
                own = pc.is_null(batch["side"]) if side is None else pc.equal(batch["side"], side)
                held[side].append(P.find(batch["text"].filter(own)).words())
            size += batch.nbytes
            if size >= COUNT_BYTES:
                yield from counted(held)
                held, size = defaultdict(list), 0
        yield from counted(held)

    columns = sentences.select(F.col(side_col).cast("string").alias("side"), F.col(text_col).alias("text"))
    return columns.mapInArrow(run, "side string, word string, freq long")


def side_words(sentences: DataFrame, text_col: str = "text", side_col: str = "side") -> DataFrame:
    """``(side, word, freq, s)``: counted word types with their symbol strings, written once."""
    wf = count_words(sentences, text_col, side_col).groupBy("side", "word").agg(F.sum("freq").alias("freq"))
    return written(wf.select("side", "word", "freq", symbol_string("word").alias("s")), "bpe-words")


def train_on_words(ws: DataFrame, num_merges: int | None = None, vocab_size: int = 16000,
                   candidates: int = 256, rewrite_every: int = 8) -> dict:
    """The rounds of ``train_bpe_sides`` on its word types."""
    al = ws.select("side", F.explode(initial_symbols("word")).alias("symbol")).distinct().collect()
    sides = sorted({r["side"] for r in al})
    alpha = {sd: sorted((r["symbol"] for r in al if r["side"] == sd), key=lambda x: x.encode("utf-8")) for sd in sides}
    symbols = {sd: set(alpha[sd]) for sd in sides}
    budget = {sd: num_merges if num_merges is not None else max(0, vocab_size - N_SPECIAL - len(alpha[sd]))
              for sd in sides}
    merges = {sd: [] for sd in sides}
    counts = None
    rounds = 0
    w = Window.partitionBy("side").orderBy(F.col("freq").desc(), F.col("left_tok"), F.col("right_tok"))
    while any(len(merges[sd]) < budget[sd] for sd in sides):
        if counts is None:
            counts = written(_sum_pairs(_side_pairs(ws, "s")), "bpe-pairs")
        top = counts.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= candidates + 1).collect()
        expr, touched, progressed = F.col("s"), F.lit(False), False
        for sd in sides:
            cands = [(r["left_tok"], r["right_tok"], r["freq"])
                     for r in sorted((r for r in top if r["side"] == sd), key=lambda r: r["_r"])]
            if not cands or len(merges[sd]) >= budget[sd]:
                budget[sd] = len(merges[sd])  # nothing left to merge on this side
                continue
            acc = _choose(cands, symbols[sd], budget[sd] - len(merges[sd]))
            merges[sd].extend(acc)
            symbols[sd].update(l + r for l, r in acc)
            here = F.col("side") == sd
            holds = F.lit(False)
            for l, r in acc:
                holds = holds | F.contains(F.col("s"), F.lit(f" {l}  {r} "))
            touched = touched | (here & holds)
            expr = F.when(here, apply_merges_col(F.col("s"), acc)).otherwise(expr)
            progressed = True
        if not progressed or all(len(merges[sd]) >= budget[sd] for sd in sides):
            break
        changed = ws.where(touched).withColumn("new", expr)
        delta = _side_pairs(changed, "s", -1).unionAll(_side_pairs(changed, "new"))
        counts = written(_sum_pairs(counts.unionAll(_sum_pairs(delta))).where("freq > 0"), "bpe-pairs")
        ws = ws.withColumn("s", expr)
        rounds += 1
        if rounds % rewrite_every == 0:
            ws = written(ws, "bpe-words")
    return {sd: Tokenizer(merges=merges[sd], vocab=build_vocab(alpha[sd], merges[sd])) for sd in sides}


def corpus_fingerprint(sentences: DataFrame) -> str:
    """Rows and two order-free sums of hashes of all columns: which corpus this is."""
    h = F.xxhash64(*sentences.columns)
    row = sentences.agg(F.count(F.lit(1)), F.sum(F.pmod(h, F.lit((1 << 31) - 1))), F.bit_xor(h)).first()
    return ":".join(str(x) for x in row)


def build_vocab(alpha: list, merges: list) -> dict:
    """Specials 0..7, then the alphabet, then merged tokens by rank (first id wins)."""
    vocab: dict = {}
    for t in list(SPECIAL_TOKENS) + list(alpha) + [l + r for l, r in merges]:
        if t not in vocab:
            vocab[t] = len(vocab)
    return vocab


def vocab_table(spark: SparkSession, tok: Tokenizer) -> DataFrame:
    return tok.vocab_df(spark)


# ----------------------------------------------------------------- encode / decode
def _map_literal(d: dict, key_type: str, value_type: str) -> Column:
    if not d:
        return F.create_map().cast(f"map<{key_type},{value_type}>")
    keys, vals = zip(*d.items())
    return F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[F.lit(v) for v in vals])).cast(
        f"map<{key_type},{value_type}>"
    )


def encode_col(text: Column, tok: Tokenizer) -> Column:
    """Text -> ``array<int>`` of subword ids (row-local; no shuffle); null gives null.

    One Arrow function encodes, evaluated once a row although filters use its result too.
    """
    from bitext.operators import bpe_encode

    return bpe_encode.encode_col(text, tok)


def decode_col(ids: Column, tok: Tokenizer) -> Column:
    """``array<int>`` -> text: special ids dropped, tokens joined, ``</w>`` -> space; null gives null."""
    return T.ustrip(F.replace(_decode_udf(tok)(ids), F.lit(END_OF_WORD), F.lit(" ")))


def _decode_udf(tok: Tokenizer):
    texts = [""] * (max(tok.vocab.values(), default=0) + 2)  # the last one for ids without a token
    for t, i in tok.vocab.items():
        texts[i] = "" if i < N_SPECIAL else t

    @F.arrow_udf("string")
    def dec(rows: pa.Array) -> pa.Array:
        ids = rows.flatten().to_numpy(zero_copy_only=False)
        tokens = pa.array(texts).take(pa.array(np.where((ids >= 0) & (ids < len(texts)), ids, len(texts) - 1)))
        ends = np.cumsum(np.nan_to_num(rows.value_lengths().to_numpy(zero_copy_only=False))).astype(np.int32)
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(np.append(np.int32(0), ends)), tokens), "")
        return pc.if_else(rows.is_valid(), joined, pa.scalar(None, pa.string()))

    return dec


def roundtrip_rate(df: DataFrame, col: str, tok: Tokenizer) -> DataFrame:
    """Share of rows where detok(decode(encode(x))) equals detok(pre-tokens joined)."""
    back = T.detok(decode_col(encode_col(F.col(col), tok), tok))
    ref = T.detok(F.array_join(T.pretokenize(col), " "))
    same = df.select((back == ref).cast("double").alias("same"))
    return same.agg(F.avg("same").alias("rate"), F.count(F.lit(1)).alias("rows"))
