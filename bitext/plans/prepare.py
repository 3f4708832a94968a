"""Corpus preparation: (sample ->) clean -> word filter -> split (-> token filter),
and the rows left after each stage.

The texts are read and cleaned once: the kept pairs are written to the shared folder,
and every later step (the cuts of the sample and the split in a seeded hash order,
tokenizer training, layout, decoding) reads that table, often only its ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitext.operators import ranking as R
from bitext.operators.clean import MAX_WORDS, clean_kept, clean_pairs, word_count_flag
from bitext.operators.sample import SEED, TRAIN_FRACTION, split_exact
from bitext.session import written

#: Pairs that the sampling stage of the funnel draws (its feature; no other query samples).
SAMPLE_PAIRS = 300_000


def prepare(pairs: DataFrame, num_samples: int | None = None, max_words: int = MAX_WORDS,
            fraction: float = TRAIN_FRACTION, seed=SEED) -> DataFrame:
    """Kept pairs ``(pair_id, src, tgt, split)`` of all pairs, or of ``num_samples`` of them."""
    base = pairs if num_samples is None else R.hash_first_n(pairs, "pair_id", seed, num_samples)
    kept = written(clean_kept(base, max_words), "kept-pairs")
    return split_exact(kept, "pair_id", fraction, seed)


def funnel(pairs: DataFrame, num_samples: int = SAMPLE_PAIRS, max_words: int = MAX_WORDS, seed=SEED,
           encode=None, seq_len: int | None = None) -> DataFrame:
    """``(stage, rows)``: rows left after each stage.

    ``encode(kept)`` adds ``src_ids`` and ``tgt_ids`` to the kept pairs; the token
    stage counts the pairs of each split whose ids fit ``seq_len``.
    """
    # one pass over the texts: every pair with what becomes of it, before and after the sample is drawn
    flagged = clean_pairs(pairs).withColumn("fits", word_count_flag("src", "tgt", max_words))
    short = F.when(F.col("fits"), F.col("src")), F.when(F.col("fits"), F.col("tgt"))
    every = written(flagged.select("pair_id", "fits", short[0].alias("src"), short[1].alias("tgt")), "cleaned-pairs")
    d = R.hash_first_n(every, "pair_id", seed, num_samples, flag="sampled")
    counts = d.agg(
        F.count(F.lit(1)).alias("input"),
        F.count_if(F.col("sampled")).alias("sampled"),
        F.count_if(F.col("sampled") & F.col("fits")).alias("word_filter"),
    ).unpivot([], ["input", "sampled", "word_filter"], "stage", "rows")
    kept = split_exact(d.where(F.col("sampled") & F.col("fits")).drop("sampled", "fits"), "pair_id", TRAIN_FRACTION, seed)
    split = F.col("split")
    stages = {"train": split == "train", "val": split == "val"}
    if encode is not None:
        kept = encode(kept)
        fits = (F.size("src_ids") <= seq_len - 2) & (F.size("tgt_ids") <= seq_len - 2)
        stages |= {"train_tokens": (split == "train") & fits, "val_tokens": (split == "val") & fits}
    late = kept.agg(*[F.count_if(c).alias(n) for n, c in stages.items()]).unpivot([], list(stages), "stage", "rows")
    return counts.unionByName(late).select("stage", F.col("rows").cast("bigint").alias("rows"))
