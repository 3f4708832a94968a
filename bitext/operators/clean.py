"""Row-local cleaning and length filters (Column expressions, fused by codegen)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitext.functions import text as T
from bitext.functions.layout import SEQ_LEN

MAX_WORDS = 40  # fixed value: words of a kept text


def clean_pairs(pairs: DataFrame, noise: str = T.NOISE, src: str = "src", tgt: str = "tgt") -> DataFrame:
    """Delete the noise class from the target side and strip both sides."""
    return pairs.withColumn(tgt, T.clean_noise(tgt, noise)).withColumn(src, T.ustrip(src))


def filter_word_count(pairs: DataFrame, max_words: int = MAX_WORDS, src: str = "src", tgt: str = "tgt") -> DataFrame:
    """Keep ``0 < words(src) <= max_words and 0 < words(tgt) <= max_words``."""
    return pairs.where(word_count_flag(src, tgt, max_words))


def clean_kept(pairs: DataFrame, max_words: int = MAX_WORDS) -> DataFrame:
    """``filter_word_count(clean_pairs(pairs))``, the words counted beside the noise: a filter
    over cleaned texts would clean them a second time."""
    kept = T.has_words("src", max_words) & T.has_words("tgt", max_words, T.NOISE_CHARS)
    return clean_pairs(pairs.where(kept))


def word_count_flag(src: str = "src", tgt: str = "tgt", max_words: int = MAX_WORDS):
    return T.has_words(src, max_words) & T.has_words(tgt, max_words)


def filter_token_length(encoded: DataFrame, seq_len: int = SEQ_LEN,
                        src_ids: str = "src_ids", tgt_ids: str = "tgt_ids") -> DataFrame:
    """Keep pairs whose both sides have at most ``seq_len - 2`` subword ids."""
    limit = seq_len - 2
    return encoded.where((F.size(src_ids) <= limit) & (F.size(tgt_ids) <= limit))


def over_length_col(col: str, max_words: int = MAX_WORDS):
    return T.over_length(col, max_words)


def flag_over_length(df: DataFrame, max_words: int = MAX_WORDS, col: str = "src", out: str = "over_length") -> DataFrame:
    return df.withColumn(out, T.over_length(col, max_words))


def truncate_ids(col, n: int):
    c = F.col(col) if isinstance(col, str) else col
    return F.slice(c, 1, n)


def validate_fit(df: DataFrame, seq_len: int = SEQ_LEN, mode: str = "error",
                 src_ids: str = "src_ids", tgt_ids: str = "tgt_ids"):
    """Rows whose layout would need negative padding.

    ``mode='error'``: all rows, raising at run time on the first bad one;
    ``mode='split'``: ``(fits, rejects)`` as two DataFrames.
    """
    fits = (F.size(src_ids) <= seq_len - 2) & (F.size(tgt_ids) <= seq_len - 1)
    if mode == "split":
        return df.where(fits), df.where(~fits)
    if mode == "error":
        # a filter, as an unused column would be pruned and never raise
        bad = F.raise_error(F.lit(f"source or target text is too long for seq_len={seq_len}")).cast("boolean")
        return df.where(F.when(fits, F.lit(True)).otherwise(bad))
    raise ValueError(mode)
