"""Fixed-length model rows as array expressions (SOS/EOS/PAD layout and masks).

Masks are kept as predicates where possible: pads are a suffix, so a row's
padding mask is fully described by its valid length, and the causal mask is
``c <= r``.  Materialised mask arrays are offered for callers that need them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bitext.config import EOS_ID, PAD_ID, SOS_ID

SEQ_LEN = 160  # fixed value: positions of a model row


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _i(x: int) -> Column:
    return F.lit(x).cast("int")


def _pads(n: Column) -> Column:
    return F.array_repeat(_i(PAD_ID), F.greatest(n, F.lit(0)))


def encoder_input(ids, seq_len: int) -> Column:
    """``[SOS] + ids + [EOS] + PAD * (S - len - 2)``."""
    ids = _c(ids)
    return F.concat(F.array(_i(SOS_ID)), ids, F.array(_i(EOS_ID)), _pads(F.lit(seq_len) - F.size(ids) - 2))


def decoder_input(ids, seq_len: int) -> Column:
    """``[SOS] + ids + PAD * (S - len - 1)``."""
    ids = _c(ids)
    return F.concat(F.array(_i(SOS_ID)), ids, _pads(F.lit(seq_len) - F.size(ids) - 1))


def labels(ids, seq_len: int) -> Column:
    """``ids + [EOS] + PAD * (S - len - 1)``."""
    ids = _c(ids)
    return F.concat(ids, F.array(_i(EOS_ID)), _pads(F.lit(seq_len) - F.size(ids) - 1))


def padding_mask(arr) -> Column:
    """True where the id is not PAD."""
    return F.transform(_c(arr), lambda x: x != PAD_ID)


def valid_len(arr) -> Column:
    """Number of non-PAD positions (pads are a suffix of every layout array)."""
    return F.size(F.filter(_c(arr), lambda x: x != PAD_ID)).cast("int")


def causal_mask(size) -> Column:
    """Lower triangle including the diagonal, ``size`` x ``size``."""
    n = F.lit(size) if isinstance(size, int) else _c(size)
    rng = F.sequence(F.lit(0), n - 1)
    return F.transform(rng, lambda r: F.transform(rng, lambda c: c <= r))


def decoder_mask(dec_input) -> Column:
    """Causal AND key-not-PAD; PAD query rows keep their causal part."""
    d = _c(dec_input)
    rng = F.sequence(F.lit(0), F.size(d) - 1)
    return F.transform(rng, lambda r: F.transform(rng, lambda c: (c <= r) & (F.element_at(d, c + 1) != PAD_ID)))


def next_token_pairs(ids) -> Column:
    """``array<struct<prev,next>>``: each label paired with the decoder input before it."""
    d = _c(ids)
    n = F.greatest(F.size(d) - 1, F.lit(0))  # no lambda, which would evaluate ``d`` for each element
    return F.arrays_zip(F.slice(d, 1, n).alias("prev"), F.slice(d, 2, n).alias("next"))


def ngrams(seq, n: int) -> Column:
    """All n-grams of a sequence as ``array<array<…>>`` (empty when shorter than n)."""
    s = _c(seq)
    return F.when(
        F.size(s) >= n,
        F.transform(F.sequence(F.lit(1), F.size(s) - n + 1), lambda i: F.slice(s, i, n)),
    ).otherwise(F.array_repeat(F.slice(s, 1, 0), 0))
