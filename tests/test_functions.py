"""Hand-made goldens for the Column-level helpers (values worked out by hand)."""

import math

from pyspark.sql import functions as F

from bitext.functions import layout as L
from bitext.functions import text as T
from bitext.functions import vectors as V
from bitext.operators import decode as D


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def test_clean_noise_arabic(spark):
    assert one(spark, T.clean_noise(F.lit("aـbْ"))) == "ab"
    # tatweel and diacritics vanish, surrounding Unicode space is stripped
    assert one(spark, T.clean_noise(F.lit(" مَرْحَبًا "))) == "مرحبا"


def test_detok(spark):
    s = "he said ( ok ) , yes ؟ « x »"
    assert one(spark, T.detok(F.lit(s))) == "he said (ok), yes؟ «x»"


def test_pretokenize_and_strip(spark):
    assert one(spark, T.pretokenize(F.lit("héllo wörld, ok"))) == ["héllo", "wörld", ",", "ok"]
    assert len(one(spark, T.ustrip(F.lit("   héllo  wörld, ok\t\n")))) == 16
    assert one(spark, T.word_count(F.lit(" a b  c\n"))) == 3


def test_layout_arrays(spark):
    ids = F.array(F.lit(10), F.lit(11))
    assert one(spark, L.encoder_input(ids, 6)) == [5, 10, 11, 4, 1, 1]
    assert one(spark, L.decoder_input(ids, 6)) == [5, 10, 11, 1, 1, 1]
    assert one(spark, L.labels(ids, 6)) == [10, 11, 4, 1, 1, 1]
    assert one(spark, L.causal_mask(3)) == [[True, False, False], [True, True, False], [True, True, True]]
    dm = one(spark, L.decoder_mask(F.array(*[F.lit(x) for x in [5, 7, 1]])))
    assert dm == [[True, False, False], [True, True, False], [True, True, False]]


def test_ngram_block(spark):
    seq = "array('5', '7', '8', '9', '7', '8')"
    assert sorted(one(spark, D.banned_tokens(seq, 3))) == ["9"]
    assert one(spark, D.banned_tokens(seq, 0)) == []
    assert sorted(one(spark, D.banned_tokens(seq, 1))) == ["5", "7", "8", "9"]
    assert one(spark, D.banned_tokens("array('5')", 3)) == []


def test_schedules(spark):
    assert math.isclose(one(spark, V.lr_schedule(F.lit(3999), 3e-4, 4000)), 3e-4)
    assert math.isclose(one(spark, V.lr_schedule(F.lit(15999), 3e-4, 4000)), 1.5e-4)
    assert one(spark, V.length_penalty(F.lit(1), 0.6)) == 1.0
    assert math.isclose(one(spark, V.length_penalty(F.lit(7), 1.0)), 2.0)


def test_vectors(spark):
    pe = one(spark, V.positional(F.lit(0), 8))
    assert pe == [0.0, 1.0] * 4
    ln = one(spark, V.layer_norm(F.array(F.lit(1.0), F.lit(3.0))))
    assert all(math.isclose(a, b, abs_tol=1e-5) for a, b in zip(ln, [-1.0, 1.0]))
    sm = one(spark, V.softmax(F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0))))
    assert math.isclose(sum(sm), 1.0)
    lsm = one(spark, V.log_softmax(F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0))))
    assert all(math.isclose(math.exp(a), b) for a, b in zip(lsm, sm))
    heads = one(spark, V.split_heads(F.array(*[F.lit(float(i)) for i in range(8)]), 4))
    assert heads == [[0.0, 1.0], [2.0, 3.0], [4.0, 5.0], [6.0, 7.0]]
