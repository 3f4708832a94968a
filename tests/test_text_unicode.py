"""Text patterns against Python strings and the public tokenizer library."""

import pytest
from tokenizers.pre_tokenizers import Whitespace

from bitext.functions import text as T

TEXTS = ["a b", "a‌b c‍", "x² y₂", "a\x1cb", "a\x85b", "Ⅷ ⅷ①ⓐⒶ", "naïve ét", "نص عَرَبِيّ ـ", "漢字かな", "a_b‿c", "1½ ٣", " x　y z", "🙂a", "a​b", "«x»!", " \t\x0b\x0c\r\nq", "🅰🄰x", "", "﻿z"]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")


def test_pretokenize_equals_the_library(df):
    lib = Whitespace()
    got = {r["i"]: r["p"] for r in df.select("i", T.pretokenize("t").alias("p")).collect()}
    for i, t in enumerate(TEXTS):
        assert got[i] == [w for w, _ in lib.pre_tokenize_str(t)], ascii(t)


def test_strip_and_words_equal_python(df):
    for r in df.select("i", T.ustrip("t").alias("s"), T.words("t").alias("w"), T.word_count("t").alias("n")).collect():
        t = TEXTS[r["i"]]
        assert (r["s"], r["w"], r["n"]) == (t.strip(), t.split(), len(t.split())), ascii(t)


def test_detok_takes_unicode_space(spark):
    df = spark.createDataFrame([("a !",), ("( a \x1c)",), ("he said ( ok ) , yes ؟ « x »",)], "t string")
    assert [r["d"] for r in df.select(T.detok("t").alias("d")).collect()] == ["a!", "(a)", "he said (ok), yes؟ «x»"]


def test_word_bounds_by_pattern_equal_counting(spark):
    texts = TEXTS + ["w " * n for n in (0, 1, 39, 40, 41, 5000)] + ["\n".join(["w"] * 40) + "\n", "\u2028a\u2028", None, "x" * 100_000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r["h"] for r in df.select(T.has_words("t", 40).alias("h")).collect()]
    assert got == [None if t is None else 1 <= len(t.split()) <= 40 for t in texts]
