"""BPE on Spark against a plain Python one-merge-at-a-time trainer."""

from collections import Counter

import regex
from pyspark.sql import functions as F

from bitext.operators import bpe as B

from conftest import SF001

PRETOK = regex.compile(r"\w+|[^\w\s]+")


def py_train(texts, num_merges):
    words = Counter(w for t in texts for w in PRETOK.findall(t))
    seqs = {w: list(w[:-1]) + [w[-1] + "</w>"] for w in words}
    merges = []
    for _ in range(num_merges):
        pc = Counter()
        for w, f in words.items():
            s = seqs[w]
            for a, b in zip(s, s[1:]):
                pc[(a, b)] += f
        if not pc:
            break
        best = sorted(pc.items(), key=lambda x: (-x[1], x[0][0].encode(), x[0][1].encode()))[0][0]
        merges.append(best)
        for w in words:
            s, out, i = seqs[w], [], 0
            while i < len(s):
                if i + 1 < len(s) and s[i] == best[0] and s[i + 1] == best[1]:
                    out.append(s[i] + s[i + 1])
                    i += 2
                else:
                    out.append(s[i])
                    i += 1
            seqs[w] = out
    return merges


def texts(spark):
    c = spark.read.parquet(f"{SF001}/conversations.parquet").select(F.col("text"))
    return c, [r["text"] for r in c.collect()]


def test_train_matches_one_at_a_time(spark):
    df, t = texts(spark)
    tok = B.train_bpe(df, num_merges=60)
    assert tok.merges == py_train(t, 60)
    # specials first, then the alphabet, then merges
    assert tok.vocab["[UNK]"] == 0 and tok.vocab["[PAD]"] == 1 and tok.vocab["[EOS]"] == 4 and tok.vocab["[SOS]"] == 5


def py_encode(text, tok):
    """Merges of a word in rank order, each wherever it occurs."""
    out = []
    for word in PRETOK.findall(text):
        s = list(word[:-1]) + [word[-1] + "</w>"]
        for l, r in tok.merges:
            i = 0
            while i < len(s) - 1:
                if (s[i], s[i + 1]) == (l, r):
                    s[i : i + 2] = [l + r]
                i += 1
        out += [tok.vocab.get(x, 0) for x in s]
    return out


def test_encode_and_decode(spark):
    df, t = texts(spark)
    for n in (0, 40):
        tok = B.train_bpe(df, num_merges=n)
        rows = df.select("text", B.encode_col(F.col("text"), tok).alias("ids")).collect()
        assert all(r["ids"] == py_encode(r["text"], tok) for r in rows)
    back = [r["x"] for r in df.select(B.decode_col(B.encode_col(F.col("text"), tok), tok).alias("x")).collect()]
    # every training word is covered by the alphabet: decoding gives the pre-tokens back
    for src, got in zip(t[:50], back[:50]):
        assert got.split() == PRETOK.findall(src)
    nulls = spark.createDataFrame([(None,), ("",)], "text string")
    assert [tuple(r) for r in nulls.select(B.encode_col(F.col("text"), tok).alias("i")).withColumn("d", B.decode_col(F.col("i"), tok)).collect()] == [(None, None), ([], "")]


def test_several_hundred_merges(spark):
    df, t = texts(spark)
    assert B.train_bpe(df, num_merges=200).merges == py_train(t, 200)


def test_fingerprint_tells_corpora_apart(spark):
    df, _ = texts(spark)
    assert B.corpus_fingerprint(df) == B.corpus_fingerprint(df.orderBy(F.desc("text")))
    assert B.corpus_fingerprint(df) != B.corpus_fingerprint(df.limit(3))
    assert B.train_bpe(df.limit(0), num_merges=5).merges == []


def test_sides_trained_together_equal_alone(spark):
    df, t = texts(spark)
    a = df.select(F.lit("a").alias("side"), F.col("text"))
    b = df.select(F.lit("b").alias("side"), F.upper(F.col("text")).alias("text"))
    both = B.train_bpe_sides(a.unionByName(b), num_merges=30)
    assert both["a"].merges == py_train(t, 30)
    assert both["b"].merges == py_train([x.upper() for x in t], 30)
    assert both["b"].vocab == B.train_bpe(b.select("text"), num_merges=30).vocab
