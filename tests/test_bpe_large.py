"""Training with many merges per job and rank-queue encoding against plain versions."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bitext.operators import bpe as B
from bitext.operators import bpe_encode as BE
from bitext.operators import bpe_train as BT

from conftest import SF001
from test_bpe import PRETOK, py_encode, py_train, texts


def plain_merges(words, n):
    """One merge at a time over counted words (a list of symbols each)."""
    words = [(list(s), c) for s, c in words]
    out = []
    while len(out) < n:
        counts = Counter()
        for s, c in words:
            for p in zip(s, s[1:]):
                counts[p] += c
        if not counts:
            break
        best = min(counts, key=lambda p: (-counts[p], p[0].encode(), p[1].encode()))
        out.append(best)
        words = [(BT.merge_symbols(s, best), c) for s, c in words]
    return out


def table_of(spark, words):
    rows = [("a", w, c) for w, c in words.items()]
    return B.word_symbols(spark.createDataFrame(rows, "side string, word string, freq long")).withColumn("side", F.lit("a")).select("side", "word", "freq", "s")


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("first", [2, 40])
def test_few_letters_equal_plain(spark, seed, first):
    """Few letters and long words give symbols that several merges make, ties and pairs of equal symbols."""
    rng = random.Random(seed)
    letters = "abc"[: 2 + seed % 2]
    words = Counter("".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(150))
    want = plain_merges([([*w[:-1], w[-1] + "</w>"], c) for w, c in words.items()], 60)
    log = []
    got = BT.train_on_words(table_of(spark, words), num_merges=60, first_active=first, log=log)["a"]
    assert got.merges == want
    assert len(log) < 60


@pytest.mark.parametrize("seed", range(300))
def test_rounds_never_take_a_wrong_merge(seed):
    """Merges found on the pieces are a beginning of the plain trainer's, whatever was cut away."""
    rng = random.Random(seed)
    words = Counter("".join(rng.choice("ab" if seed % 3 else "abcd") for _ in range(rng.randint(2, 18))) for _ in range(60))
    counted = [(list(w), c * rng.randint(1, 9)) for w, c in words.items()]
    counts = Counter()
    for s, c in counted:
        for p in zip(s, s[1:]):
            counts[p] += c
    ranked = sorted(counts, key=lambda p: (-counts[p], p))
    n = rng.randint(1, len(ranked))
    floor = counts[ranked[n]] if n < len(ranked) else 0
    active = {p for p in ranked[:n] if counts[p] > floor}
    pieces = Counter()
    for s, c in counted:
        start = 0
        for i in range(1, len(s) + 1):
            if i == len(s) or (s[i - 1], s[i]) not in active:
                if i - start > 1:
                    pieces[tuple(s[start:i])] += c
                start = i
    got = BT.merges_of_round(list(pieces.items()), floor, set("abcd"), 40)
    assert got == plain_merges(counted, 40)[: len(got)]


def test_conversations_equal_plain(spark):
    df, t = texts(spark)
    words = B.side_words(df.select(F.lit("x").alias("side"), F.col("text")))
    log = []
    tok = BT.train_on_words(words, num_merges=400, log=log)["x"]
    assert tok.merges == py_train(t, 400)
    assert len(log) < 20
    # few pieces at a time change nothing
    assert BT.train_on_words(words, num_merges=60, max_pieces=50)["x"].merges == tok.merges[:60]
    assert tok.vocab == B.build_vocab(sorted({s for w in {w for x in t for w in PRETOK.findall(x)} for s in [*w[:-1], w[-1] + "</w>"]}, key=str.encode), tok.merges)


def test_vocabulary_size_and_ends(spark):
    words = table_of(spark, Counter({"aab": 3, "ab": 2}))
    tok = BT.train_on_words(words, vocab_size=B.N_SPECIAL + 2 + 1)["a"]
    assert len(tok.merges) == 1 and len(tok.vocab) == B.N_SPECIAL + 3
    assert BT.train_on_words(words, vocab_size=16_000)["a"].merges == plain_merges([(["a", "a", "b</w>"], 3), (["a", "b</w>"], 2)], 99)
    assert BT.train_on_words(words.limit(0)) == {}


def scan_encode(word, ranks, vocab):
    s = [*word[:-1], word[-1] + "</w>"] if word else []
    while True:
        found = [(ranks[p], p) for p in zip(s, s[1:]) if p in ranks]
        if not found:
            return [vocab.get(x, 0) for x in s]
        s = BT.merge_symbols(s, min(found)[1])


def test_rank_queue_equals_scan():
    rng = random.Random(9)
    for _ in range(400):
        pool = list("ab") + ["a</w>", "b</w>"]
        merges = []
        for _ in range(rng.randint(0, 25)):
            pair = (rng.choice([p for p in pool if "<" not in p]), rng.choice(pool))
            merges.append(pair)
            pool.append(pair[0] + pair[1])
        rng.shuffle(merges)
        ranks = {p: i for i, p in enumerate(merges)}
        vocab = {t: i for i, t in enumerate(pool)}
        for _ in range(10):
            word = "".join(rng.choice("abc" if rng.random() < 0.1 else "ab") for _ in range(rng.randint(0, 30)))
            assert BE.encode_word(word, ranks, vocab) == scan_encode(word, ranks, vocab)


def test_long_words_take_no_scan_per_merge():
    ranks = {("a", "a"): 0, ("aa", "aa"): 1, ("aaaa", "aaaa"): 2}
    assert len(BE.encode_word("a" * 200_001, ranks, {})) == 200_000 // 8 + 1


def test_column_equals_plain_encoder(spark):
    df, t = texts(spark)
    tok = B.train_bpe(df, num_merges=60)
    rows = df.select("text", BE.encode_col(F.col("text"), tok).alias("ids")).collect()
    assert all(r["ids"] == py_encode(r["text"], tok) for r in rows)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "  "), (4, "漢字 \U0001f600 zz"), (5, None)], "k int, text string").coalesce(1)
    got = {r["k"]: r["ids"] for r in odd.select("k", BE.encode_col(F.col("text"), tok).alias("ids")).collect()}
    assert got == {1: None, 2: [], 3: [], 4: py_encode("漢字 \U0001f600 zz", tok), 5: None}
    encoder = BE.WordEncoder(tok, cache_bytes=0)
    import pyarrow as pa

    lists = [PRETOK.findall(x) for x in t[:40]] + [None, []]
    assert encoder(pa.array(lists, pa.list_(pa.string()))).to_pylist() == [None if x is None else py_encode(" ".join(x), tok) for x in lists]
    assert encoder(pa.array(lists, pa.list_(pa.string())).slice(3, 5)).to_pylist() == [py_encode(" ".join(x), tok) for x in lists[3:8]]


def test_registered_queries(spark):
    from bitext.plans.catalog import QUERIES

    merges = QUERIES["bpe_train_16k"](spark, SF001)
    assert merges.columns == ["side", "rank", "left_tok", "right_tok"]
    ids = QUERIES["bpe_encode_16k"](spark, SF001)
    assert ids.columns == ["pair_id", "split", "src_ids", "tgt_ids"]
    from bitext.plans.q_prepare import kept_split

    kept = kept_split(spark, SF001)
    train = {side: [r[side] for r in kept.where("split = 'train'").select(side).collect()] for side in ("src", "tgt")}
    rows = merges.collect()
    for side in train:
        own = [(r["left_tok"], r["right_tok"]) for r in sorted(rows, key=lambda r: r["rank"]) if r["side"] == side]
        words = Counter(w for x in train[side] for w in PRETOK.findall(x))
        assert own[:120] == plain_merges([([*w[:-1], w[-1] + "</w>"], c) for w, c in words.items()], 120)
        assert 3_000 < len(own) < 16_000
        ranks = {p: i for i, p in enumerate(own)}
        alphabet = sorted({s for w in words for s in [*w[:-1], w[-1] + "</w>"]}, key=str.encode)
        vocab = B.build_vocab(alphabet, own)
        for r in ids.join(kept.drop("split"), "pair_id").limit(300).collect():
            assert r[f"{side}_ids"] == [i for w in PRETOK.findall(r[side]) for i in scan_encode(w, ranks, vocab)]
