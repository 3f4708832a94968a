"""Tokens, counts and ids by whole batches against the plain versions."""

import random
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from bitext.functions import layout as L
from bitext.functions import pretoken as P
from bitext.functions import text as T
from bitext.operators import bpe as B
from bitext.operators import bpe_encode as BE
from bitext.operators import bpe_train as BT
from bitext.operators import clean as C
from bitext.operators import decode as D

from bitext.session import written

from conftest import SF001
from test_text_unicode import TEXTS


def odd_texts(n=400):
    rng = random.Random(3)
    return TEXTS + [None] + ["".join(rng.choice("ab é漢🙂.,_ \x85́\n") for _ in range(rng.randint(0, 12))) for _ in range(n)] + [None]


def test_pretokens_of_batches_equal_the_pattern(spark):
    df = spark.createDataFrame([(t,) for t in odd_texts()], "t string").coalesce(1)
    for r in df.select("t", T.pretokenize("t").alias("a"), P.pretokens("t").alias("b")).collect():
        assert r["a"] == r["b"], ascii(r["t"])
    found = P.find(pa.array(TEXTS + [None]).slice(4, 6))
    assert len(found.word_bounds()) == 7 and found.words().to_pylist()[0] == "a"
    assert P.find(pa.array([], pa.string())).words().to_pylist() == []


def test_passes_over_batches_equal_the_rank_queue():
    """Few letters: runs of one symbol, unknown characters, and merges whose text several ways give."""
    rng, flat = random.Random(4), Counter()
    for _ in range(300):
        pool = ["a", "b", "é", "a</w>", "b</w>", "é</w>"]
        merges = []
        for _ in range(rng.randint(0, 8)):
            merges.append((rng.choice([p for p in pool if "<" not in p]), rng.choice(pool)))
            pool.append("".join(merges[-1]))
        tok = B.Tokenizer(merges, B.build_vocab(pool[:6], merges))
        texts = [None, "", *(" ".join("".join(rng.choice("abéx" if rng.random() < 0.1 else "abé") for _ in range(rng.randint(0, 9))) for _ in range(4)) for _ in range(20)), "aaaaa aaaa"]
        ranks = {}
        for i, p in enumerate(merges):
            ranks.setdefault(p, i)
        if BE.FlatEncoder.fits(tok):
            flat["yes"] += 1
            want = [None if t is None else [i for w in t.split() for i in BE.encode_word(w, ranks, tok.vocab)] for t in texts]
            assert BE.FlatEncoder(tok)(pa.array(texts)).to_pylist() == want
        else:
            flat["no"] += 1
    assert min(flat.values()) > 30 and len(flat) == 2
    twice = [("a", "b"), ("ab", "c"), ("b", "c"), ("a", "bc")]
    assert not BE.FlatEncoder.fits(B.Tokenizer(twice, B.build_vocab(["a", "b", "c"], twice)))


def test_encoding_has_no_regex_step_per_token(spark):
    df = spark.createDataFrame([("ab ab",)], "t string")
    tok = B.Tokenizer([("a", "b</w>")], B.build_vocab(["a", "b</w>"], [("a", "b</w>")]))
    out = df.select(B.encode_col(F.col("t"), tok).alias("ids"))
    assert out.first()["ids"] == [10, 10]
    assert "regexp" not in out._jdf.queryExecution().toString()


def test_few_merges_ask_for_few_pairs(spark):
    rng = random.Random(5)
    words = Counter("".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(2, 9))) for _ in range(400))
    table = B.word_symbols(spark.createDataFrame(list(words.items()), "word string, freq long")).withColumn("side", F.lit("a"))
    log = []
    few = BT.train_on_words(table, num_merges=3, log=log)["a"].merges
    assert few == BT.train_on_words(table, num_merges=30)["a"].merges[:3]
    assert log[0]["a"][1] <= BT.ACTIVE_A_MERGE * 3


def test_words_and_neighbours_counted_in_batches(spark):
    texts = odd_texts(60)
    df = spark.createDataFrame([(("x", "y", None)[i % 3], t) for i, t in enumerate(texts)], "side string, text string")
    want = Counter((r["side"], r["w"]) for r in df.select("side", F.explode(T.pretokenize("text")).alias("w")).collect())
    assert {(r["side"], r["word"]): r["freq"] for r in B.side_words(df).collect()} == want
    seqs = [["a", "b", "a", "b"], [], None, ["b"], ["b", None, "b"], ["c", "a"]]
    got = D.bigram_scores(spark.createDataFrame([(s,) for s in seqs], "tokens array<string>")).collect()
    assert {(r["prev"], r["token"]): r["cnt"] for r in got} == {("a", "b"): 2, ("b", "a"): 1, ("b", None): 1, ("c", "a"): 1}


def test_words_are_counted_beside_the_noise(spark):
    """The filter before the cleaning keeps what the filter after it kept, and cleans once."""
    rng = random.Random(6)
    texts = ["", "ـ", " ـ ـ", "aـ ـ b", "ـa b ـ", "a b c", "a ـb\x1cc", None, *("".join(rng.choice("ab ـِ ") for _ in range(rng.randint(0, 9))) for _ in range(300))]
    pairs = spark.createDataFrame([(i, s, t) for i, (s, t) in enumerate(zip(texts[::-1], texts))], "pair_id long, src string, tgt string")
    for most in (1, 2, 40):
        got = C.clean_kept(pairs, most)
        assert sorted(got.collect()) == sorted(C.filter_word_count(C.clean_pairs(pairs), most).collect())
    assert got._jdf.queryExecution().optimizedPlan().toString().count("regexp_replace") == 1


def test_neighbours_of_texts_equal_those_of_their_tokens(spark):
    df = spark.createDataFrame([(t,) for t in odd_texts(60)], "t string")
    seqs = df.where("t IS NOT NULL").select(F.concat(F.array(F.lit(D.SOS)), T.pretokenize("t"), F.array(F.lit(D.EOS))).alias("tokens"))
    texts = D.bigram_scores(df, "t")
    assert sorted(texts.collect()) == sorted(D.bigram_scores(seqs).collect())
    want = Counter(p for r in seqs.collect() for p in zip(r["tokens"], r["tokens"][1:]))
    assert {(r["prev"], r["token"]): r["cnt"] for r in texts.collect()} == want
    plan = texts._jdf.queryExecution().toString()
    assert "Join" not in plan and "regexp" not in plan


def test_next_token_pairs_evaluate_their_sequence_no_element_at_a_time(spark):
    rows = [[5, 9, 8, 4], [5, 4], [5], [], None]
    df = spark.createDataFrame([(r,) for r in rows], "ids array<int>")
    out = df.select("ids", L.next_token_pairs(F.concat("ids", F.array().cast("array<int>"))).alias("p"))
    for r in out.collect():
        want = None if r["ids"] is None else list(zip(r["ids"], r["ids"][1:]))
        assert (None if r["p"] is None else [(p["prev"], p["next"]) for p in r["p"]]) == want
    assert "lambda" not in out._jdf.queryExecution().toString()


def test_vocab_lookup_prepares_pairs_once(spark, monkeypatch):
    from bitext.plans import prepare, q_misc

    seen = []
    monkeypatch.setattr(prepare, "written", lambda df, name: (seen.append(name), written(df, name))[1])
    q_misc.q_vocab_lookup(spark, SF001)
    assert seen == ["kept-pairs"]
