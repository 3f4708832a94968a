import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from bitext.llm import collocations as C

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_count, top=2000):
    """The contract, said plainly."""
    n, f = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    candidates = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    out = []
    for (lang, phrase), a in candidates.items():
        inside = [
            b for (other, long), b in candidates.items()
            if other == lang and len(long) > len(phrase) and any(long[i : i + len(phrase)] == phrase for i in range(len(long)))
        ]
        if any(100 * b >= 80 * a for b in inside):
            continue
        cuts = [(f[lang, phrase[:k]], f[lang, phrase[k:]]) for k in range(1, len(phrase))]
        score, k = min((int(Fraction(2_000_000 * a, x + y)), k) for k, (x, y) in enumerate(cuts))
        out.append((lang, " ".join(phrase), a, *cuts[k], n[lang], score))
    ranked = []
    for lang in {o[0] for o in out}:
        best = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))[:top]
        ranked += [(o[0], i + 1, *o[1:]) for i, o in enumerate(best)]
    return sorted(ranked)


def corpus(n=1200, seed=3):
    rng = random.Random(seed)
    vocab = ["The", "of", "é", "New", "York", "city", "x\x1cy", "b c", "漢字", "\x01", "a"] + [f"w{i}" for i in range(30)]
    rows = []
    for i in range(n):
        words = [rng.choice(vocab[: rng.choice([6, 41])]) for _ in range(rng.randint(0, 30))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "\x0b"]) for w in words)
        rows.append((rng.choice(["en", "de", None, "und"]), text + rng.choice(["", " New York City hall", "!"])))
    return rows + [("en", None), ("en", ""), (None, " \t.,\n"), ("fr", "New York " * 40)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.mark.parametrize("limits", [
    {}, {"broadcast_words": 7}, {"broadcast_words": 0, "shard_grams": 50, "bucket_grams": 5}, {"bitmap_bits": 8, "top": 11},
])
def test_equals_brute_force(spark, rows, limits):
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = C.mine(docs, min_count=12, **limits)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute(rows, 12, limits.get("top", 2000))
    assert len(want) > 30
    assert sorted(tuple(r) for r in got.collect()) == want


@pytest.mark.parametrize(("size", "width"), [(2, 16), (3, 17), (4, 16), (4, 19), (3, 31), (4, 31)])
def test_packing_and_filters_lose_nothing(size, width):
    rng = np.random.default_rng(size * width)
    packing = C.Packing(size, width)
    ids = [rng.integers(1, 1 << width, 5000).astype(np.int32) for _ in range(size)]
    ids = [np.concatenate([x, x[:700], np.full(400, x[3])]) for x in ids]
    high, low = packing.permute(*packing.pack(ids))
    assert int(max(high.max(), low.max())) < 1 << packing.half
    back = packing.unpack(*packing.restore(high, low))
    assert all(np.array_equal(a, b) for a, b in zip(back, ids))
    want = Counter(zip(*[x.tolist() for x in ids]))
    got = Counter()
    for bits in (0, 5):
        got.clear()
        h, l, c = C.count_sorted(packing, high.copy(), low.copy())
        bucket = (h >> np.uint64(packing.half - bits)).astype(int)
        for b in np.unique(bucket):
            here = bucket == b
            data = C.to_filter(packing, bits, h[here], l[here], c[here])
            keys = C.from_filter(packing, bits, int(b), data)
            for *gram, n in zip(*packing.unpack(*packing.restore(*keys[:2])), keys[2]):
                got[tuple(int(x) for x in gram)] += int(n)
        assert got == want and max(want.values()) > 400


def test_filters_are_compact():
    rng = np.random.default_rng(1)
    packing = C.Packing(2, 18)
    high, low = packing.permute(*packing.pack([rng.integers(1, 1 << 18, 100_000), rng.integers(1, 1 << 18, 100_000)]))
    h, l, c = C.count_sorted(packing, high, low)
    assert len(C.to_filter(packing, 0, h, l, c)) < 8 * len(h)  # a plain table takes 16 bytes


def test_scores_are_exact_beyond_64_bits(spark):
    a, n = 6_000_000_000_000, 9_000_000_000_001  # 2,000,000 a passes 2^63
    got = spark.sql(f"SELECT (cast({C.SCORE_UNIT} as decimal(8,0)) * cast({a}L as decimal(19,0))) div (cast({n}L as decimal(19,0)) + cast({n}L as decimal(19,0))) AS s").first()[0]
    assert int(got) == 2_000_000 * a // (2 * n)


def test_edges_of_the_input(spark, edge_docs, no_docs):
    rows = [(r["lang"], r["text"]) for r in edge_docs.collect()]
    got = C.mine(edge_docs, min_count=3)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 3)
    assert C.mine(no_docs).collect() == []
    clash = edge_docs.selectExpr("lang AS language", "text AS body", "doc_id AS ids", "doc_id AS word", "doc_id AS lang")
    assert sorted(tuple(r) for r in C.mine(clash, "language", "body", min_count=3).collect()) == brute(rows, 3)
