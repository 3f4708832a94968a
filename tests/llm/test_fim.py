import hashlib
import random
import re

import numpy as np
import pytest

from bitext.llm import fim


def brute(doc_id, text):
    """The contract, said plainly."""
    text = text or ""
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        form, out = "plain", text
    elif h4 % 100 < 50:
        form, out = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, out = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    chars = (None, None) if form == "plain" else (len(prefix), len(middle))
    sha = [hashlib.sha256(x.encode()).hexdigest() for x in (out, text)]
    return (doc_id, len(units), form, *chars, *sha)


def corpus(n=300):
    rng = random.Random(5)
    shared = ["".join(rng.choice("abc déf漢😀 \x0b\x1c ") for _ in range(rng.randint(1, 3000))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.4 else rng.choice(["", "x", "<", "<P", "P>", "S>", "line", "\r"]) for _ in range(rng.randint(0, 25))]
        rows.append((i, "".join(p + rng.choice(["\n", "\n", "", "\n\n"]) for p in parts)))
    marked = [(1000 + k, "y" * k + m + "z" * 40) for k in range(0, 1200, 37) for m in ("<P>", "<S>", "<M>")]
    return rows + marked + [(-5, "a\nb"), (None, "no id\nat all\n"), (7, None), (8, ""), (9, "\n"), (10, "no end"), (10, "no end")]


def test_equals_brute_force(spark):
    rows = corpus()
    got = fim.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256", "output"]
    found = got.collect()
    want = [brute(*r) for r in rows]
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert sorted((tuple(r)[:7] for r in found), key=repr) == sorted(want, key=repr)
    assert all(hashlib.sha256(r["output"].encode()).hexdigest() == r["output_sha256"] for r in found)


@pytest.mark.parametrize("limit", [400, 1 << 20])
def test_small_caches_change_nothing(limit):
    cache = fim.ChunkCache(limit)
    for i, text in corpus(60):
        done = fim.transform(i, text, cache)
        assert (done.units, done.form, done.prefix_chars, done.middle_chars) == brute(i, text)[1:5]
        assert fim.restore(done.form, done.output) == (text or "").encode()


def test_shared_passages_are_summarised_once():
    rng = random.Random(1)
    passage = "".join(rng.choice("abcdefgh \n") for _ in range(60_000))
    cache = fim.ChunkCache()
    for k in range(20):  # at other offsets each time
        fim.transform(k, "q" * k + passage + str(k), cache)
    assert cache.misses < 1.5 * len(fim.chunk_ends(np.frombuffer(passage.encode(), np.uint8))) and cache.hits > 15 * cache.misses / 2


def test_chunks_follow_content():
    rng = np.random.default_rng(2)
    data = rng.integers(32, 127, 50_000).astype(np.uint8)
    a = fim.chunk_ends(data)
    b = [e - 100 for e in fim.chunk_ends(np.concatenate([data[:100], data]))]
    assert a[-1] == len(data) and len(set(a) & set(b)) > 0.95 * len(a)
    h = fim.rolling_hash(data)
    want = sum((int(fim._GEAR[data[40 - j]]) << j) for j in range(16)) % 2**32
    assert int(h[40]) == want
    even = fim.chunk_ends(np.full(20_000, 65, np.uint8))
    assert max(np.diff([0, *even])) <= fim.MAX_CHUNK and even[-1] == 20_000


def test_shares_of_forms(spark):
    docs = spark.range(400).selectExpr("id AS doc_id", "'a\nb\nc' AS text")
    forms = [r["form"] for r in fim.fill_in_middle(docs, output=False, fim_per_cent=50, spm_per_cent=0).collect()]
    assert 120 < forms.count("plain") < 280 and "spm" not in forms


def test_edges_of_the_input(spark, edge_docs, no_docs):
    got = fim.fill_in_middle(edge_docs, output=False)
    want = [brute(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert fim.fill_in_middle(no_docs).collect() == []
    clash = edge_docs.selectExpr("doc_id AS key", "text AS body", "doc_id AS n", "text AS form", "lang AS output", "lang AS text", "0 AS doc_id")
    again = fim.fill_in_middle(clash, "key", "body", output=False).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(want, key=repr)
