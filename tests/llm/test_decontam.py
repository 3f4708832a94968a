import random

import numpy as np

from bitext.llm import decontam as D


def brute(docs, items):
    """The best window of an item's length over every start, by shingle counts."""
    found = {}
    for doc_id, text in docs:
        words = D.words_of(text)
        for item_id, item in items:
            want = D.words_of(item)
            if not words or not want:
                continue
            size = min(len(want), len(words))
            best = max(D.similarity(words[p : p + size], want) for p in range(len(words) - size + 1))
            if best >= 0.8:
                found[doc_id, item_id] = best
    return found


def planted():
    rng = random.Random(8)
    vocab = [f"v{i}" for i in range(500)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(text(rng.randint(8, 70)))) for i in range(30)] + [(90, "three small words"), (91, ""), (92, None)]
    docs = []
    for i in range(80):
        words = text(rng.randint(0, 200))
        if i % 2:
            copy = items[rng.randrange(30)][1].split()
            for _ in range(rng.randint(0, 3)):
                copy[rng.choice([0, 1, -1, -2, rng.randrange(len(copy))])] = rng.choice(vocab)
            if i % 5 == 0:
                copy = [w.upper() + "," for w in copy]
            at = rng.randint(0, len(words))
            words[at:at] = copy
        docs.append((i, " ".join(words)))
    docs += [(200, "x three small words y"), (201, "three small"), (202, None), (203, ""), (204, items[0][1]), (205, items[3][1] + " " + items[3][1])]
    return docs, items


def test_equals_brute_force(spark):
    docs, items = planted()
    got = D.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    want = brute(docs, items)
    assert len(want) > 25
    assert {(r["doc_id"], r["item_id"]): round(r["similarity"], 9) for r in got} == {k: round(v, 9) for k, v in want.items()}


def test_chunks_of_items_give_the_same(spark, monkeypatch):
    docs, items = planted()
    monkeypatch.setattr(D.chunks, "__defaults__", (200,))
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    marks = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
    assert len(list(D.chunks(marks, "item_id", "text"))) > 5
    want = brute(docs, items)
    assert {(r["doc_id"], r["item_id"]) for r in D.contaminated(table, marks).collect()} == set(want)
    clean = D.keep_clean(table, marks)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, _ in docs} - {i for i, _ in want}


def test_multi_index_finds_all_within_the_radius():
    rng = np.random.default_rng(1)
    held = rng.integers(0, 2**63, 300, dtype=np.uint64)
    ask = held[rng.integers(0, 300, 200)].copy()
    for k in range(len(ask)):
        for b in rng.choice(64, rng.integers(0, 30), replace=False):
            ask[k] ^= np.uint64(1) << np.uint64(b)
    query, member = D.MultiIndex(held).within(ask)
    near = np.bitwise_count(ask[:, None] ^ held[None]) <= D.RADIUS
    assert set(zip(query.tolist(), member.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(near))))


def test_index_selects_and_stays_bounded():
    """10,000 items of one size against 2,048 windows: every true pair, a tenth of the items looked at, few cells at once."""
    rng = np.random.default_rng(2)
    held = rng.integers(0, 2**64, 10_000, dtype=np.uint64)
    held[5_000:5_010] = held[4_000]  # repeated items
    ask = np.concatenate([held[::50], rng.integers(0, 2**64, 1_848, dtype=np.uint64)])
    index = D.MultiIndex(held)
    seen = np.zeros((64, len(index.fps)), bool)
    for query, entry in index.candidates(ask[:64]):
        seen[query, entry] = True
    assert seen.mean() < 0.12
    assert max(len(q) for q, _ in index.candidates(ask)) <= D.CELLS + len(held)
    query, member = index.within(ask)
    got = set(zip(query.tolist(), member.tolist()))
    for at in range(0, len(ask), 256):
        near = np.nonzero(np.bitwise_count(ask[at : at + 256, None] ^ held[None]) <= D.RADIUS)
        want = {(at + a, b) for a, b in zip(*(x.tolist() for x in near))}
        assert {(a, b) for a, b in got if at <= a < at + 256} == want


def test_index_looks_near_values_up_in_large_tables():
    rng = np.random.default_rng(4)
    held = rng.integers(0, 2**64, 20_000, dtype=np.uint64)
    index = D.MultiIndex(held)
    assert any(len(near) < len(values) for _, _, _, values, near in index.blocks)
    ask = rng.integers(0, 2**64, 40, dtype=np.uint64)
    query, member = index.within(ask)
    near = np.bitwise_count(ask[:, None] ^ held[None]) <= D.RADIUS
    assert set(zip(query.tolist(), member.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(near))))


def test_radius_holds_nearly_all_windows_at_the_least_similarity():
    rng = random.Random(6)
    vocab = [b"w%d" % i for i in range(5_000)]
    inside = total = 0
    while total < 1_500:
        item = [rng.choice(vocab) for _ in range(rng.randint(14, 120))]
        window, changed = item, False
        for _ in range(11):  # words changed as long as the similarity allows it
            other = list(window)
            other[rng.choice([0, -1, rng.randrange(len(item))])] = rng.choice(vocab)
            if D.similarity(item, other) >= D.SIMILARITY:
                window, changed = other, True
        if changed:
            a, b = (D.Finder._fingerprint(D._hash(w)) for w in (item, window))
            inside += (a ^ b).bit_count() <= D.RADIUS
            total += 1
    assert inside >= 0.99 * total


def test_edges_of_the_input(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog near the old river"), (None, "unfindable words of an item without id")], "item_id long, text string")
    got = D.contaminated(edge_docs, items).collect()
    assert sorted(r["doc_id"] for r in got) == [1, 5, 5]
    kept = D.keep_clean(edge_docs, items)
    assert kept.columns == edge_docs.columns and kept.count() == 6
    assert D.contaminated(no_docs, items).collect() == []
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contaminated(edge_docs, none).collect() == [] and D.keep_clean(edge_docs, none).count() == 9
