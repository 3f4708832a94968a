import hashlib
import random

import numpy as np
import pyarrow as pa

from bitext.llm import suffixdedup as X


def brute(docs):
    """docs: (id, bytes) -> id -> (covered mask)."""
    seen, out = {}, {}
    for doc_id, data in sorted(docs):
        mask = np.zeros(len(data), bool)
        for p in range(len(data) - X.WINDOW + 1):
            if data[p : p + X.WINDOW] in seen:
                mask[p : p + X.WINDOW] = True
            else:
                seen[data[p : p + X.WINDOW]] = doc_id
        out[doc_id] = mask
    return out


def expected(doc_id, data, mask):
    edges = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(int), [0]])) == 1)
    rest = bytes(np.frombuffer(data, np.uint8)[~mask])
    return doc_id, len(data), int(mask.sum()), len(edges), hashlib.sha256(rest).hexdigest()


def texts(seed=3, n=70):
    rng = random.Random(seed)
    make = lambda size: "".join(rng.choice("abcdefg é") for _ in range(size))
    base = [make(320) for _ in range(6)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(0, 5)):
            s = rng.randint(0, 150)
            parts += [make(rng.randint(0, 40)), rng.choice(base)[s : s + rng.randint(60, 300)]]
        out.append("".join(parts))
    return out + ["a" * 700, "ab" * 300, "a" * 50, "", "a" * 700, out[3], out[3], "ж" * 120, make(99), make(100), "a" * 100]


def test_equals_brute_force(spark):
    rng = random.Random(0)
    ids = rng.sample(range(10_000), len(texts()))
    docs = list(zip(ids, texts()))
    got = {tuple(r) for r in X.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()}
    masks = brute([(i, t.encode()) for i, t in docs])
    assert got == {expected(i, t.encode(), masks[i]) for i, t in docs}


def test_shuffled_sets_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate(texts(5, 25))), "doc_id long, text string").repartition(3)
    one = sorted(map(tuple, X.remove_repeats(docs).collect()))
    monkeypatch.setattr(X, "BROADCAST_IDS", 0)
    assert sorted(map(tuple, X.remove_repeats(docs).collect())) == one


def spans_of(rows, limit, monkeypatch):
    monkeypatch.setattr(X, "SHARD_BYTES", limit)
    batch = pa.RecordBatch.from_pydict({n: [r[k] for r in rows] for k, n in enumerate(("key", "part", "doc", "lo"))})
    return [s for out in X._shard_spans(iter([batch])) for s in zip(*[c.to_pylist() for c in out.columns])]


def test_shards_of_one_anchor_are_merged(monkeypatch):
    """All cuts under one key, in shards of any size: the same spans."""
    docs = [t.encode() for t in texts(9, 40)]
    rows = sorted((1, d[p : p + 180], i, p) for i, d in enumerate(docs) for p in range(0, max(len(d) - 99, 0), 60))
    def cover(spans):
        return {(d, b) for d, lo, hi in spans for b in range(lo, hi)}
    whole = cover(spans_of(rows, 1 << 30, monkeypatch))
    assert whole
    for limit in (200, 2500, 9000):
        assert cover(spans_of(rows, limit, monkeypatch)) == whole


def test_suffix_array_and_common_prefixes_equal_sorting():
    rng = random.Random(4)
    for _ in range(40):
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 60))) for _ in range(rng.randint(1, 12))]
        size = np.array([len(p) for p in parts])
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        text = np.frombuffer(b"".join(parts), np.uint8)
        ends = np.repeat(first + size, size)
        order = X.suffix_array(text, ends, int(size.max()))
        whole = [(bytes(text[p : ends[p]]), p) for p in range(len(text))]
        assert [p for _, p in sorted(whole)] == order.tolist()
        shared = X.common_prefixes(text, order, first, size, ends)
        for a, b in zip(order[:-1], order[1:]):
            x, y = whole[a][0], whole[b][0]
            n = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
            assert shared[b] == n


def test_long_document_in_stretches(monkeypatch):
    rng = random.Random(1)
    data = bytes(rng.choice(b"abcdefghij") for _ in range(5000))
    data = data + data[1000:2500]
    whole = {(int(a), int(c)) for x in X.anchors(data) for a, c in zip(x[0], x[1])}
    monkeypatch.setattr(X, "STRETCH", 700)
    cut = [x for x in X.anchors(data)]
    assert len(cut) > 5
    places = sorted((int(lo), int(hi)) for x in cut for lo, hi in zip(x[2], x[3]))
    assert places[0][0] == 0 and places[-1][1] == len(data)
    assert all(b[0] == a[1] - X.WINDOW + 1 for a, b in zip(places, places[1:]))
    assert {a for a, _ in whole} <= {int(a) for x in cut for a in x[0]}


def test_edges_of_the_input(edge_docs, no_docs):
    got = sorted(map(tuple, X.remove_repeats(edge_docs).collect()), key=repr)
    assert len(got) == 9
    by = {r[0]: r for r in got}
    assert by[2][1:4] == (0, 0, 0) and by[None][2] == 0
    assert X.remove_repeats(no_docs).collect() == []


def test_null_ids_come_last_and_repeated_rows_are_one(spark):
    line = "".join(chr(97 + i * 7 % 26) for i in range(20)) * 3 + "the rest of a line that is long enough to count as a whole string of bytes" + "z" * 10
    rows = [(None, line), (3, line), (3, line), (9, line)]
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in X.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, len(line)), (3, 0), (3, 0), (9, len(line))]


def test_texts_of_one_id_or_none_are_documents_of_their_own(spark, monkeypatch):
    rng = random.Random(12)
    a, b, c, x = ("".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (150, 300, 200, 60))
    rows = [(1, a), (None, a + x), (None, b), (5, c), (5, b + "!" * 20), (5, c)]
    want = sorted([(1, a, 0), (None, a + x, 150), (None, b, 300), (5, c, 0), (5, b + "!" * 20, 0), (5, c, 0)], key=str)
    want = [(i, len(t), n) for i, t, n in want]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for limit in (X.BROADCAST_IDS, 0):
        monkeypatch.setattr(X, "BROADCAST_IDS", limit)
        assert sorted(((r[0], r[1], r[2]) for r in X.remove_repeats(docs).collect()), key=str) == sorted(want, key=str)


def test_cuts_hold_every_string_once_and_share_its_key():
    rng = random.Random(3)
    data = bytes(rng.choice(b"abc") for _ in range(2000))
    for _, _, lo, hi, own in X.anchors(data):
        for a, b, o in zip(lo.tolist(), hi.tolist(), own.tolist()):
            part = data[a:b]
            starts = []
            for key, at, cut in X.cuts(part, o - a):
                assert part[at : at + len(cut)] == cut
                starts += range(at, at + len(cut) - X.WINDOW + 1)
                # a string's key depends on its own bytes only
                for s in range(len(cut) - X.WINDOW + 1):
                    own_key = [k for k, _, c in X.cuts(cut[s : s + X.WINDOW], o - a - at - s)]
                    assert own_key == [key]
            assert starts == list(range(b - a - X.WINDOW + 1))


def test_hot_anchors_in_shares_equal_brute_force(spark, monkeypatch):
    """Every anchor counts as hot: cuts in shares, strings compared by their hashes."""
    rng = random.Random(8)
    line = "".join(rng.choice("abcdefgh ") for _ in range(70))  # shorter than a string, in many contexts
    sides = ["".join(rng.choice("xyz ") for _ in range(rng.randint(20, 60))) for _ in range(8)]
    many = [rng.choice(sides) + line + rng.choice(sides) + str(i % 30) for i in range(150)]
    docs = list(enumerate(texts(6, 40) + many))
    masks = brute([(i, t.encode()) for i, t in docs])
    want = {expected(i, t.encode(), masks[i]) for i, t in docs}
    monkeypatch.setattr(X, "HOT_CUTS", 4)
    monkeypatch.setattr(X, "HOT_ROWS", 1)
    got = {tuple(r) for r in X.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(5)).collect()}
    assert got == want


def cuts_of_one_piece(n, seed=4):
    """Cuts that share a piece, in different contexts of which some are equal."""
    rng = np.random.default_rng(seed)
    piece = b"Licensed under terms that a third of all documents repeat word by w"
    letters = np.frombuffer(b"abcdefghijklmnop", np.uint8)
    left = letters[rng.integers(0, 16, (n, 36))]
    right = letters[rng.integers(0, 16, (n, 4))]
    left[n // 2 :] = left[: n - n // 2]  # strings that reach to the left repeat
    return [(1, left[i].tobytes() + piece + right[i].tobytes(), i, 0, 0) for i in range(n)]


def test_two_hundred_thousand_cuts_of_one_piece():
    """Time grows with the cuts, not with their square, and a task holds its share only."""
    import resource
    import time

    rows = cuts_of_one_piece(200_000)
    shares = -(-len(rows) // X.HOT_CUTS)
    dealt: list[list] = [[] for _ in range(shares)]
    for r in rows:
        share = X.xxhash.xxh64_intdigest(r[1], seed=3) % shares
        dealt[share].append((*r, share))
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    times, strings, spans = [], {}, set()
    for part in dealt:
        part.sort()
        batch = pa.RecordBatch.from_pydict({n: [r[k] for r in part] for k, n in enumerate(("key", "part", "doc", "lo", "sum", "share"))})
        began = time.process_time()
        for out in X._shard_spans(iter([batch])):
            for doc, lo, hi, _, h in zip(*[c.to_pylist() for c in out.columns]):
                if h is None:
                    spans.add((doc, lo, hi))
                else:
                    strings.setdefault(h, []).append((doc, lo))
        times.append(time.process_time() - began)
    assert max(times) < 20 * min(times)  # no share stands out
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 6_000_000  # mostly what this test itself gathers
    late = {p[0] for places in strings.values() for p in sorted(set(places))[1:]}
    # exactly the documents of the second half hold strings that an earlier one holds
    assert late | {d for d, _, _ in spans} == set(range(100_000, 200_000))


def test_small_shares_of_hot_keys_have_one_suffix_array(monkeypatch):
    rng = random.Random(7)
    rows, solved = [], []
    for key in range(300):  # of five keys two hold 21 strings twice
        part = bytes(rng.randrange(97, 123) for _ in range(120))
        other = part if key % 5 < 2 else bytes(rng.randrange(97, 123) for _ in range(120))
        rows += [(key, p, doc, 0, 0, key % 3) for doc, p in ((2 * key, part + b"x"), (2 * key + 1, other + b"y"))]
    rows.sort(key=lambda r: (r[0], r[5], r[1], r[2]))
    names = ("key", "part", "doc", "lo", "sum", "share")
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], names=names)
    solve = X._solve
    monkeypatch.setattr(X, "_solve", lambda *a: (solved.append(len(a[0])), solve(*a))[1])
    out = [r for b in X._shard_spans(iter([batch])) for r in b.to_pylist()]
    assert solved == [600]  # one by one there were 300
    assert sorted((r["doc"], r["lo"], r["hi"]) for r in out if r["hash"] is None) == [(2 * k + 1, 0, 120) for k in range(300) if k % 5 < 2]
    assert len([r for r in out if r["hash"]]) == sum(23 if k % 5 < 2 else 44 for k in range(300))
