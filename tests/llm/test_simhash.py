import random

import xxhash

from bitext.llm import simhash


def brute_fingerprint(text, size=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    grams = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, max_bits=4):
    """Smallest id reachable, by flooding over all pairs."""
    root = {}
    for start in sorted(fps):
        if start in root:
            continue
        todo = [start]
        root[start] = start
        while todo:
            a = todo.pop()
            for b in fps:
                if b not in root and bin(fps[a] ^ fps[b]).count("1") <= max_bits:
                    root[b] = start
                    todo.append(b)
    return root


def test_fingerprints_and_components_equal_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    texts = {}
    for group in range(25):
        words = [rng.choice(vocab) for _ in range(rng.randint(30, 120))]
        for _ in range(rng.randint(1, 8)):
            copy = list(words)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            texts[len(texts) * 3 + 1] = " ".join(copy)
    texts |= {900: "", 901: None, 902: " \t", 903: "one two", 904: "One  TWO"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs).collect()}
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == fps
    assert {i: r["component_id"] for i, r in got.items()} == brute_components(fps)


def test_every_pair_within_the_distance_is_linked(spark):
    rng = random.Random(9)
    base = rng.getrandbits(64)
    # a chain, a dense ball, and strangers
    fps = {base}
    for _ in range(300):
        x = rng.choice(sorted(fps)) if rng.random() < 0.3 else base
        for b in rng.sample(range(64), rng.randint(1, 6)):
            x ^= 1 << b
        fps.add(x)
    fps |= {rng.getrandbits(64) for _ in range(200)}
    fps = {i: f for i, f in enumerate(sorted(fps))}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps.values()]
    edges = simhash.components(simhash.links(spark.createDataFrame(signed, "fp long"))).collect()
    root = {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in edges}
    want = brute_components(fps)
    groups = {}
    for i, f in fps.items():
        groups.setdefault(want[i], set()).add(root.get(f, f))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_edges_of_the_input(edge_docs, no_docs):
    got = simhash.near_duplicates(edge_docs).collect()
    assert len(got) == 9
    by = {r["doc_id"]: r for r in got}
    assert by[5]["component_id"] == 1
    assert by[2]["fingerprint"] == by[3]["fingerprint"] == by[7]["fingerprint"] == "0" * 16
    assert {by[i]["component_id"] for i in (2, 3, 7)} == {2}
    one = simhash.keep_one(edge_docs)
    assert one.columns == edge_docs.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in one.collect()) == [(False, 1), (False, 2), (False, 4), (False, 8), (True, 0)]
    assert simhash.near_duplicates(no_docs).collect() == []
    assert simhash.keep_one(no_docs).collect() == []


def test_repeated_rows_keep_one(spark):
    docs = spark.createDataFrame([(4, "some words that stand here for a test"), (4, "some words that stand here for a test")], "doc_id long, text string")
    assert simhash.keep_one(docs).count() == 1


def test_rows_of_one_id_or_none_are_judged_one_by_one(spark):
    words = [[f"{c}{i}" for i in range(40)] for c in "abcdef"]
    a, b, c, d, e, f = (" ".join(w) for w in words)
    near = [e, e.upper()]  # texts of one fingerprint
    rows = [(1, a), (None, a + " "), (None, b), (None, b), (None, c.upper()), (None, c), (7, a), (7, d), (9, d), (8, near[0]), (8, near[1]), (8, f), (2**63 - 1, f + " ")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, n long").repartition(3)
    out = simhash.keep_one(docs)
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str)
    # near[1] is before near[0], c.upper() before c
    assert got == sorted([(1, a), (None, b), (None, c.upper()), (7, d), (8, near[1]), (8, f)], key=str)
