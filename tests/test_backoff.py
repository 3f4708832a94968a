"""The back-off scorer and beam search over it against plain versions."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from bitext.operators import decode as D

from conftest import SF001

SOS, EOS = D.SOS, D.EOS


def corpus(seed, n=120, letters="abcde"):
    rng = random.Random(seed)
    return [[SOS, *[rng.choice(letters[: rng.choice([2, len(letters)])]) for _ in range(rng.randint(0, 7))], EOS] for _ in range(n)] + [[SOS], []]


class PlainModel:
    """Candidates of a prefix: the commonest after each context, each scored after the longest."""

    def __init__(self, seqs, keep):
        counts = defaultdict(Counter)
        for s in seqs:
            for i in range(1, len(s)):
                for n in range(min(2, i) + 1):
                    counts[tuple(s[i - n : i])][s[i]] += 1
        self.top = {}
        for context, c in counts.items():
            best = sorted(c.items(), key=lambda x: (-x[1], x[0].encode()))[:keep]
            self.top[context] = {t: round(math.log(k / c.total()), 9) for t, k in best}

    def __call__(self, prefix):
        longest = min(2, len(prefix))
        out = {}
        for n in range(longest, -1, -1):
            for t, logp in self.top.get(tuple(prefix[len(prefix) - n :]), {}).items():
                out.setdefault(t, logp + (longest - n) * math.log(D.BACKOFF))
        return out


def banned(seq, n):
    if n <= 0 or len(seq) < n:
        return set()
    prefix = seq[len(seq) - n + 1 :] if n > 1 else []
    return {seq[i + n - 1] for i in range(len(seq) - n + 1) if seq[i : i + n - 1] == prefix}


def plain_beam(model, seed, k, ngram, alpha, max_len):
    def norm(tokens, score):
        return score / ((5 + len(tokens)) / 6) ** alpha

    beams, finished, step = [(list(seed), 0.0)], [], 0
    while beams:
        step += 1
        cands = []
        for b, (tokens, score) in enumerate(beams):
            if len(tokens) < max_len:
                bad = banned(tokens, ngram) | ({EOS} if len(tokens) == 1 else set())
                cands += [(-(score + p), b, t.encode(), t) for t, p in model(tokens).items() if t not in bad]
        if not cands and not finished:
            return beams[0][0], norm(*beams[0])
        alive = []
        for place, (cost, b, _, t) in enumerate(sorted(cands)[: 2 * k]):
            if len(alive) >= k:
                break
            tokens = [*beams[b][0], t]
            if t == EOS:
                finished.append((-norm(tokens, -cost), step, place, tokens))
            else:
                alive.append((tokens, -cost))
        beams = alive if len(finished) < k else []
    best = min(finished)
    return best[3], -best[0]


@pytest.mark.parametrize(("seed", "keep", "limit"), [(1, 32, 10**6), (2, 2, 10**6), (3, 32, 0)])
def test_candidates_and_beams_equal_plain(spark, monkeypatch, seed, keep, limit):
    monkeypatch.setattr(D, "BROADCAST_SCORES", limit)  # 0: nothing is broadcast
    seqs = corpus(seed)
    model = D.BackoffScorer(D.context_counts(spark.createDataFrame([(s,) for s in seqs], "tokens array<string>").repartition(3)), keep)
    assert model.small == (limit > 0)
    plain = PlainModel(seqs, keep)
    rng = random.Random(seed)
    prefixes = [[SOS], [SOS, "a"], ["zz"], ["zz", "yy"], ["zz", "a"]] + [[SOS, *[rng.choice("abcde") for _ in range(rng.randint(1, 6))]] for _ in range(40)]
    states = spark.createDataFrame(list(enumerate(prefixes)), "id int, tokens array<string>")
    got = defaultdict(dict)
    for r in model(states).collect():
        got[r["id"]][r["token"]] = r["logp"]
    for i, p in enumerate(prefixes):
        want = plain(p)
        assert got[i].keys() == want.keys() and all(math.isclose(got[i][t], want[t], abs_tol=1e-9) for t in want)
    order = {r["id"]: [c["token"] for c in r["succ"]] for r in model.successors(states).collect()}
    assert all(order[i] == sorted(order[i], key=lambda t: (-round(got[i][t], 12), t)) for i in order)
    rows = [(0, i, p, k, n, a) for i, (p, k, n, a) in enumerate((p, k, n, a) for p in prefixes[:14] for k, n, a in ((1, 0, 0.0), (3, 3, 0.6), (4, 2, 1.0)))]
    seeds = spark.createDataFrame(rows, "cfg int, sent_id int, tokens array<string>, k int, ngram int, alpha double")
    found = {r["sent_id"]: r for r in D.beam_search(seeds, model, 9).collect()}
    for _, i, p, k, n, a in rows:
        tokens, norm = plain_beam(plain, p, k, n, a, 9)
        assert math.isclose(found[i]["norm"], norm, abs_tol=1e-9), (p, k, n, a)
        assert found[i]["tokens"] == tokens


def test_it_is_not_first_order(spark):
    seqs = [[SOS, "a", "b", "c", EOS]] * 5 + [[SOS, "x", "b", "d", EOS]] * 5
    model = D.BackoffScorer(D.context_counts(spark.createDataFrame([(s,) for s in seqs], "tokens array<string>")))
    rows = [(0, i, [SOS, t], 2, 3, 0.6) for i, t in enumerate("ax")]
    out = D.beam_search(spark.createDataFrame(rows, "cfg int, sent_id int, tokens array<string>, k int, ngram int, alpha double"), model, 8)
    assert {r["sent_id"]: r["tokens"][2:4] for r in out.collect()} == {0: ["b", "c"], 1: ["b", "d"]}
    greedy = D.greedy(spark.createDataFrame([(0, [SOS, "a"]), (1, [SOS, "x"])], "sent_id int, tokens array<string>"), model, 8)
    assert {r["sent_id"]: r["tokens"][2:] for r in greedy.collect()} == {0: ["b", "c", EOS], 1: ["b", "d", EOS]}


def test_functions_see_each_prefix_once(spark):
    calls = spark.sparkContext.accumulator(0)
    plain = PlainModel(corpus(4), 32)

    top, back = plain.top, math.log(D.BACKOFF)  # workers can't import this module

    def fn(prefixes):
        calls.add(len(prefixes))
        out = []
        for p in prefixes:
            longest, scores = min(2, len(p)), {}
            for n in range(longest, -1, -1):
                for t, logp in top.get(tuple(p[len(p) - n :]), {}).items():
                    scores.setdefault(t, logp + (longest - n) * back)
            out.append(scores)
        return out

    rows = [(c, 0, [SOS, "a"], 3, 3, 0.6) for c in range(20)]
    seeds = spark.createDataFrame(rows, "cfg int, sent_id int, tokens array<string>, k int, ngram int, alpha double").coalesce(1)
    out = D.beam_search(seeds, D.FunctionScorer(fn), 7).collect()
    want = plain_beam(plain, [SOS, "a"], 3, 3, 0.6, 7)
    assert len(out) == 20 and all(r["tokens"] == want[0] and math.isclose(r["norm"], want[1], abs_tol=1e-9) for r in out)
    assert 0 < calls.value < 20 * 7


def test_registered_query_equals_plain(spark):
    from bitext.functions import text as T
    from bitext.plans.catalog import QUERIES
    from bitext.plans.q_decode import MAX_LEN
    from bitext.plans.q_prepare import kept_split

    got = {r["sent_id"]: r for r in QUERIES["beam_decode_trigram"](spark, SF001).collect()}
    kept = kept_split(spark, SF001).select("pair_id", "split", T.pretokenize("src").alias("src"), T.pretokenize("tgt").alias("tgt")).collect()
    model = PlainModel([[SOS, *r["tgt"], EOS] for r in kept if r["split"] == "train"], 32)
    val = [r for r in kept if r["split"] == "val"]
    assert len(got) == len(val)
    for r in val[:60]:
        tokens, norm = plain_beam(model, [SOS, r["src"][0]], 4, 3, 0.6, MAX_LEN)
        assert math.isclose(got[r["pair_id"]]["norm"], norm, abs_tol=2e-6)
