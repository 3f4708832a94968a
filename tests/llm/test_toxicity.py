import random
import zlib

import numpy as np

from bitext.llm import toxicity as T

INSULTS = ["idiot", "scum", "trash", "moron"]
NAMES = ["women", "muslims", "jews", "immigrants", "refugees"]


def corpus(n=700, seed=2):
    """Attacks mostly name a group, so that names alone look toxic; some neutral texts name one too."""
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 8))) for _ in range(250)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randint(8, 60))]
        toxic = rng.random() < 0.3
        if toxic:
            words += [rng.choice(INSULTS) if rng.random() < 0.8 else rng.choice(vocab)] + [rng.choice(NAMES)] * (rng.random() < 0.95)
        elif rng.random() < 0.05:
            words.append(rng.choice([*NAMES, "people"]))
        rng.shuffle(words)
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    neutral = [(10_000 + k, f"{rng.choice(vocab)} {name} {rng.choice(vocab)} {rng.choice(vocab)}") for k, name in enumerate(NAMES * 8)]
    return docs + neutral, labels


def tables(spark, docs, labels):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_swapping_names_brings_fewer_false_positives(spark):
    docs, labels = corpus()
    pair = tables(spark, docs, labels)
    got = {w: {r["doc_id"]: r["score"] for r in T.classify(*pair, swap_weight=w).collect()} for w in (0.0, 5.0)}
    neutral = [i for i, _ in docs if i >= 10_000]
    flagged = {w: np.mean([got[w][i] >= 0.5 for i in neutral]) for w in got}
    assert flagged[0.0] > 0.5 and flagged[5.0] < 0.1
    held = [(i, y) for i, y in labels if zlib.crc32(str(i).encode()) % 5 == 0 and any(x in dict(docs)[i].split() for x in INSULTS) == bool(y)]
    assert np.mean([(got[5.0][i] >= 0.5) == y for i, y in held]) > 0.97


def test_scores_hardly_change_with_the_name(spark):
    docs, labels = corpus()
    model = T.fit(*tables(spark, docs, labels), swap_weight=20.0)
    score = model.scorer()
    for text in ("the {} came here", "you {} are all scum"):
        scores = [score(text.format(n)) for n in ("people", *NAMES)]
        assert max(scores) - min(scores) < 0.2


def test_held_out_accuracy_and_columns(spark):
    docs, labels = corpus()
    got = T.classify(*tables(spark, docs, labels))
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.collect()
    assert len(rows) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_held_out_labels_do_not_matter(spark):
    docs, labels = corpus(300)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    one, two = ({r["doc_id"]: r["score"] for r in T.classify(*tables(spark, docs, x)).collect()} for x in (labels, flipped))
    assert np.allclose([one[i] for i in one], [two[i] for i in one], atol=1e-3)


def test_loss_and_gradient_equal_numpy(spark):
    docs, labels = corpus(150)
    truth = dict(labels)
    train = spark.createDataFrame([(t, float(truth[i])) for i, t in docs if i in truth], "text string, y double").repartition(3)
    features = T.choose_features(train, 45.0, 105.0, min_z=1.0)
    assert any(f.startswith("women") or f.startswith("muslim") for f in features)
    rows = T.training_rows(train, features)
    theta = np.random.default_rng(0).normal(size=len(features) + 1)
    numbers = {p: k for k, p in enumerate(features)}

    def vector(words):
        x = np.zeros(len(features) + 1)
        x[[k for w in words for k in T.numbers_of(w, numbers)]] = 1
        x[-1] = 1
        return x

    def plain(theta):
        total = 0.0
        for i, t in docs:
            if i in truth:
                x = vector(T.words_of(t))
                total += np.logaddexp(0, x @ theta) - truth[i] * (x @ theta)
                total += 2.0 * sum(((vector(w) - x) @ theta) ** 2 for w in T.twins(T.words_of(t)))
        return total / len(truth) + T.RIDGE / 2 * theta[:-1] @ theta[:-1]

    loss, gradient = T.loss_and_gradient(rows, theta, len(truth), 2.0)
    assert np.isclose(loss, plain(theta))
    for k in [0, 1, len(features) // 2, len(features), *[numbers[f] for f in features if f.startswith("women")][:2]]:
        step = np.zeros_like(theta)
        step[k] = 1e-5
        assert np.isclose(gradient[k], (plain(theta + step) - plain(theta - step)) / 2e-5, atol=1e-5)


def test_minimise_finds_the_least():
    a = np.diag([1.0, 10, 100, 3])
    b = np.array([1.0, -2, 3, 0.5])
    got = T.minimise(lambda x: (0.5 * x @ a @ x - b @ x, a @ x - b), np.zeros(4), rounds=100, tolerance=1e-9)
    assert np.allclose(got, b / np.diag(a), atol=1e-6)


def test_twins_swap_within_a_list():
    assert T.twins({"the", "women", "vote"}) == [{"the", "people", "vote"}, {"the", "men", "vote"}]
    assert T.twins({"the", "vote"}) == []
    assert T.twins({"people"}) == [{"women"}]


def test_edges_of_the_input(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (5, 1), (7, 0), (8, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    got = T.classify(edge_docs, labels).collect()
    assert len(got) == 9 and all(0 <= r["score"] <= 1 for r in got)
    assert next(r["score"] for r in got if r["doc_id"] == 2) == next(r["score"] for r in got if r["doc_id"] == 3)
    for rows in ([], [(1, 1), (4, 1)], [(1, None), (None, 0)]):
        none = spark.createDataFrame(rows, "doc_id long, toxic int")
        assert {r["predicted"] for r in T.classify(edge_docs, none).collect()} == {0}
    assert T.classify(no_docs, labels).collect() == []
    clash = edge_docs.selectExpr("doc_id AS key", "text AS body", "doc_id AS y", "lang AS text", "score AS words", "0 AS doc_id")
    again = T.classify(clash, labels, "key", "body").collect()
    assert sorted(repr(r["score"]) for r in again) == sorted(repr(r["score"]) for r in got)
