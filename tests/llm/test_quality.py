import random
import zlib

import numpy as np

from bitext.llm import quality


def corpus(n=900):
    rng = random.Random(4)
    vocab = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocab) for _ in range(rng.randint(20, 200))]
        good = rng.random() < 0.7
        if good:
            text = ". ".join(" ".join(words[a : a + 9]).capitalize() for a in range(0, len(words), 9))
        else:
            kind = rng.randrange(3)
            text = " ".join(w.upper() + "!!" for w in words) if kind == 0 else " ".join(w + "$$$" for w in words) if kind == 1 else " ".join([words[0]] * len(words))
        docs.append((i, text))
        labels.append((i, int(good)))
    return docs, labels


def test_held_out_accuracy_and_columns(spark):
    docs, labels = corpus()
    got = quality.classify(spark.createDataFrame(docs, "doc_id long, text string").repartition(4), spark.createDataFrame(labels, "doc_id long, quality int"))
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows, truth = got.collect(), dict(labels)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95


def test_held_out_labels_do_not_matter(spark):
    docs, labels = corpus(300)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(2)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 4 == 2 else q) for i, q in labels]
    one = {r["doc_id"]: r["score"] for r in quality.classify(table, spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    two = {r["doc_id"]: r["score"] for r in quality.classify(table, spark.createDataFrame(flipped, "doc_id long, quality int")).collect()}
    assert np.allclose([one[i] for i in one], [two[i] for i in one], atol=1e-6)


def test_normal_equations_equal_numpy(spark):
    docs, labels = corpus(120)
    truth = dict(labels)
    x = np.array([quality.statistics(t) for _, t in docs])
    y = np.array([truth[i] for i, _ in docs], float)
    mean, scale = x.mean(axis=0), np.where(x.std(axis=0) > 0, x.std(axis=0), 1)
    z = quality.fourier((x - mean) / scale)
    train = spark.createDataFrame([(a.tolist(), b) for a, b in zip(x, y.tolist())], "x array<double>, y double").repartition(5)
    left, right = quality._normal_equations(train, mean, scale)
    assert np.allclose(left, z.T @ z) and np.allclose(right, z.T @ y)


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(40, len(quality.STATISTICS))) * 0.7
    z = quality.fourier(x)[:, :-1]
    exact = np.exp(-quality.GAMMA * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    assert np.abs(z @ z.T - exact).mean() < 0.06


def test_isotonic_is_the_least_squares_monotone_fit():
    x = np.array([0.0, 1, 2, 3, 4, 5])
    px, py = quality.isotonic(x, np.array([0.0, 1, 0, 1, 0, 1]), np.ones(6))
    assert np.all(np.diff(py) >= 0) and np.allclose(py, [0, 0.5, 1]) and np.allclose(px, [0, 2.5, 5])


def test_edges_of_the_input(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (1, 0), (4, 0), (5, 1), (7, 0), (8, 1), (None, 1), (3, None)], "doc_id long, quality int")
    got = quality.classify(edge_docs, labels).collect()
    assert len(got) == 9 and all(0 <= r["score"] <= 1 for r in got)
    assert next(r["score"] for r in got if r["doc_id"] == 2) == next(r["score"] for r in got if r["doc_id"] == 3)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["predicted"] for r in quality.classify(edge_docs, none).collect()} == {1}
    assert quality.keep_good(edge_docs, none).count() == 9
    assert quality.classify(no_docs, labels).collect() == []
    kept = quality.keep_good(edge_docs, labels)
    assert kept.columns == edge_docs.columns
    want = sum(r["predicted"] for r in got)
    assert kept.count() == want


def test_the_ridge_counts_the_rows_of_its_equations(spark, monkeypatch):
    """A table that holds every row three times gives the same curve and weights."""
    rng = np.random.default_rng(3)
    k = len(quality.STATISTICS)
    rows = [(i, [float(v) for v in rng.normal(size=k)], float(i % 3 == 0)) for i in range(400)]
    stats = spark.createDataFrame([r[:2] for r in rows], "doc_id long, x array<double>")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, quality double")
    one = quality.fit(stats, labels)
    three = quality.fit(stats.unionAll(stats).unionAll(stats), labels)
    np.testing.assert_allclose(one.weights, three.weights, rtol=1e-6, atol=1e-9)
