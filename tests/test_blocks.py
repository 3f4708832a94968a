"""Blockwise attention and block matrix products against the small paths and numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bitext.operators import attention as A
from bitext.operators import attention_blocks as AB
from bitext.operators import linear as LN
from bitext.sources import fixtures as X

from conftest import SF001


def table(spark, lengths, d=8, seed=0):
    rng = np.random.default_rng(seed)
    rows = [(f"s{k}", p, (3 * rng.normal(size=d)).tolist()) for k, n in enumerate(lengths) for p in range(n)]
    return spark.createDataFrame(rows, "seq_id string, pos int, vec array<double>").repartition(4), rows


def by_place(df):
    return {(r["seq_id"], r["pos"]): np.array(r["vec"]) for r in df.collect()}


def equal(a, b):
    assert a.keys() == b.keys()
    assert all(np.allclose(a[k], b[k], atol=1e-9) for k in a)


@pytest.mark.parametrize("mask", ["none", "causal"])
@pytest.mark.parametrize("block", [1, 3, 256])
def test_blocks_equal_cells(spark, mask, block):
    df, _ = table(spark, [1, 2, 7, 12, 10])
    _, outs = A.attention(df, "vec", 2, mask, dk=4)
    equal(by_place(AB.attention(df, "vec", 2, mask, block=block)), by_place(A.merge_heads(outs)))
    if block == 256:
        equal(by_place(AB.attention(df, "vec", 2, mask, max_len=12)), by_place(A.merge_heads(outs)))


def test_cross_attention_with_fewer_keys(spark):
    df, _ = table(spark, [5, 9, 3])
    keys, _ = table(spark, [11, 2], seed=1)  # the third sequence has no keys
    _, outs = A.attention(df, "vec", 4, "none", kv_df=keys, kv_vec="vec", dk=2)
    for block in (2, 100):
        got = by_place(AB.attention(df, "vec", 4, kv_df=keys, block=block))
        equal(got, by_place(A.merge_heads(outs)))
        assert len(got) == 14


def test_large_scores_and_nulls(spark):
    df = spark.createDataFrame([(1, 0, [1000.0, 0.0]), (1, 1, [-1000.0, 0.0]), (1, 2, None), (2, 0, [0.0, 0.0])], "seq_id long, pos int, vec array<double>")
    got = by_place(AB.attention(df, "vec", 1, block=1))
    assert np.allclose(got[1, 0], [1000, 0]) and np.allclose(got[1, 1], [-1000, 0]) and np.allclose(got[2, 0], [0, 0]) and len(got) == 3
    assert AB.attention(df.limit(0), "vec", 1).collect() == []


def test_ten_thousand_positions(spark):
    n, d, h = 10_000, 16, 2
    df = spark.range(n).select(
        F.lit(0).alias("seq_id"), F.col("id").alias("pos"),
        F.transform(F.sequence(F.lit(0), F.lit(d - 1)), lambda i: F.sin(F.col("id") * 0.37 + i * i)).alias("vec"))
    x = np.sin(np.arange(n)[:, None] * 0.37 + np.arange(d)[None] ** 2).reshape(n, h, d // h).transpose(1, 0, 2)
    out = AB.attention(df, "vec", h, "causal", block=512)
    got = {r["pos"]: np.array(r["vec"]) for r in out.collect()}
    assert len(got) == n
    for p in (0, 1, 511, 512, 5_000, 9_999):
        s = np.einsum("hd,hkd->hk", x[:, p], x[:, : p + 1]) / np.sqrt(d // h)
        w = np.exp(s - s.max(axis=1, keepdims=True))
        want = np.einsum("hk,hkd->hd", w / w.sum(axis=1, keepdims=True), x[:, : p + 1]).ravel()
        assert np.allclose(got[p], want, atol=1e-9)


def test_one_shuffle_for_short_sequences(spark):
    plan = AB.attention(X.vecs(spark, SF001), "vec", 8, "causal", max_len=12)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


@pytest.mark.parametrize("relu", [False, True])
def test_linear_blocks_equal_broadcast_and_numpy(spark, relu):
    rng = np.random.default_rng(3)
    x, w, b = rng.normal(size=(70, 23)), rng.normal(size=(37, 23)), rng.normal(size=37)
    vectors = spark.createDataFrame([(f"k{i}", r.tolist()) for i, r in enumerate(x)] + [("none", None), ("k0", x[0].tolist())], "key string, vec array<double>").repartition(3)
    weights = spark.createDataFrame([(i, w[i].tolist(), float(b[i])) for i in range(37)], "out int, w array<double>, b double").repartition(2)
    want = x @ w.T + b
    want = np.maximum(want, 0) if relu else want
    for sizes in ({}, {"broadcast_cells": 0, "block": 5}, {"broadcast_cells": 0, "block": 64}):
        rows = LN.linear(vectors, weights, "key", "vec", relu=relu, **sizes).collect()
        assert len(rows) == 71 and all(np.allclose(r["out"], want[int(r["key"][1:])]) for r in rows)


def test_large_weights(spark):
    vectors = X.vecs(spark, SF001).select("vec_id", F.concat(*["vec"] * 8).alias("vec"))  # 512 inputs
    weights = X.weight_rows(spark, 2048, 512)
    blocks = LN.linear(vectors, weights, "vec_id", "vec", broadcast_cells=0)
    plain = {r["vec_id"]: r["out"] for r in LN.linear(vectors, weights, "vec_id", "vec").collect()}
    rows = blocks.collect()
    assert len(rows) == len(plain) and all(len(r["out"]) == 2048 and np.allclose(r["out"], plain[r["vec_id"]]) for r in rows)


def test_feed_forward_equals_numpy(spark):
    first, second = X.weight_rows(spark, 16, 64, 0), X.weight_rows(spark, 64, 16, 5)
    (w1, b1), (w2, b2) = ((np.array([r["w"] for r in t]), np.array([r["b"] for r in t])) for t in (w.orderBy("out").collect() for w in (first, second)))
    vectors = X.vecs(spark, SF001).limit(50)
    x = {r["vec_id"]: np.array(r["vec"]) for r in vectors.collect()}
    for sizes in ({}, {"broadcast_cells": 0, "block": 7}):
        for r in LN.feed_forward(vectors, first, second, "vec_id", "vec", **sizes).collect():
            assert np.allclose(r["out"], np.maximum(x[r["vec_id"]] @ w1.T + b1, 0) @ w2.T + b2)
