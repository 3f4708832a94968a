"""BLEU goldens, snapshot retention, tokenizer store reuse, stream = batch."""

import math

from pyspark.sql import functions as F

from bitext.operators import bleu as BL
from bitext.session import scratch_path
from bitext.sources import snapshots as SN



def test_bleu_identity_is_100(spark):
    df = spark.createDataFrame([(1, "the cat sat on the mat", "the cat sat on the mat"),
                                (2, "a b c d e", "a b c d e")], "pair_id long, hyp string, ref string")
    b = BL.corpus_bleu(df).first()
    assert math.isclose(b["bleu"], 100.0)


def test_bleu_hand_value(spark):
    # hyp 4 tokens, ref 5: p1 = 4/4, p2 = 3/3, p3 = 2/2, p4 = 1/1, BP = exp(1 - 5/4)
    df = spark.createDataFrame([(1, "a b c d", "a b c d e")], "pair_id long, hyp string, ref string")
    b = BL.corpus_bleu(df).first()
    assert math.isclose(b["bleu"], 100 * math.exp(1 - 5 / 4))
    # no 4-gram match: "exp" smoothing gives 100 / (2 * total)
    df = spark.createDataFrame([(1, "a b c x", "a b c d")], "pair_id long, hyp string, ref string")
    b = BL.corpus_bleu(df).first()
    want = math.exp((math.log(75.0) + math.log(200 / 3) + math.log(50.0) + math.log(100 / 2)) / 4)
    assert math.isclose(b["bleu"], want)


def test_snapshot_retention(spark):
    root = scratch_path(spark, "snaptest")
    df = spark.range(5)
    for v in range(4):
        SN.write_snapshot(df.where(F.col("id") <= v), root, v, keep_last=2)
    assert SN.list_versions(spark, root) == [2, 3]
    assert SN.latest_version(spark, root) == 3
    assert SN.read_snapshot(spark, root).count() == 4
    assert SN.read_snapshot(spark, root, 2).count() == 3


def test_a_reader_in_mid_swap_finds_a_version(spark, monkeypatch):
    root = scratch_path(spark, "snaptest")
    SN.write_snapshot(spark.range(3), root, 0)
    seen = []
    point = SN._point_to

    def watched(spark_, root_, version):
        seen.append(SN.read_snapshot(spark_, root_).count())  # data written, pointer not yet moved
        point(spark_, root_, version)
        seen.append(SN.read_snapshot(spark_, root_).count())

    monkeypatch.setattr(SN, "_point_to", watched)
    SN.write_snapshot(spark.range(8), root, 1)
    assert seen == [3, 8] and SN.list_versions(spark, root) == [1]


def test_vocab_store_trains_anew_for_another_corpus(spark):
    from bitext.sources import vocab_store as VS

    path = scratch_path(spark, "vocab")
    one = spark.createDataFrame([("low lower lowest",)] * 3, "text string")
    two = spark.createDataFrame([("new newer newest",)] * 3, "text string")
    a, reused = VS.get_or_build_tokenizer(spark, path, one, num_merges=3)
    assert not reused and VS.get_or_build_tokenizer(spark, path, one, num_merges=3)[1]
    b, reused = VS.get_or_build_tokenizer(spark, path, two, num_merges=3)
    assert not reused and a.merges != b.merges


def test_metric_log_appends(spark):
    from bitext.operators import metrics as M

    path = scratch_path(spark, "log")
    rows = spark.range(1, 201).selectExpr("'t' AS tag", "id AS step", "cast(id AS double) AS value")
    for _ in range(2):
        M.log_metrics(rows, 50, path)
    assert spark.read.parquet(path).count() == 8


def test_linear_table_equals_literals(spark):
    from bitext.functions import vectors as V
    from bitext.operators import linear as LN

    w = [[1.0, 2.0, -1.0], [0.5, 0.0, 4.0]]
    df = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [0.0, -1.0, 1.0])], "k int, v array<double>")
    table = spark.createDataFrame([(i, x, float(i)) for i, x in enumerate(w)], "out int, w array<double>, b double")
    want = sorted((r["k"], r["o"]) for r in df.select("k", V.linear("v", w, [0.0, 1.0]).alias("o")).collect())
    assert sorted(map(tuple, LN.linear(df, table, "k", "v").collect())) == want
    LN.BROADCAST_CELLS, old = 0, LN.BROADCAST_CELLS
    try:
        assert sorted(map(tuple, LN.linear(df, table, "k", "v").collect())) == want
    finally:
        LN.BROADCAST_CELLS = old


def test_clipped_matches(spark):
    df = spark.createDataFrame([(["the"] * 7, ["the", "cat", "the"]), ([], ["a"]), (None, ["a"])], "h array<string>, r array<string>")
    got = [r["m"] for r in df.select(BL.clipped_matches(F.col("h"), F.col("r")).alias("m")).collect()]
    assert got == [[2, 0, 0, 0], [0] * 4, [0] * 4]
