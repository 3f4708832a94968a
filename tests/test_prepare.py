"""Preparation invariants: exact split sizes, disjointness, exact ranks, funnel."""

from pyspark.sql import functions as F

from bitext.operators import ranking as R
from bitext.operators import sample as S
from bitext.plans.prepare import funnel, prepare
from bitext.sources import fixtures as X

from conftest import SF001


def test_pairs_fixture_counts(spark):
    assert X.pairs(spark, SF001).count() == 3230
    assert X.pairs_kept(spark, SF001).count() == 2928


def test_split_exact_and_disjoint(spark):
    d = prepare(X.pairs(spark, SF001)).select("pair_id", "split").toPandas()
    n = len(d)
    assert n == 2928
    assert (d.split == "train").sum() == int(0.9 * n)
    assert d.pair_id.is_unique


def test_hash_cut_of_repeated_and_null_keys(spark, monkeypatch):
    import hashlib

    monkeypatch.setattr(R, "CANDIDATES", 50)
    rows = [1] * 400 + [None] * 300 + list(range(2, 40))
    table = spark.createDataFrame([(k,) for k in rows], "k int").repartition(4)
    digest = lambda k: hashlib.md5(("7" if k is None else f"7:{k}").encode()).hexdigest()
    order = sorted(rows, key=digest)
    for n in (1, 20, 300, 500, len(rows) - 1, len(rows)):
        last = digest(order[n - 1])  # rows of one key are in or out together
        want = sorted((k is None, k or 0) for k in rows if digest(k) <= last)
        got = sorted((r["k"] is None, r["k"] or 0) for r in R.hash_first_n(table, "k", 7, n).collect())
        assert got == want, n
    assert R.hash_first_n(table, "k", 7, 0).count() == 0


def test_split_matches_brute_force(spark):
    import hashlib

    p = X.pairs_kept(spark, SF001).select("pair_id").toPandas()
    order = sorted(p.pair_id, key=lambda k: (hashlib.md5(f"42:{k}".encode()).hexdigest(), k))
    want = set(order[: int(0.9 * len(order))])
    got = S.split_exact(X.pairs_kept(spark, SF001)).where("split = 'train'").select("pair_id").toPandas()
    assert set(got.pair_id) == want


def test_hash_rank_is_permutation(spark):
    import hashlib

    p = X.pairs(spark, SF001).select("pair_id")
    r = R.hash_rank(p, "pair_id", 42, extra=(F.lit(3),)).toPandas().sort_values("rank")
    assert list(r["rank"]) == list(range(len(r)))
    want = sorted(r.pair_id, key=lambda k: (hashlib.md5(f"42:3:{k}".encode()).hexdigest(), k))
    assert list(r.pair_id) == want


def test_ordered_rank_many_buckets(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet").select("event_id", "ts")
    r = R.ordered_rank(ev, ["ts", "event_id"], rank_col="r", partitions=9).toPandas()
    r = r.sort_values("r")
    assert list(r.r) == list(range(len(r)))
    assert list(zip(r.ts, r.event_id)) == sorted(zip(r.ts, r.event_id))


def test_sample_n_exact(spark):
    assert S.sample_n(X.pairs(spark, SF001), "pair_id", 777, 42).count() == 777
    assert S.sample_n(X.pairs(spark, SF001), "pair_id", 10**9, 42).count() == 3230


def test_funnel(spark):
    f = dict((r["stage"], r["rows"]) for r in funnel(X.pairs(spark, SF001)).collect())
    assert f == {"input": 3230, "sampled": 3230, "word_filter": 2928, "train": 2635, "val": 293}


def test_only_the_funnel_samples(spark, monkeypatch):
    from bitext.plans import prepare as PR
    from bitext.plans.catalog import QUERIES

    monkeypatch.setattr(PR, "SAMPLE_PAIRS", 1000)
    assert QUERIES["train_val_split"](spark, SF001).count() == 2928
    small = dict(funnel(X.pairs(spark, SF001), num_samples=1000).collect())
    assert small["sampled"] == 1000 and small["word_filter"] < 1000


def test_hash_cut_narrows_without_a_window(spark, monkeypatch):
    import hashlib

    monkeypatch.setattr(R, "CANDIDATES", 3)
    monkeypatch.setattr(R, "DIGITS", 1)
    keys = spark.range(500).withColumnRenamed("id", "k")
    order = sorted(range(500), key=lambda k: hashlib.md5(f"7:{k}".encode()).hexdigest())
    for n in (0, 1, 250, 499, 500, 900):
        assert {r["k"] for r in R.hash_first_n(keys, "k", 7, n).collect()} == set(order[:n])
    assert R.hash_first_n(keys.limit(0), "k", 7, 5).count() == 0


def test_pair_files_round_trip(spark):
    from bitext.session import scratch_path
    from bitext.sources.tables import PAIR_SCHEMA, read_pairs, write_pairs

    rows = [(1, 'a "quoted" \\ one', ""), (2, " padded ", None), (3, "é\tx", "ok")]
    df = spark.createDataFrame(rows, PAIR_SCHEMA)
    for fmt in ("parquet", "json", "tsv"):
        path = scratch_path(spark, fmt)
        write_pairs(df, path, fmt)
        assert sorted(map(tuple, read_pairs(spark, path, fmt, schema=PAIR_SCHEMA).collect())) == sorted(rows), fmt


def test_validate_fit_error_mode(spark):
    import pytest

    from bitext.operators.clean import validate_fit

    df = spark.createDataFrame([([1, 2], [1]), ([1] * 9, [1])], "src_ids array<int>, tgt_ids array<int>")
    assert validate_fit(df.limit(1), 8, "error").count() == 1
    with pytest.raises(Exception, match="too long"):
        validate_fit(df, 8, "error").collect()


def test_scratch_needs_a_shared_folder_off_local_masters(monkeypatch):
    import pytest

    from bitext import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return Conf()

    class Spark:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Spark())


def test_entry_contract(spark):
    import __spark_entry__ as E

    out = E.entry(spark)
    assert out.count() == 7
    assert set(E.oracle_sql()) <= set(E.queries())
