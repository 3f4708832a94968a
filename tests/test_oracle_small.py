"""A representative subset of registered queries against their DuckDB twins at sf0.001."""

import duckdb
import pytest

from bitext.sources.tables import TABLES

from conftest import SF001

NAMES = ["funnel", "train_val_split", "epoch_batches", "word_freq", "bpe_train", "bpe_encode",
         "model_rows", "corpus_bleu", "attention_causal", "smoothed_ce", "beam_step", "greedy_decode",
         "attn_entropy", "running_loss", "scan_pairs", "normalize_pairs", "collate", "decoder_mask", "attention_self",
         "linear", "corpus_stats", "stream_prepare", "topk_candidates", "beam_decode", "translate_batch",
         "compare_methods", "roundtrip", "vocab_store", "snapshot_write", "ordered_batches", "detok"]


def norm(v):
    if isinstance(v, float):
        return round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_twin(spark, con, name):
    import __spark_entry__ as E

    df = E.queries()[name](spark, SF001)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = sorted(range(len(dcols)), key=lambda i: dcols[i])
    want = sorted((tuple(norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert len(got) == len(want)
    assert got == want
