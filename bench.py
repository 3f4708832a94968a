"""Headline queries at ``$BENCH_SF_DIR`` (default sf0.1) on ``local[$BENCH_CPUS]``.

Each query runs cold (trained tokenizers that a session remembers are dropped)
and is executed with the ``noop`` sink, so the whole plan runs and nothing is
collected.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "funnel",            # sample -> clean -> word filter -> exact split -> token filter
    "bpe_train",         # word counts + merge rounds on word types
    "filter_token_length",  # two tokenizers + encode both sides + token filter
    "model_rows",        # full layout of every kept pair
    "corpus_bleu",       # n-gram match counts + corpus BLEU
    "attention_causal",  # multi-head causal attention over the embeddings, heads merged
    "greedy_decode",     # pointer-doubling greedy decode of the validation split
    "beam_decode",       # beam search (k=4, 3-gram block) of the validation split
    "stream_prepare",    # two-drop availableNow streaming preparation with layout
]


def main():
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    from bitext.plans import catalog, q_tokenize
    from bitext.session import checkpoint_dir, local_session

    spark = local_session(cpus, shuffle_partitions=int(cpus) * 2, app="bitext-bench")
    checkpoint_dir(spark)
    # warm the JVM once (class loading, codegen caches) on a tiny table
    spark.read.parquet(f"{sf}/region.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        q_tokenize._TRAINED.clear()
        t0 = time.time()
        df = catalog.QUERIES[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    total = round(sum(times.values()), 3)
    # pairs prepared per second through the preparation funnel (input rows / time)
    n_pairs = catalog.QUERIES["scan_pairs"](spark, sf).count()
    out = {
        "metric": "headline_total_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""),
        "pairs": n_pairs,
        "prepare_pairs_per_sec": round(n_pairs / times["funnel"], 1) if "funnel" in times else None,
        "cpus": cpus,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
