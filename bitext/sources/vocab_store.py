"""Store trained tokenizer tables and reuse them only when the parameters match."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

from bitext.operators import bpe as B


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def save_tokenizer(spark: SparkSession, tok: B.Tokenizer, path: str, params: dict) -> None:
    tok.vocab_df(spark).write.mode("overwrite").parquet(f"{path}/vocab")
    tok.merges_df(spark).write.mode("overwrite").parquet(f"{path}/merges")
    spark.createDataFrame([(json.dumps(params, sort_keys=True),)], "params string").coalesce(1) \
        .write.mode("overwrite").parquet(f"{path}/params")


def load_tokenizer(spark: SparkSession, path: str) -> B.Tokenizer:
    """Read the stored tables (bounded by the vocabulary size) into a Tokenizer."""
    merges = sorted((r["rank"], r["left_tok"], r["right_tok"]) for r in spark.read.parquet(f"{path}/merges").collect())
    vocab = {r["token"]: r["id"] for r in spark.read.parquet(f"{path}/vocab").collect()}
    return B.Tokenizer(merges=[(l, r) for _, l, r in merges], vocab=vocab)


def get_or_build_tokenizer(spark: SparkSession, path: str, sentences: DataFrame, vocab_size: int = 16000,
                           num_merges: int | None = None, text_col: str = "text") -> tuple[B.Tokenizer, bool]:
    """Load the stored tokenizer when its parameters and its corpus equal the requested
    ones, otherwise train and store it.  Returns ``(tokenizer, reused)``."""
    corpus = B.corpus_fingerprint(sentences.select(text_col))
    params = {"vocab_size": vocab_size, "num_merges": num_merges, "corpus": corpus}
    if _exists(spark, f"{path}/params"):
        stored = spark.read.parquet(f"{path}/params").first()["params"]
        if json.loads(stored) == params:
            return load_tokenizer(spark, path), True
    tok = B.train_bpe(sentences, vocab_size=vocab_size, num_merges=num_merges, text_col=text_col)
    save_tokenizer(spark, tok, path, params)
    return tok, False
