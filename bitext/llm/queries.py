"""One registered query per operator, over its whole table, and DuckDB twins where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from bitext.llm import bytebpe, cascade, collocations, decontam, fim, htmltext, quality, secrets, simhash, suffixdedup, toxicity, urlfilter, warc
from bitext.session import scratch_path

VOCAB = "byte_bpe_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item: (doc_id, item_id, similarity, first_word)."""
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(_table(spark, sf_dir, "pages"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCAB)
    return bytebpe.round_trip(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_archives(_table(spark, sf_dir, "pages"), path)
    read = warc.read_archives(spark, path, payloads=False).where("kind = 'record'")
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(VOCAB)
    found = secrets.scan(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    base = joined(F.filter("spans", lambda s: s["kind"] != "random"))
    return found.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
        F.sha2(base.cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(_table(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cascade.judge(_table(spark, sf_dir, "documents"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.fill_in_middle(_table(spark, sf_dir, "documents"), output=False)


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_url_filter, op3_byte_bpe, op4_warc, op5_quality,
        op6_secrets, op7_html_text, op8_quality_rules, op9_simhash_dedup, op10_suffix_dedup,
        op11_collocations, op12_toxicity, op13_fill_in_middle,
    )
} | {"pipeline": corpus_pipeline.run}

WARC_SQL = f"""
WITH rows AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
holders AS (SELECT html, max(page_id) AS holder FROM rows WHERE strlen(html) >= {warc.MIN_REVISIT_BYTES} GROUP BY html)
SELECT r.page_id, strlen(r.html) AS payload_bytes, sha1(r.html) AS payload_digest,
  CASE WHEN h.holder <> coalesce(r.page_id, h.holder - 1) THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN h.holder <> coalesce(r.page_id, h.holder - 1) THEN h.holder END AS refers_to
FROM rows r LEFT JOIN holders h ON r.html = h.html"""

ORACLE = {
    "op2_url_filter": urlfilter.judge_sql(),
    "op4_warc": WARC_SQL,
    "op8_quality_rules": cascade.judge_sql(),
    "op11_collocations": collocations.mine_sql(),
    "op13_fill_in_middle": fim.fill_sql(),
}
if corpus_pipeline.ORACLE_SQL:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
