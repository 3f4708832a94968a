"""Readers for the driver tables and for pair corpora in several layouts."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (Parquet); Catalyst prunes columns and pushes filters."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


#: Estimated bytes of the rows of one task.
SPREAD_BYTES = 2 << 20


def parts_of(df: DataFrame, task_bytes: int) -> int:
    """Tasks of about ``task_bytes`` for the rows of ``df``, as many as there are cores at least."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-size // task_bytes))


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out to tasks of bounded size, all cores at least: one Parquet row group is
    one task, however many cores wait and however much is done with each text.  Dealt by
    all columns, as rows dealt in turn are sorted first."""
    return df.repartition(parts_of(df, SPREAD_BYTES), *df.columns)


PAIR_SCHEMA = "pair_id bigint, src string, tgt string"
_TSV = {"sep": "\t", "header": "true", "escape": '"', "nullValue": "\\N"}


def write_pairs(pairs: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Store a pair corpus as Parquet, JSON lines or TSV (``fmt='tsv'``)."""
    if fmt == "tsv":
        pairs.write.options(**_TSV, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false").csv(path)
    else:
        pairs.write.format(fmt).save(path)


def read_pairs(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """Load a pair corpus from Parquet, JSON lines or TSV (``fmt='tsv'``)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "tsv":
        return reader.options(**(_TSV | options)).csv(path)
    return reader.format(fmt).options(**options).load(path)


def normalize_pairs(df: DataFrame, src: str = "src", tgt: str = "tgt", id_col: str = "pair_id") -> DataFrame:
    """Accept a nested ``translation`` struct or flat language columns; emit
    ``(pair_id, src, tgt)``.  The layout is decided from the schema at plan time."""
    names = set(df.columns)
    if "translation" in names:
        s, t = F.col(f"translation.{src}"), F.col(f"translation.{tgt}")
    elif src in names and tgt in names:
        s, t = F.col(src), F.col(tgt)
    else:
        raise ValueError(f"pair table needs 'translation' or columns {src!r}/{tgt!r}; has {sorted(names)}")
    cols = [F.col(id_col).cast("bigint").alias("pair_id")] if id_col in names else []
    return df.select(*cols, s.cast("string").alias("src"), t.cast("string").alias("tgt"))


def sentences(pairs: DataFrame, side: str) -> DataFrame:
    """One side of a pair table as a sentence table ``(pair_id, text)``."""
    keep = [c for c in ("pair_id",) if c in pairs.columns]
    return pairs.select(*keep, F.col(side).alias("text"))
