"""Exact global ranks and exact "first n" cuts without a global window.

``row_number()`` without ``partitionBy`` moves every row into one task.  Instead:

* the first n rows in the hash order ``md5(seed:key)`` are found by narrowing: a
  histogram over a few hex digits (a partial aggregate) names the digits that hold
  row n, the next histogram looks inside them only, until few enough candidates are
  left to be sorted; the cut is then a literal and the filter is row-local;
* ranks come from a range partitioning on the order columns (Spark samples the
  bounds, so a hot first column is split by the later ones), written once; counts
  per partition give offsets, and rows are numbered inside their partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitext.session import written

DIGITS = 3  # hex digits read by one histogram: at most 4096 rows come back
CANDIDATES = 20_000  # rows that the driver sorts at the end of the narrowing
HASH_DIGITS = 32


def hash_key(seed, *cols) -> Column:
    """``md5('<seed>:<c1>:<c2>…')`` – lowercase hex, so string order = hash order.

    A null is left out with its colon, so a null key has a hash of its own.
    """
    parts = [F.lit(str(seed))] + [(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols]
    return F.md5(F.concat_ws(":", *parts))


def hash_cut(df: DataFrame, key: str, seed, n: int | None = None, fraction: float | None = None):
    """The ``(hash, key)`` of the n-th row in hash order; None when all rows are within,
    ``("", None)`` when none is.  ``fraction``: n is ``int(fraction * rows)``.

    A repeated key has one hash, so its rows are in or out together.
    """
    d = df.select(F.col(key), hash_key(seed, key).alias("_h"))
    prefix = ""
    while True:
        inside = d.where(F.col("_h").startswith(prefix)) if prefix else d
        digits = min(len(prefix) + DIGITS, HASH_DIGITS)
        hist = inside.groupBy(F.substring("_h", 1, digits).alias("b")).agg(F.count(F.lit(1)).alias("n"))
        rows = sorted((r["b"], r["n"]) for r in hist.collect())  # at most 16^DIGITS
        if not prefix:
            total = sum(c for _, c in rows)
            if fraction is not None:
                n = int(fraction * total)
            if n <= 0:
                return "", None
            if n >= total:
                return None
        for prefix, count in rows:
            if n <= count:
                break
            n -= count
        if count <= CANDIDATES:
            last = d.where(F.col("_h").startswith(prefix)).orderBy("_h", key).limit(n).collect()
            return last[-1]["_h"], last[-1][key]
        if digits >= HASH_DIGITS:  # a key with very many rows: counted, not collected
            for row in d.where(F.col("_h") == prefix).groupBy(key).count().orderBy(key).toLocalIterator():
                n -= row["count"]
                if n <= 0:
                    return prefix, row[key]


def hash_first_n(df: DataFrame, key: str, seed, n: int | None = None, flag: str | None = None,
                 fraction: float | None = None, ids: DataFrame | None = None) -> DataFrame:
    """Rows among the first n in hash order (``flag`` given: all rows and a flag column);
    ``ids``: the same keys from a narrow table."""
    cut = hash_cut(df if ids is None else ids, key, seed, n, fraction)
    h = hash_key(seed, key)
    if cut is None:
        cond = F.lit(True)
    else:
        ch, ck = cut  # only null keys have the hash of a null key
        last = F.lit(True) if ck is None else F.col(key) <= F.lit(ck)
        cond = (h < F.lit(ch)) | ((h == F.lit(ch)) & last)
    return df.where(cond) if flag is None else df.withColumn(flag, cond)


HASH_PARTS = 4  # hex digits that deal rows to the partitions of a rank by hash


def ordered_rank(df: DataFrame, cols: Sequence[str], rank_col: str = "rank", partitions: int | None = None) -> DataFrame:
    """0-based rank of each row in the order of ``cols`` (must identify a row).

    The range-partitioned rows are written to the shared folder, as a second
    evaluation could sample other bounds.  Partitions hold neighbouring ranks and
    are as many as Spark's shuffle partitions unless given.
    """
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(partitions, *cols).withColumn("_part", F.spark_partition_id())
    return _numbered(written(ranged, "ranked"), cols, rank_col)


def _numbered(ranged: DataFrame, cols: Sequence[str], rank_col: str) -> DataFrame:
    """Ranks of rows whose ``_part`` counts ranges of ``cols`` upwards."""
    spark, start, starts = ranged.sparkSession, 0, []
    for r in sorted(ranged.groupBy("_part").count().collect()):  # one row per partition
        starts.append((r["_part"], start))
        start += r["count"]
    offsets = F.broadcast(spark.createDataFrame(starts, "_part int, _start bigint"))
    w = Window.partitionBy("_part").orderBy(*cols)
    out = ranged.withColumn("_rn", F.row_number().over(w)).join(offsets, "_part")
    return out.withColumn(rank_col, (F.col("_start") + F.col("_rn") - 1).cast("bigint")).drop("_start", "_rn", "_part")


def hash_rank(df: DataFrame, key: str, seed, rank_col: str = "rank", extra: Sequence = ()) -> DataFrame:
    """0-based rank of each row in the order ``(md5(seed:extra…:key), key)``.

    Hashes are spread evenly, so their first digits are the ranges: nothing is sampled,
    which would evaluate ``df`` a second time.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.conv(F.substring("_h", 1, HASH_PARTS), 16, 10).cast("bigint") * partitions
    dealt = df.withColumn("_h", hash_key(seed, *extra, key)).withColumn("_part", F.floor(at / F.lit(16**HASH_PARTS)).cast("int"))
    return _numbered(written(dealt, "ranked"), ["_h", key], rank_col).drop("_h")
