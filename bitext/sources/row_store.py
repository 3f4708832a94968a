"""Rows looked up by position: files hold neighbouring ranks, an index names their bounds.

``write_rows`` sorts rows into files by rank; the index ``(file, first, last, rows)``
is one row per file, read from the files themselves.  ``read_rows`` picks the files
in Spark and opens those only, so a lookup reads as many files as its positions
touch and not the table.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_FILE = 100_000
#: Positions of one lookup (a batch or some); more are a join, not a lookup.
MAX_POSITIONS = 100_000


def write_rows(df: DataFrame, path: str, rank_col: str = "rank", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write ``df`` to ``path/rows`` in the order of ``rank_col`` and its index to ``path/index``.

    ``rank_col`` counts the rows from 0 without gaps, so the file of a row is known
    from its rank: no sampling of bounds.  The index comes last, a folder without
    one is an unfinished store.
    """
    spark = df.sparkSession
    total = (df.agg(F.max(rank_col)).first()[0] or 0) + 1
    files = -(-total // rows_per_file)
    dealt = df.withColumn("_file", F.expr(f"{rank_col} div {rows_per_file}"))
    # ranks of one file meet in one task; a task may write several files, one after the other
    tasks = min(files, max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))
    dealt = dealt.repartitionByRange(tasks, "_file") if tasks > 1 else dealt.coalesce(1)
    dealt.sortWithinPartitions("_file", rank_col).write.option("maxRecordsPerFile", rows_per_file).mode("overwrite").parquet(f"{path}/rows")
    stored = spark.read.schema(dealt.schema).parquet(f"{path}/rows")
    index = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(rank_col).alias("first"), F.max(rank_col).alias("last"), F.count(F.lit(1)).alias("rows")
    )
    index.coalesce(1).sortWithinPartitions("first").write.mode("overwrite").parquet(f"{path}/index")


def files_of(spark: SparkSession, path: str, positions: Iterable[int]) -> list[str]:
    """The files that hold these positions, at most one a position."""
    wanted = sorted(set(positions))
    if len(wanted) > MAX_POSITIONS:
        raise ValueError(f"a lookup takes at most {MAX_POSITIONS} positions; join with the stored rows")
    if not wanted:
        return []
    at = F.broadcast(spark.createDataFrame([(p,) for p in wanted], "p bigint"))
    index = spark.read.parquet(f"{path}/index").where((F.col("last") >= wanted[0]) & (F.col("first") <= wanted[-1]))
    found = index.join(at, (F.col("p") >= F.col("first")) & (F.col("p") <= F.col("last")), "left_semi")
    return sorted(r["file"] for r in found.select("file").collect())


def read_rows(spark: SparkSession, path: str, positions: Iterable[int], rank_col: str = "rank") -> DataFrame:
    """The rows at these positions; positions that the store does not have give none."""
    wanted = sorted(set(positions))
    files = files_of(spark, path, wanted)
    stored = spark.read.schema(spark.read.parquet(f"{path}/rows").schema)
    rows = stored.parquet(*files) if files else stored.parquet(f"{path}/rows").where(F.lit(False))
    return rows.where(F.col(rank_col).isin(wanted)).drop("_file")
