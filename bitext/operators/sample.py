"""Seeded samples, exact splits, batches, limits and arg-max."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitext.operators import ranking as R

# Fixed values.
SEED = 42
TRAIN_FRACTION = 0.9
BATCH_SIZE = 32


def sample_n(df: DataFrame, key: str, n: int, seed=SEED) -> DataFrame:
    """Exactly ``min(n, rows)`` rows: the first n in the seeded hash order."""
    return R.hash_first_n(df, key, seed, n)


def split_exact(df: DataFrame, key: str = "pair_id", fraction: float = TRAIN_FRACTION, seed=SEED,
                split_col: str = "split", ids: DataFrame | None = None) -> DataFrame:
    """Adds ``split`` = 'train' for exactly ``int(fraction * rows)`` rows, else 'val'.

    The first rows of the seeded hash order go to train; a row-local filter, so
    nothing is shuffled.  Disjoint and complete by construction.  ``ids`` may give the
    rows' keys where reading them from ``df`` is dear.
    """
    flagged = R.hash_first_n(df, key, seed, flag="_train", fraction=fraction, ids=ids)
    return flagged.withColumn(split_col, F.when(F.col("_train"), "train").otherwise("val")).drop("_train")


def subset(df: DataFrame, keys: DataFrame, key: str = "pair_id") -> DataFrame:
    """Restrict a table to a set of keys (left semi join; Spark picks the strategy)."""
    return df.join(keys.select(key), key, "left_semi")


def assign_batches(df: DataFrame, key: str = "pair_id", size: int = BATCH_SIZE, seed=SEED, epoch: int = 0,
                   shuffle: bool = True) -> DataFrame:
    """Adds ``rank`` and ``batch_id = rank div size`` (last batch may be partial).

    ``shuffle``: per-epoch hash order of ``(seed, epoch, key)``; otherwise key order.
    """
    if shuffle:
        ranked = R.hash_rank(df, key, seed, rank_col="rank", extra=(F.lit(epoch),))
    else:
        ranked = R.ordered_rank(df, [key], rank_col="rank")
    return ranked.withColumn("batch_id", F.expr(f"rank div {int(size)}"))


def limit_batches(df: DataFrame, n: int, batch_col: str = "batch_id") -> DataFrame:
    """The first ``n`` batches (a filter on an already assigned batch id)."""
    return df.where(F.col(batch_col) < n)


def argmax(df: DataFrame, part, value: str, item: str) -> DataFrame:
    """Best ``item`` per key: highest ``value``, ties to the smallest item.

    A plain aggregate (partial + final), so a hot key is pre-combined map-side.
    """
    part = [part] if isinstance(part, str) else list(part)
    # the smallest of (-value, item)
    return df.groupBy(*part).agg(F.min(F.struct((-F.col(value)).alias("v"), F.col(item).alias("i")))["i"].alias(item))
