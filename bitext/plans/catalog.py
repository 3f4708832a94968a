"""Registry of named queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each query reads the driver tables (or fixtures Spark derives from them) in
full; the matching DuckDB twin lives in ``bitext.plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


def r6(c):
    """Round doubles to 6 places so both engines agree on the last bits."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), 6)


def r6a(c):
    c = F.col(c) if isinstance(c, str) else c
    return F.transform(c, lambda x: F.round(x.cast("double"), 6))


# import the query modules so they register themselves
from bitext.plans import q_decode, q_eval, q_layout, q_misc, q_prepare, q_tokenize, q_vectors  # noqa: E402,F401
