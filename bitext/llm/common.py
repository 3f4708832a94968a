"""Helpers shared by the operators: Arrow maps over slices, ids, scratch tables."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from bitext.session import scratch_path

#: Rows handled at once inside a task; Arrow batches are bounded in bytes by
#: ``spark.sql.execution.arrow.maxBytesPerBatch``, slices bound Python objects.
SLICE_ROWS = 512


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the executors (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="bitext-"), "bitext-modules.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)


def map_slices(
    df: DataFrame,
    make: Callable[[], Callable[[pa.RecordBatch], dict[str, list]]],
    schema: str | StructType,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """``mapInArrow`` whose function sees slices of at most ``slice_rows`` rows.

    ``make`` runs once per task and returns the function, so caches and tables
    live as long as the task.  The function returns one list (or Arrow array)
    per output column.
    """
    ship(df.sparkSession)
    if isinstance(schema, str):
        schema = _parse_datatype_string(schema)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            for at in range(0, batch.num_rows, slice_rows):
                out = fn(batch.slice(at, slice_rows))
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in ((out[f.name], f) for f in arrow)],
                    schema=arrow,
                )

    return df.mapInArrow(run, schema)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns under the operator's own names; ids (``*_id``) as long, the rest of texts as string."""
    kinds = {"text": "string", "html": "string", "url": "string"}

    def cast(new: str) -> Column:
        kind = "long" if new.endswith("_id") else kinds.get(new)
        return df[columns[new]].cast(kind) if kind else df[columns[new]]

    return df.select(*[cast(new).alias(new) for new in columns])


def kept(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: the lineage ends here."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2 (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))
