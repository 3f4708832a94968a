"""Resumable preparation as Structured Streaming.

New pair files in a folder are cleaned, word-filtered and laid out (row-local
operators, no state) and appended to a Parquet sink.  ``availableNow`` processes what has
arrived and stops; the checkpoint records finished files, so a later run picks
up only new ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as Ty

from bitext.operators.clean import MAX_WORDS, clean_kept

PAIR_SCHEMA = Ty.StructType([
    Ty.StructField("pair_id", Ty.LongType()),
    Ty.StructField("src", Ty.StringType()),
    Ty.StructField("tgt", Ty.StringType()),
])


def prepare_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, max_words: int = MAX_WORDS,
                   schema: Ty.StructType = PAIR_SCHEMA, layout: Callable[[DataFrame], DataFrame] | None = None,
                   files_per_trigger: int | None = None):
    """Run one ``availableNow`` pass over the files not yet processed.

    ``layout`` maps kept pairs to model rows (encode, token filter, arrays).  Without
    ``files_per_trigger`` a micro-batch takes up to Spark's default number of files.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    out = clean_kept(reader.parquet(in_dir), max_words)
    out = layout(out) if layout is not None else out
    q = (out.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q
