"""``W x + b`` with the weights as a table, in blocks.

A weight table that has ``BROADCAST_CELLS`` or fewer cells travels to the tasks, which multiply a
batch of vectors by it: no shuffle.  A larger one is cut into blocks of outputs and
inputs.  Vectors are packed into row blocks, each part of which meets the weight
blocks of its inputs; a task multiplies two matrices at a time, Spark adds the
partial products of a (row block, output block), and vectors come out of their blocks.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from bitext.operators.ranking import ordered_rank
from bitext.session import written

#: Cells of a weight table (eight bytes each) up to which it is sent to all tasks.
BROADCAST_CELLS = 8_000_000
BLOCK = 256  # outputs and inputs of a weight block, vectors of a row block


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix."""
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _rows(matrix: np.ndarray) -> pa.ListArray:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(np.arange(0, (n + 1) * width, width, dtype=np.int32) if width else np.zeros(n + 1, np.int32), pa.array(matrix.ravel()))


def _shape(weights: DataFrame) -> tuple[int, int]:
    got = weights.agg(F.count(F.lit(1)), F.max(F.size("w"))).first()
    return got[0], got[1] or 0


def linear(vectors: DataFrame, weights: DataFrame, key: str, vec: str, relu: bool = False,
           broadcast_cells: int | None = None, block: int = BLOCK) -> DataFrame:
    """``(key, out array<double>)`` for ``weights(out, w array<double>, b)``, outputs in the order of ``out``.

    Null vectors give no row.  ``relu``: negative outputs become 0.
    """
    n_out, n_in = _shape(weights)
    kind = vectors.schema[key].dataType
    x = vectors.select(key, F.col(vec).cast("array<double>").alias("x")).where("x is not null")
    if n_out * (n_in + 1) <= (BROADCAST_CELLS if broadcast_cells is None else broadcast_cells):
        return _by_broadcast(x, weights, key, kind, relu)
    return _by_blocks(x, weights, key, kind, n_out, n_in, relu, block)


def _by_broadcast(x: DataFrame, weights: DataFrame, key: str, kind, relu: bool) -> DataFrame:
    table = weights.select("out", F.col("w").cast("array<double>").alias("w"), "b").toArrow().sort_by("out").combine_chunks()
    w = _matrix(table["w"].combine_chunks()) if table.num_rows else np.zeros((0, 0))
    sent = x.sparkSession.sparkContext.broadcast((w, table["b"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b = sent.value
        for batch in batches:
            if batch.num_rows:
                y = _matrix(batch["x"]) @ w.T + b
                yield pa.RecordBatch.from_arrays([batch[key], _rows(np.maximum(y, 0) if relu else y)], names=[key, "out"])

    return x.mapInArrow(run, f"`{key}` {kind.simpleString()}, out array<double>")


def _by_blocks(x: DataFrame, weights: DataFrame, key: str, kind, n_out: int, n_in: int, relu: bool, block: int) -> DataFrame:
    n_parts = -(-n_in // block)
    # row blocks: keys and, per block of inputs, a matrix
    packed = pa.schema([("rows", pa.string()), ("part", pa.int32()), ("keys", pa.list_(to_arrow_type(kind))), ("x", pa.list_(pa.float64()))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                some = batch.slice(at, block)
                m, keys = _matrix(some["x"]), some[key].to_pylist()
                name = uuid.uuid4().hex
                parts = [m[:, k * block : (k + 1) * block].ravel() for k in range(n_parts)]
                arrays = [name] * n_parts, range(n_parts), [keys] + [[]] * (n_parts - 1), parts
                yield pa.RecordBatch.from_arrays([pa.array(list(a), f.type) for a, f in zip(arrays, packed)], schema=packed)

    fields = f"rows string, part int, keys array<{kind.simpleString()}>, x array<double>"
    rows = written(x.mapInArrow(pack, fields), "row-blocks")  # read twice, with the same names
    places = _numbered(weights, block)
    parts = F.transform(F.sequence(F.lit(0), F.lit(n_parts - 1)), lambda k: F.struct(
        k.alias("part"), F.slice("w", k * block + 1, F.lit(block)).alias("w"), F.when(k == 0, F.col("b")).otherwise(F.lit(0.0)).alias("b")))
    blocks = places.select("outs", "out_no", F.inline(parts)).groupBy("outs", "part").agg(
        F.array_sort(F.collect_list(F.struct("out_no", "w", "b"))).alias("s"))  # block outputs at most
    blocks = blocks.select("outs", "part", F.flatten(F.col("s.w")).alias("w"), F.col("s.b").alias("b"))
    # few different parts: weight blocks go to several salts, row blocks to one of them
    salts = max(1, int(x.sparkSession.conf.get("spark.sql.shuffle.partitions")) // n_parts)
    blocks = blocks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    left = rows.withColumn("salt", F.pmod(F.hash("rows"), F.lit(salts)))
    pairs = left.join(blocks, ["part", "salt"]).select("rows", "outs", "x", "w", "b")
    made = pa.schema([("rows", pa.string()), ("outs", pa.int32()), ("y", pa.binary())])

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = []
            for k in range(batch.num_rows):
                b = batch["b"][k].values.to_numpy()
                w = batch["w"][k].values.to_numpy().reshape(len(b), -1)
                y.append((batch["x"][k].values.to_numpy().reshape(-1, w.shape[1]) @ w.T + b).tobytes())
            yield pa.RecordBatch.from_arrays([batch["rows"], batch["outs"], pa.array(y, pa.binary())], schema=made)

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(y.as_py()) for y in group["y"])
        return pa.table([group["rows"][:1], group["outs"][:1], pa.array([total.tobytes()], pa.binary())], schema=made)

    sums = pairs.mapInArrow(multiply, "rows string, outs int, y binary").groupBy("rows", "outs").applyInArrow(add, "rows string, outs int, y binary")
    whole = sums.groupBy("rows").agg(F.array_sort(F.collect_list(F.struct("outs", "y"))).alias("s"))  # a row block's outputs
    whole = rows.where("part = 0").select("rows", "keys").join(whole, "rows").select("keys", F.col("s.y").alias("y"))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                keys = batch["keys"][k].values
                y = np.hstack([np.frombuffer(b.as_py()).reshape(len(keys), -1) for b in batch["y"][k].values])
                yield pa.RecordBatch.from_arrays([keys, _rows(np.maximum(y, 0) if relu else y)], names=[key, "out"])

    return whole.mapInArrow(unpack, f"`{key}` {kind.simpleString()}, out array<double>")


def _numbered(weights: DataFrame, block: int) -> DataFrame:
    """Outputs numbered in their order, and their block."""
    ranked = ordered_rank(weights.select("out", F.col("w").cast("array<double>").alias("w"), "b"), ["out"], "out_no")
    return ranked.withColumn("outs", F.expr(f"CAST(out_no div {block} AS INT)"))


def feed_forward(vectors: DataFrame, first: DataFrame, second: DataFrame, key: str, vec: str, **sizes) -> DataFrame:
    """``(key, out)``: ``second`` applied to the positive part of ``first`` applied to the vectors."""
    hidden = linear(vectors, first, key, vec, relu=True, **sizes)
    return linear(hidden, second, key, "out", **sizes)
