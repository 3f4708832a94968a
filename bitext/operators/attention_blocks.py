"""Attention outputs block by block, for sequences of any length.

Every query block of a sequence (``block`` positions) is one unit of work.  Keys and
values go to the query blocks that may see them, Spark sorts each unit by position,
and a task reads it as a stream: the queries first, then the keys a block at a time.
Per query it keeps the largest score so far, the sum of weights and the weighted
vector, all three rescaled whenever a larger score comes.  No table of (row, column)
cells exists, memory is a query block and a key block, and the only shuffle is the
one that brings a unit together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

BLOCK = 256  # query positions of a unit, and keys that are read at once


class _Unit:
    """The queries of a unit and their running sums over the keys read so far."""

    def __init__(self, key, h: int, causal: bool, block: int):
        self.key, self.h, self.causal, self.block = key, h, causal, block
        self.pos, self.q, self.waiting, self.n_waiting = [], [], [], 0
        self.top = None

    def add(self, kind: int, pos: np.ndarray, x: np.ndarray) -> None:
        if kind == 0:
            self.pos.append(pos)
            self.q.append(x)
            return
        for at in range(0, len(pos), self.block):
            self.waiting.append((pos[at : at + self.block], x[at : at + self.block]))
            self.n_waiting += len(self.waiting[-1][0])
            if self.n_waiting >= self.block:
                self._read()

    def _heads(self, x: np.ndarray) -> np.ndarray:
        return x.reshape(len(x), self.h, -1).transpose(1, 0, 2)

    def _read(self) -> None:
        if not self.waiting:
            return
        pos, x = (np.concatenate(a) for a in zip(*self.waiting))
        self.waiting, self.n_waiting = [], 0
        if self.top is None and not self.q:  # keys of a sequence without queries
            return
        if self.top is None:
            self.pos = np.concatenate(self.pos)
            q = np.concatenate(self.q)
            self.q = self._heads(q) / np.sqrt(q.shape[1] // self.h)
            self.top = np.full(self.q.shape[:2], -np.inf)
            self.sum = np.zeros(self.q.shape[:2])
            self.out = np.zeros(self.q.shape)
        k = self._heads(x)
        score = self.q @ k.transpose(0, 2, 1)
        if self.causal:
            score = np.where(pos[None, :] <= self.pos[:, None], score, -np.inf)
        top = np.maximum(self.top, score.max(axis=2))
        safe = np.where(np.isfinite(top), top, 0.0)  # no key seen yet
        old = np.exp(self.top - safe)
        weight = np.exp(score - safe[:, :, None])
        self.sum = self.sum * old + weight.sum(axis=2)
        self.out = self.out * old[:, :, None] + weight @ k
        self.top = top

    def done(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions that saw a key, and their outputs with the heads side by side."""
        self._read()
        if self.top is None:
            return np.zeros(0, np.int64), np.zeros((0, 0))
        seen = self.sum[0] > 0
        out = (self.out[:, seen] / self.sum[:, seen, None]).transpose(1, 0, 2)
        return self.pos[seen], out.reshape(int(seen.sum()), -1)


def attention(df: DataFrame, vec: str = "vec", h: int = 8, mask: str = "none", key: str = "seq_id", kv_df: DataFrame | None = None,
              kv_vec: str | None = None, max_len: int | None = None, block: int = BLOCK) -> DataFrame:
    """``(key, pos, vec)``: outputs of all heads side by side, K = V from ``vec`` or from ``kv_df``.

    ``mask``: 'none' or 'causal' (keys up to the query's position).  ``max_len``: a bound
    of the positions, if known; within one block it saves the count of query blocks.
    Queries that may see no key give no row; null vectors are neither queries nor keys.
    """
    if mask not in ("none", "causal"):
        raise ValueError(mask)
    kind = df.schema[key].dataType
    of = F.expr(f"CAST(pos div {block} AS INT)")
    q = df.select(key, F.col("pos").cast("long").alias("pos"), F.col(vec).cast("array<double>").alias("x"))
    source = df if kv_df is None else kv_df
    kv = source.select(key, F.col("pos").cast("long").alias("pos"), F.col(kv_vec or vec).cast("array<double>").alias("x"))
    if max_len is not None and max_len <= block:
        kv = kv.withColumn("unit", F.lit(0))
    else:
        last = q.groupBy(key).agg(F.max(of).alias("last"))
        first = of if mask == "causal" else F.lit(0)
        kv = kv.join(last, key).where(first <= F.col("last")).withColumn("unit", F.explode(F.sequence(first, F.col("last")))).drop("last")
    rows = q.withColumn("unit", of).select(key, "unit", F.lit(0).alias("kind"), "pos", "x").unionByName(
        kv.select(key, "unit", F.lit(1).alias("kind"), "pos", "x"))
    units = rows.where("x is not null").repartition(key, "unit").sortWithinPartitions(key, "unit", "kind", "pos")
    schema = pa.schema([(key, to_arrow_type(kind)), ("pos", pa.int64()), ("vec", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ready = None, []

        def batch_of(ready) -> pa.RecordBatch:
            keys = [k for k, (pos, _) in ready for _ in range(len(pos))]
            outs = [o.ravel() for _, (_, o) in ready]
            width = max((o.shape[1] for _, (_, o) in ready), default=0)
            flat = np.concatenate(outs) if outs else np.zeros(0)
            lists = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, width or 1, dtype=np.int32)[: len(keys) + 1], pa.array(flat))
            return pa.RecordBatch.from_arrays([pa.array(keys, schema.field(0).type), pa.array(np.concatenate([p for _, (p, _) in ready])), lists], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys, unit = batch[key].to_pylist(), batch["unit"].to_numpy(zero_copy_only=False)
            sort, pos = batch["kind"].to_numpy(zero_copy_only=False), batch["pos"].to_numpy(zero_copy_only=False)
            x = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            number = batch[key].dictionary_encode().indices.to_numpy(zero_copy_only=False)
            change = (number[1:] != number[:-1]) | (unit[1:] != unit[:-1]) | (sort[1:] != sort[:-1])
            edges = np.concatenate([[0], np.flatnonzero(change) + 1, [batch.num_rows]])
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                here = (keys[a], int(unit[a]))
                if current is None or current.key != here:
                    if current is not None:
                        ready.append((current.key[0], current.done()))
                    current = _Unit(here, h, mask == "causal", block)
                current.add(int(sort[a]), pos[a:b], x[a:b])
                if sum(len(p) for _, (p, _) in ready) >= 4 * block:
                    yield batch_of(ready)
                    ready = []
        if current is not None:
            ready.append((current.key[0], current.done()))
        if ready:
            yield batch_of(ready)

    fields = f"`{key}` {kind.simpleString()}, pos long, vec array<double>"
    same = df.schema["pos"].dataType.simpleString()
    return units.mapInArrow(run, fields).withColumn("pos", F.col("pos").cast(same))
