"""SimHash near-dedup by deletion-variant signatures.

A fingerprint has 64 bits.  Two fingerprints within ``max_bits`` differing bits,
cut into ``max_bits // 2 + 1`` segments, have a segment that differs in at most
one bit (were all to differ in two, the total would exceed ``max_bits``).  Such
segments agree once the one bit is blanked, so each fingerprint is indexed under
every segment with every single bit blanked (64 keys in all), fingerprints that
meet under a key are verified by their true bit distance, and links become
components.

Scale: equal fingerprints are folded into one row before anything is indexed, so
groups of exact copies of any size cost one row.  A key's members are never
turned into pairs: a task walks its sorted rows and grows components inside a
key, emitting at most one link per member.  A key's members are held as 8-byte
words, and each frontier is compared only with what no component has reached.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitext.llm.common import kept, map_slices, pick

SEED = 42
#: Fingerprints compared at once against the unvisited members of a key.
BLOCK = 256
#: Keys up to this many members are compared all keys at once, larger ones by `grow`.
SMALL = 64


def shingles(text: str | None, size: int) -> list[bytes]:
    """Word shingles with repeats: A-Z lower-cased, words cut at ASCII white space."""
    words = (text or "").encode().lower().split()
    if not words:
        return []
    if len(words) < size:
        return [b" ".join(words)]
    return list(map(b" ".join, zip(*[words[i:] for i in range(size)])))


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set (bit 0 = lowest)."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None, size: int) -> int:
    """Bits set in over half the shingle hashes; 0 for a text without words."""
    grams = shingles(text, size)
    if not grams:
        return 0
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), grams), np.uint64, len(grams))
    bits = bit_counts(hashes) * 2 > len(grams)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, digest: bool = False) -> DataFrame:
    """(doc_id, fp[, sum]): the 64-bit fingerprint as a signed long; null text = no words = 0.

    ``sum`` (with ``digest``) tells texts apart.
    """

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            fps = np.array([fingerprint(t, size) for t in batch["text"].to_pylist()], np.uint64)
            out = {"doc_id": batch["doc_id"], "fp": pa.array(fps.view(np.int64))}
            return out | {"sum": batch["sum"]} if digest else out

        return run

    rows = pick(docs, doc_id=id_col, text=text_col)
    if digest:
        rows = rows.withColumn("sum", _digest(F.col("text")))
    return map_slices(rows, make, "doc_id long, fp long" + ", sum binary" * digest)


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, bits) of the segments, so many that one differs in at most one bit."""
    n = max_bits // 2 + 1
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _variants(max_bits: int):
    """Per task: every fingerprint under each segment with each bit blanked."""
    keep, tags = [], []
    for first, n in segments(max_bits):
        for bit in range(first, first + n):
            keep.append(((1 << n) - 1 << first) & ~(1 << bit))
            tags.append(bit)  # the blanked bit names segment and position
    keep, tags = np.array(keep, np.uint64), np.array(tags, np.int32)

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            fp = batch["fp"].to_numpy(zero_copy_only=False)
            masked = fp.view(np.uint64)[:, None] & keep[None, :]
            return {
                "blank": pa.array(np.tile(tags, len(fp))),
                "masked": pa.array(masked.ravel().view(np.int64)),
                "fp": pa.array(np.repeat(fp, len(tags))),
            }

        return run

    return make


def grow(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """For distinct fingerprints, the position of each one's component leader.

    Breadth first: each frontier is compared with what is not yet visited, so
    a dense group costs little more than one pass over its members.
    """
    leader = np.full(len(fps), -1)
    rest = np.arange(len(fps))
    while len(rest):
        seed, rest = rest[0], rest[1:]
        leader[seed] = seed
        front = np.array([seed])
        while len(front) and len(rest):
            part, front = front[:BLOCK], front[BLOCK:]
            near = np.zeros(len(rest), bool)
            for one in fps[part]:
                near |= np.bitwise_count(fps[rest] ^ one) <= max_bits
            hit, rest = rest[near], rest[~near]
            leader[hit] = seed
            front = np.concatenate([front, hit])
    return leader


def _links(max_bits: int):
    """Rows sorted by key -> one link per member of a component to its leader."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def solve(blank, masked, fp) -> pa.RecordBatch | None:
        cut = np.flatnonzero((np.diff(blank) != 0) | (np.diff(masked) != 0)) + 1
        starts, ends = np.concatenate([[0], cut]), np.concatenate([cut, [len(fp)]])
        size, words = ends - starts, fp.view(np.uint64)
        group = np.repeat(np.arange(len(size)), size)
        # which keys hold a link at all: members d rows apart, all keys at once
        linked = size > SMALL
        for d in range(1, min(int(size.max()), SMALL)):
            left = np.flatnonzero((group[:-d] == group[d:]) & (size[group[d:]] <= SMALL))
            near = np.bitwise_count(words[left] ^ words[left + d]) <= max_bits
            linked[group[left[near]]] = True
        a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for s, e in zip(starts[linked].tolist(), ends[linked].tolist()):
            lead = grow(words[s:e], max_bits)
            own = np.flatnonzero(lead != np.arange(e - s))
            a.append(fp[s:e][lead[own]]), b.append(fp[s:e][own])
        a, b = np.concatenate(a), np.concatenate(b)
        if not len(a):
            return None
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], schema=out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)]
        for batch in batches:
            rows = [np.concatenate([h, c.to_numpy(zero_copy_only=False)]) for h, c in zip(held, batch.columns)]
            blank, masked, _ = rows
            if not len(blank):
                continue
            # the last key may go on in the next batch
            open_ = (blank == blank[-1]) & (masked == masked[-1])
            at = len(blank) - int(np.argmin(open_[::-1])) if not open_.all() else 0
            if at and (got := solve(*[r[:at] for r in rows])) is not None:
                yield got
            held = [r[at:] for r in rows]
        if len(held[0]) and (got := solve(*held)) is not None:
            yield got

    return run


def links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """(a, b): links that join every two fingerprints within ``max_bits`` (as
    components; a dense group gets one link per member, not all pairs).

    ``fps``: column ``fp``, distinct values.
    """
    rows = map_slices(fps.select("fp"), _variants(max_bits), "blank int, masked long, fp long", 4096)
    dealt = rows.repartition("blank", "masked").sortWithinPartitions("blank", "masked")
    return dealt.mapInArrow(_links(max_bits), "a long, b long").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node of each node's component, for nodes with an edge.

    Alternating large-star and small-star rounds: every round links each node's
    neighbours to the smallest of them, until nothing changes; the number of
    rounds grows with the logarithm of a component's length.  Nodes without an
    edge are not returned.
    """
    spark = edges.sparkSession
    now = kept(spark, edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "cc")
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u")
        nxt = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        nxt = kept(spark, nxt.where("u <> v").distinct(), "cc")
        settled = nxt.join(now, ["u", "v"], "left_anti").union(now.join(nxt, ["u", "v"], "left_anti")).isEmpty()
        now = nxt
        if settled:
            break
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, max_bits: int = 4
) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` differing bits, itself included.  Null or wordless texts have
    fingerprint zero and link like any other; repeated rows give repeated rows;
    a null id is carried along and never chosen unless its whole component has
    none; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    rows = kept(spark, fingerprints(docs, id_col, text_col, size), "fp")
    classes = kept(spark, rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fp-class")
    # node = fingerprint; components first, then the smallest document of each
    roots = kept(spark, components(links(classes, max_bits)), "fp-root")
    named = roots.join(classes, roots.node == classes.fp).select("node", "root", "first")
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    merged = named.join(least, "root").select(F.col("node").alias("fp"), "least")
    label = classes.join(merged, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id"))
    return rows.join(label, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


#: Columns that tell the rows of a table apart by id and text.
OWN = ["__none", "__id", "__sum"]


def _row_key(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    number = docs[id_col].cast("long")
    values = (number.isNull(), F.coalesce(number, F.lit(0)), _digest(docs[text_col]))
    return [v.alias(name) for v, name in zip(values, OWN)]


def _digest(text: Column) -> Column:
    """128 bits of a text; a null text has no bytes at all."""
    return F.coalesce(F.unhex(F.md5(text.cast("string").cast("binary"))), F.lit(b""))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, max_bits: int = 4) -> DataFrame:
    """The first row of ``docs`` of each component, by id (null after all others) and then text (null first), all columns kept.

    Rows are judged one by one, so two texts under one id, or without one, may
    be in different components.  A repeated row (same id and text) is a copy of
    itself, so one of them stays.
    """
    spark = docs.sparkSession
    key = ["none", "id", "sum"]  # a row's id and text
    prints = fingerprints(docs, id_col, text_col, size, digest=True)
    rows = kept(spark, prints.select("fp", F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "sum"), "near")
    # of each fingerprint the smallest id with the number of its texts, one of them and how many rows have that
    texts = rows.groupBy("fp", *key).agg(F.count("*").alias("n"))
    by_id = texts.groupBy("fp", "none", "id").agg(F.count("*").alias("texts"), F.min(F.struct("sum", "n")).alias("one"))
    classes = by_id.groupBy("fp").agg(F.min(F.struct("none", "id", "texts", "one")).alias("first")).select("fp", "first.*")
    classes = kept(spark, classes, "near-class")
    roots = kept(spark, components(links(classes, max_bits)), "near-root")
    root = F.coalesce("root", "fp").alias("root")
    named = kept(spark, classes.join(roots, classes.fp == roots.node, "left").select(root, *classes.columns), "near-named")
    by_id = named.groupBy("root", "none", "id").agg(F.sum("texts").alias("texts"), F.min("one").alias("one"))
    first = by_id.groupBy("root").agg(F.min(F.struct("none", "id", "texts", "one")).alias("first")).select("root", "first.*")
    first = kept(spark, first, "near-first")
    stay = first.where("texts = 1").select("none", "id", "one.sum", "one.n")
    own = docs.select("*", *_row_key(docs, id_col, text_col))
    tied = first.where("texts > 1").select("root", "none", "id")
    if not tied.isEmpty():
        # several texts under the smallest id: only theirs are compared
        some = texts.join(named.select("root", "fp"), "fp").join(tied, ["root", "none", "id"])
        some = kept(spark, some.select("root", *[F.col(c).alias(f"__{c}") for c in key], "n"), "near-tied")
        least = own.select(*OWN, F.col(text_col).cast("string").alias("__text")).join(some, OWN)
        least = least.groupBy("root").agg(F.min(F.struct(F.col("__text").isNotNull(), "__text", *OWN, "n")).alias("row"))
        stay = stay.unionByName(least.select(*[F.col(f"row.__{c}").alias(c) for c in key], "row.n"))
    stay = kept(spark, stay.select(*[F.col(c).alias(f"__{c}") for c in key], "n"), "near-stay")
    out = own.join(stay.drop("n"), OWN, "left_semi")
    if not stay.where("n > 1").isEmpty():
        out = out.dropDuplicates(OWN)
    return out.drop(*OWN)
