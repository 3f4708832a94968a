"""Phrase collocations by counting quotient filters.

Every phrase of two to four frequent words is a packed tuple of word ids.  An
invertible permutation scatters the packed value; its high bits (the quotient)
name a bucket and a slot in it, the rest is kept in full as the remainder, so a
filter of slot runs, remainders and counters is a compact and lossless table of
counts.  Each shard (a bounded run of rows inside a task) builds its filters in
numpy, sorted by quotient and remainder.  Spark brings the filters of a bucket
together, where the sorted runs are merged, and the permutation is undone.

The permutation makes buckets even whatever the words are, and a phrase that
every document holds is one counter per shard.  Lengths are counted one after
the other: a phrase can be frequent only if both phrases of one word less are.
Those are known to the tasks as a bitmap of bounded size, whose false positives
cost counters and never change a result.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bitext.llm.common import kept, ship
from bitext.operators.ranking import ordered_rank

MIN_COUNT = 30  # of a candidate
MAX_WORDS = 4
TOP = 2000  # phrases per language
KEPT_BY = 80  # per cent of a phrase's count that a longer one has to reach to replace it
SCORE_UNIT = 2_000_000
NO_LANG = "und"

FLUSH_WORDS = 300_000  # different words that a task counts before it passes them on
SHARD_GRAMS = 2_000_000  # phrases in one shard's filters
BUCKET_GRAMS = 1_000_000  # counted phrases per bucket, on average at most
#: Frequent words known to every task; rarer ones get their ids by a join.
BROADCAST_WORDS = 1_000_000
BITMAP_BITS = 27  # the bitmap of frequent shorter phrases has at most 2^27 bits (16 MB)

_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
#: A-Z lower-cased, separators of pieces as newlines.
_TABLE = bytes(10 if b in _SEPARATORS else b + 32 if 65 <= b <= 90 else b for b in range(256))
_BREAK = b" . "  # no word is a separator


def tokens(text: str | None) -> list[bytes]:
    """Words in order, ``b"."`` where a piece ends."""
    return (text or "").encode().translate(_TABLE).replace(b"\n", _BREAK).split()


# ----------------------------------------------------------------- words
def word_counts(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``(lang, word, n)`` of all words; with a null word the number of all words of the language."""
    ship(docs.sparkSession)
    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])

    def batch_of(counts: dict[str, Counter]) -> pa.RecordBatch:
        rows = [(lang, word, n) for lang, c in counts.items() for word, n in c.items()]
        totals = [(lang, None, c.total()) for lang, c in counts.items()]
        columns = zip(*rows, *totals)
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = {}
        have = 0
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                counter = counts.setdefault(lang, Counter())
                have -= len(counter)
                counter.update(tokens(text.as_py()))
                counter.pop(b".", None)
                have += len(counter)
                if have > FLUSH_WORDS:
                    yield batch_of(counts)
                    counts, have = {}, 0
        if counts:
            yield batch_of(counts)

    parts = _texts(docs, lang_col, text_col).mapInArrow(run, "lang string, word binary, n long")
    return parts.groupBy("lang", F.col("word").cast("string").alias("word")).agg(F.sum("n").alias("n"))


def _texts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    lang = F.coalesce(docs[lang_col].cast("string"), F.lit(NO_LANG))
    return docs.select(lang.alias("lang"), docs[text_col].cast("string").alias("text"))


def encoded(docs: DataFrame, words: DataFrame, lang_col: str = "lang", text_col: str = "text",
            broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """``(ids array<int>)`` of every row, written: ids of ``words(lang, word, n, id)``, 0 for
    any other word and at the end of a piece or text.

    The commonest words, at most ``broadcast_words``, travel to the tasks; words
    beyond them are joined by (language, word) and put into their rows.
    """
    spark = docs.sparkSession
    ship(spark)
    # counts in steps of a 16th of a doubling: at most 1,024 rows
    step = F.floor(F.log2("n") * 16).cast("int")
    histogram = sorted(words.groupBy(step.alias("step")).count().collect(), reverse=True)
    least, have = 0, 0
    for row in histogram:
        if have + row["count"] > broadcast_words:
            least = row["step"] + 1
            break
        have += row["count"]
    table = words.where(step >= least).select("lang", F.col("word").cast("binary").alias("word"), "id").toArrow()
    sent = spark.sparkContext.broadcast([c.combine_chunks() for c in table.columns])
    name, everything = uuid.uuid4().hex, least == 0
    schema = pa.schema([("lang", pa.string()), ("ids", pa.list_(pa.int32())),
                        ("rest", pa.list_(pa.struct([("pos", pa.int32()), ("word", pa.binary())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _lookup(name, sent)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                langs, ids, rest = part["lang"].to_pylist(), [], []
                for lang, text in zip(langs, part["text"]):
                    found = tokens(text.as_py())
                    found.append(b".")
                    own = np.fromiter(map(lookup.get(lang, {}).get, found, repeat(0)), np.int32, len(found))
                    ids.append(own)
                    rest.append([] if everything else [{"pos": p, "word": found[p]} for p in np.flatnonzero(own == 0).tolist() if found[p] != b"."])
                yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip((langs, ids, rest), schema)], schema=schema)

    out = _texts(docs, lang_col, text_col).mapInArrow(run, "lang string, ids array<int>, rest array<struct<pos: int, word: binary>>")
    if everything:
        return kept(spark, out.select("ids"), "collocation-ids")
    out = kept(spark, out.withColumn("row", F.monotonically_increasing_id()), "collocation-rest")
    rest = out.select("row", "lang", F.inline("rest")).withColumn("word", F.col("word").cast("string"))
    late = rest.join(words.where(step < least).select("lang", "word", "id"), ["lang", "word"])
    late = late.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("pos", "id"))).alias("late"))  # of one text
    ids = F.expr("transform(ids, (x, i) -> coalesce(late[i], x))")
    joined = out.select("row", "ids").join(late, "row", "left")
    return kept(spark, joined.select(F.when(F.col("late").isNull(), F.col("ids")).otherwise(ids).alias("ids")), "collocation-ids")


_LOOKUPS: dict[str, dict[str, dict[bytes, int]]] = {}


def _lookup(name: str, sent) -> dict[str, dict[bytes, int]]:
    """Language -> word -> id of a broadcast table, built once per Python worker."""
    if name not in _LOOKUPS:
        _LOOKUPS.clear()
        lookup: dict[str, dict[bytes, int]] = {}
        for lang, word, i in zip(*[c.to_pylist() for c in sent.value]):
            lookup.setdefault(lang, {})[word] = i
        _LOOKUPS[name] = lookup
    return _LOOKUPS[name]


# ----------------------------------------------------------------- packing and permutation
_KEYS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Packing:
    """``size`` ids of ``width`` bits (31 at most) as two halves of ``half`` bits."""

    size: int
    width: int

    @property
    def half(self) -> int:
        return (self.size * self.width + 1) // 2

    @property
    def single(self) -> bool:
        """Both halves fit one machine word."""
        return 2 * self.half <= 64

    def pack(self, ids: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        high, low = np.zeros(len(ids[0]), np.uint64), np.zeros(len(ids[0]), np.uint64)
        w, h, mask = np.uint64(self.width), np.uint64(self.half), self._mask(self.half)
        for x in ids:
            high = ((high << w) | (low >> (h - w))) & mask
            low = ((low << w) & mask) | x.astype(np.uint64)
        return high, low

    def unpack(self, high: np.ndarray, low: np.ndarray) -> list[np.ndarray]:
        w, h, mask = np.uint64(self.width), np.uint64(self.half), self._mask(self.width)
        ids = []
        for _ in range(self.size):
            ids.append((low & mask).astype(np.int32))
            low = (low >> w) | ((high & mask) << (h - w))
            high = high >> w
        return ids[::-1]

    def permute(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A Feistel network: each round is undone by the same round."""
        for key in _KEYS:
            high, low = low, high ^ self._round(low, key)
        return high, low

    def restore(self, high: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        for key in reversed(_KEYS):
            high, low = low ^ self._round(high, key), high
        return high, low

    def _round(self, x: np.ndarray, key: int) -> np.ndarray:
        x = (x + np.uint64(key >> 7)) * np.uint64(key | 1)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
        return x >> np.uint64(64 - self.half)

    @staticmethod
    def _mask(bits: int) -> np.uint64:
        return np.uint64((1 << bits) - 1)


# ----------------------------------------------------------------- filters
def count_sorted(packing: Packing, high: np.ndarray, low: np.ndarray, counts: np.ndarray | None = None):
    """Distinct keys in order with their counts (summed where ``counts`` is given)."""
    h = np.uint64(packing.half)
    if packing.single:
        key = (high << h) | low
        if counts is None:
            key.sort()
        else:
            order = np.argsort(key, kind="stable")
            key, counts = key[order], counts[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, int)
        high, low = key[first] >> h, key[first] & Packing._mask(packing.half)
        n = len(key)
    else:
        order = np.lexsort((low, high))
        high, low, counts = high[order], low[order], None if counts is None else counts[order]
        n = len(high)
        first = np.flatnonzero(np.append(True, (high[1:] != high[:-1]) | (low[1:] != low[:-1]))) if n else np.zeros(0, int)
        high, low = high[first], low[first]
    if counts is None:
        return high, low, np.diff(np.append(first, n))
    return high, low, np.add.reduceat(counts, first) if n else counts


def _narrow(x: np.ndarray, bits: int) -> bytes:
    """The low bytes that ``bits`` need of every value."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : (bits + 7) // 8]).tobytes()


def _widen(data: memoryview, bits: int, n: int) -> np.ndarray:
    size = (bits + 7) // 8
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(data, np.uint8, n * size).reshape(n, size)
    return out.view("<u8").ravel().astype(np.uint64)


def to_filter(packing: Packing, bucket_bits: int, high: np.ndarray, low: np.ndarray, counts: np.ndarray) -> bytes:
    """A bucket's distinct sorted keys as a counting quotient filter.

    The high bits of a key below the bucket's are its slot.  Stored are the
    length of each slot's run, the remainders in order and a counter byte per
    remainder, with counts of 255 and more in a list behind.
    """
    n = len(high)
    left = packing.half - bucket_bits
    slot_bits = min(left, max(0, n.bit_length() - 1), 24)
    rest_bits = left - slot_bits
    slot = ((high & Packing._mask(left)) >> np.uint64(rest_bits)).astype(np.int64)
    runs = np.bincount(slot, minlength=1 << slot_bits)
    wide = int(runs.max()) > 255
    large = counts >= 255
    head = np.array([n, slot_bits, wide, int(large.sum())], "<i8")
    return b"".join((
        head.tobytes(), runs.astype("<u4" if wide else np.uint8).tobytes(),
        _narrow(high & Packing._mask(rest_bits), rest_bits), _narrow(low, packing.half),
        np.minimum(counts, 255).astype(np.uint8).tobytes(), counts[large].astype("<i8").tobytes(),
    ))


def from_filter(packing: Packing, bucket_bits: int, bucket: int, data: bytes):
    """The keys and counts of ``to_filter``."""
    view = memoryview(data)
    n, slot_bits, wide, n_large = np.frombuffer(view, "<i8", 4).tolist()
    at = 32
    runs = np.frombuffer(view, "<u4" if wide else np.uint8, 1 << slot_bits, at)
    at += runs.nbytes
    left = packing.half - bucket_bits
    rest_bits = left - slot_bits
    rest = _widen(view[at:], rest_bits, n)
    at += n * ((rest_bits + 7) // 8)
    low = _widen(view[at:], packing.half, n)
    at += n * ((packing.half + 7) // 8)
    counts = np.frombuffer(view, np.uint8, n, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(view, "<i8", n_large, at + n)
    slot = np.repeat(np.arange(len(runs), dtype=np.uint64), runs)
    high = (np.uint64(bucket) << np.uint64(left)) | (slot << np.uint64(rest_bits)) | rest
    return high, low, counts


# ----------------------------------------------------------------- counting phrases
def _mixed(high: np.ndarray, low: np.ndarray, bits: int) -> np.ndarray:
    x = (high ^ (low * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x >> np.uint64(64 - bits)


def bitmap(spark: SparkSession, grams: DataFrame, packing: Packing, max_bits: int = BITMAP_BITS):
    """``(bits, words)``: a bitmap in which the bit of every gram is set, broadcast.

    It has 16 bits a gram up to ``2^max_bits`` and is collected as at most
    ``2^(max_bits - 6)`` words of 64 bits.
    """
    bits = min(max(16, (16 * grams.count()).bit_length()), max_bits)
    schema = pa.schema([("at", pa.int32()), ("mask", pa.int64())])

    def run(batches):
        for batch in batches:
            ids = batch["gram"].flatten().to_numpy(zero_copy_only=False).reshape(-1, packing.size)
            at = _mixed(*packing.permute(*packing.pack(list(ids.T))), bits)
            mask = (np.uint64(1) << (at & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).astype(np.int32)), pa.array(mask)], schema=schema)

    words = np.zeros(1 << (bits - 6), np.uint64)
    found = grams.select("gram").mapInArrow(run, "at int, mask long").groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow()
    words[found["at"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return bits, spark.sparkContext.broadcast(words)


def _inside(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0


def count_grams(ids: DataFrame, packing: Packing, total: int, known=None, min_count: int = MIN_COUNT,
                shard_grams: int = SHARD_GRAMS, bucket_grams: int = BUCKET_GRAMS) -> DataFrame:
    """``(gram array<int>, a)`` of the phrases of ``packing.size`` ids with ``a >= min_count``.

    ``total``: an upper bound of the phrases, from which the number of buckets
    follows.  ``known``: the packing and bitmap of the frequent phrases of one
    word less; a phrase is counted only if both of its own are in it.
    """
    size = packing.size
    bucket_bits = min(max(5, (total // bucket_grams).bit_length()), packing.half)
    schema = pa.schema([("bucket", pa.int64()), ("filter", pa.binary())])
    less, (bits, sent) = known if known else (None, (0, None))

    def grams(flat: np.ndarray):
        n = len(flat) - size + 1
        if n <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        ok = flat != 0
        if less is None:
            at = ok[:n].copy()
            for k in range(1, size):
                at &= ok[k : n + k]
        else:
            m = n + 1
            short = ok[:m].copy()
            for k in range(1, size - 1):
                short &= ok[k : m + k]
            where = np.flatnonzero(short)
            short[where] = _inside(sent.value, _mixed(*less.permute(*less.pack([flat[where + k] for k in range(size - 1)])), bits))
            at = short[:n] & short[1:]
        where = np.flatnonzero(at)
        return packing.permute(*packing.pack([flat[where + k] for k in range(size)]))

    def filters(parts) -> pa.RecordBatch:
        high, low, counts = count_sorted(packing, *[np.concatenate(x) for x in zip(*parts)])
        bucket = (high >> np.uint64(packing.half - bucket_bits)).astype(np.int64)
        edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        ends = np.append(edges[1:], len(bucket))
        made = [to_filter(packing, bucket_bits, high[a:b], low[a:b], counts[a:b]) for a, b in zip(edges, ends)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[edges]), pa.array(made, pa.binary())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, have = [], 0
        for batch in batches:
            flat = batch["ids"].flatten().to_numpy(zero_copy_only=False)
            # phrases end at a 0, so a long batch can be cut anywhere if the next part starts size - 1 ids earlier
            for at in range(0, len(flat), shard_grams):
                found = grams(flat[at : at + shard_grams + size - 1])
                if len(found[0]):
                    parts.append(found)
                    have += len(found[0])
                if have >= shard_grams:
                    yield filters(parts)
                    parts, have = [], 0
        if parts:
            yield filters(parts)

    def merge(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
        bucket = key[0].as_py()
        each = [from_filter(packing, bucket_bits, bucket, f.as_py()) for f in group["filter"]]
        high, low, counts = count_sorted(packing, *[np.concatenate(x) for x in zip(*each)])
        keep = counts >= min_count
        ids = np.stack(packing.unpack(*packing.restore(high[keep], low[keep])), axis=1)
        gram = pa.ListArray.from_arrays(np.arange(0, ids.size + 1, size, dtype=np.int32), pa.array(ids.ravel(), pa.int32()))
        return pa.table({"gram": gram, "a": counts[keep]})

    made = ids.mapInArrow(run, "bucket long, filter binary")
    return made.groupBy("bucket").applyInArrow(merge, "gram array<int>, a long")


def _wide(c: Column) -> Column:
    return c.cast("decimal(20,0)")


def mine(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", min_count: int = MIN_COUNT, top: int = TOP,
    kept_by: int = KEPT_BY, broadcast_words: int = BROADCAST_WORDS, bitmap_bits: int = BITMAP_BITS,
    shard_grams: int = SHARD_GRAMS, bucket_grams: int = BUCKET_GRAMS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best ``top`` phrases of each language.

    Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends and
    into words at blanks and tabs.  A phrase of 2 to 4 words that occurs at least
    ``min_count`` times is scored at each cut by floor(2000000 a / (l + r)), the
    lowest cut counts.  A phrase is dropped if a longer candidate around it has
    at least ``kept_by`` per cent of its count; looking one word further is
    enough, as what stands between two candidates is one and no rarer than the
    longer.  A null text has no words, a null language is ``und``, repeated rows
    count again, equal scores go by count and then by the bytes of the phrase; an
    empty table or one without candidates gives no rows.
    """
    spark = docs.sparkSession
    found = kept(spark, word_counts(docs, lang_col, text_col).where(f"word is null or n >= {min_count}"), "collocation-words")
    totals = found.where("word is null").select("lang", "n")
    words = ordered_rank(found.where("word is not null"), ["lang", "word"], "id").withColumn("id", (F.col("id") + 1).cast("int"))
    words = kept(spark, words, "collocation-ids-of-words")
    n_ids = words.count()
    total = int(words.agg(F.sum("n")).first()[0] or 0)
    ids = encoded(docs, words, lang_col, text_col, broadcast_words)
    width = max(16, n_ids.bit_length())
    levels, known = [words.select(F.array("id").alias("gram"), F.col("n").alias("a"))], None
    for size in range(2, MAX_WORDS + 1):
        packing = Packing(size, width)
        grams = kept(spark, count_grams(ids, packing, total, known, min_count, shard_grams, bucket_grams), f"collocations-{size}")
        levels.append(grams)
        if size < MAX_WORDS:
            known = packing, bitmap(spark, grams, packing, bitmap_bits)
    counts = levels[0]
    for grams in levels[1:]:
        counts = counts.unionByName(grams)
    candidates = counts.where(F.size("gram") > 1)

    longer = candidates.where(F.size("gram") > 2).select(
        F.explode(F.array(F.expr("slice(gram, 1, size(gram) - 1)"), F.expr("slice(gram, 2, size(gram) - 1)"))).alias("gram"), "a")
    longer = longer.groupBy("gram").agg(F.max("a").alias("longer"))
    stays = F.col("longer").isNull() | (_wide(F.lit(100)) * _wide(F.col("longer")) < _wide(F.lit(kept_by)) * _wide(F.col("a")))
    left = candidates.join(longer, "gram", "left").where(stays).select("gram", "a")

    cuts = left.select("gram", "a", F.explode(F.expr("sequence(1, size(gram) - 1)")).alias("k"))
    cuts = cuts.select("gram", "a", "k", F.expr("slice(gram, 1, k)").alias("first"), F.expr("slice(gram, k + 1, size(gram))").alias("second"))
    # the first phrase of a cut can be shared by very many candidates: one joined row each, split by Spark where hot
    cuts = cuts.join(counts.select(F.col("gram").alias("first"), F.col("a").alias("l")), "first")
    cuts = cuts.join(counts.select(F.col("gram").alias("second"), F.col("a").alias("r")), "second")
    score = F.expr(f"(cast({SCORE_UNIT} as decimal(8,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    scored = cuts.select("gram", "a", "k", "l", "r", score.cast("long").alias("score"))
    scored = scored.groupBy("gram", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m"))
    scored = scored.select("gram", "a", "m.score", "m.l", "m.r").join(
        words.select("lang", F.col("id").alias("head")), F.col("head") == F.col("gram")[0]).drop("head")
    # what can be among the best, ties included, before words are looked up
    near = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    best = scored.withColumn("place", F.rank().over(near)).where(F.col("place") <= top)
    spelled = best.select("*", F.posexplode("gram").alias("at", "id")).join(words.select("id", "word"), "id")
    spelled = spelled.groupBy("lang", "gram", "a", "l", "r", "score").agg(
        F.array_join(F.expr("transform(array_sort(collect_list(struct(at, word))), x -> x.word)"), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = spelled.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mine_sql(min_count: int = MIN_COUNT, top: int = TOP, kept_by: int = KEPT_BY) -> str:
    """The same in DuckDB's SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    grams = "\nUNION ALL ".join(
        f"SELECT lang, list_slice(w, i, i + {n - 1}) AS gram FROM (SELECT lang, w, unnest(range(1, len(w) - {n - 2})) AS i FROM pieces)"
        for n in range(1, MAX_WORDS + 1)
    )
    return rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^ \t]+') AS w
  FROM (SELECT coalesce(lang, '{NO_LANG}') AS lang,
          unnest(string_split_regex(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\n-\r]')) AS piece FROM documents)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
counts AS (SELECT lang, gram, count(*)::BIGINT AS a FROM ({grams}) GROUP BY lang, gram HAVING count(*) >= {min_count}),
cands AS (SELECT * FROM counts WHERE len(gram) > 1),
longer AS (
  SELECT lang, part, max(a) AS most FROM (
    SELECT lang, unnest([list_slice(gram, 1, len(gram) - 1), list_slice(gram, 2, len(gram))]) AS part, a FROM cands WHERE len(gram) > 2)
  GROUP BY lang, part),
stay AS (
  SELECT c.* FROM cands c LEFT JOIN longer x ON c.lang = x.lang AND c.gram = x.part
  WHERE x.most IS NULL OR 100::HUGEINT * x.most < {kept_by}::HUGEINT * c.a),
cuts AS (SELECT lang, gram, a, unnest(range(1, len(gram))) AS k FROM stay),
scored AS (
  SELECT c.lang, c.gram, c.a, c.k, f.a AS l, s.a AS r, (({SCORE_UNIT}::HUGEINT * c.a) // (f.a::HUGEINT + s.a))::BIGINT AS score
  FROM cuts c JOIN counts f ON f.lang = c.lang AND f.gram = list_slice(c.gram, 1, c.k)
  JOIN counts s ON s.lang = c.lang AND s.gram = list_slice(c.gram, c.k + 1, len(c.gram))),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) AS nth FROM scored),
ranked AS (
  SELECT lang, array_to_string(gram, ' ') AS phrase, a, l, r, score FROM lowest WHERE nth = 1)
SELECT * FROM (
  SELECT o.lang, row_number() OVER (PARTITION BY o.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
  FROM ranked o JOIN totals t ON o.lang = t.lang)
WHERE rank <= {top}"""
