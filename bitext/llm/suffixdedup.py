"""Removal of repeated 100-byte strings, by suffix arrays over shards.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts earlier
(in a document of a smaller id, or earlier in the same one).  A document is an id
(null after all others) with a digest of its text: texts that share an id, or have
none, are documents of their own, in the order of their digests.

1. Every string has an anchor: of its ``GRAM``-byte pieces the first with the
   smallest hash.  Equal strings have equal anchors at the same offset, so
   strings can only repeat where anchors do.  Neighbouring strings share an
   anchor; together they span a fragment.  Spark counts anchors (partial sums
   before the shuffle) and keeps the fragments of those that occur twice.
2. Fragments with the same anchor and the same content are folded: all but the
   first of them repeat it wholly.  Copies of a passage, however many, leave one.
3. What is left are anchors with different contexts.  A string reaches at least
   ``SIDE`` bytes to the left of its anchor or more than that to the right, so
   equal strings share the anchor with ``SIDE`` bytes on one side: fragments are
   cut in two and dealt by that longer piece, which short common lines don't fill.
   Equal cuts are folded again as they stream by in order.
4. Cuts that share a piece are packed into shards of a bounded size.  A shard's
   suffix array is built by Larsson-Sadakane refinement (prefix doubling that
   touches unsorted groups only), Kasai's scan gives the common prefixes of
   neighbours, and runs of at least ``WINDOW`` common bytes give each string's
   earliest place.  A piece with more cuts than a shard holds spans several
   shards, whose sorted strings are merged by binary search.
5. An anchor with more than ``HOT_CUTS`` different fragments (a line that very many
   documents hold between different contexts) is dealt to several tasks by the
   content of its cuts.  Each solves its own share and names every different string
   by a 128-bit hash with the earliest place there; Spark finds the earliest of all.
6. The spans go back to their documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitext.llm.common import kept, map_slices, pick, ship

WINDOW = 100
GRAM = 24
#: Starts of strings that are handled at once within a document.
STRETCH = 1 << 17
#: Bytes beside the anchor that equal strings share on one side or the other.
SIDE = (WINDOW - GRAM) // 2
#: Bytes of fragments that one suffix array covers.
SHARD_BYTES = 1 << 19
#: Ids of documents up to which a set of them is broadcast; beyond, a shuffle join.
BROADCAST_IDS = 4_000_000
#: Different fragments of an anchor up to which its cuts stay together in one task.
HOT_CUTS = 8_000
#: Fragments of an anchor beyond which its rows are dealt by place, not by anchor; more
#: where more than ``HOT_ANCHORS`` could have so many.
HOT_ROWS = 10_000
HOT_ANCHORS = 100_000
NO_ID = 2**63 - 1  # stands for a null id: after all others
_SPAN = WINDOW - GRAM + 1  # anchors that a string chooses from


def _tables():
    rng = np.random.default_rng(20240229)
    size = STRETCH + 2 * WINDOW
    out = []
    for _ in range(2):
        value = rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        base = int(rng.integers(0, 2**62)) * 4 + 5
        inverse = pow(base, -1, 1 << 64)
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, base, np.uint64)]), dtype=np.uint64)
        inverses = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size, inverse, np.uint64)]), dtype=np.uint64)
        out.append((value, powers, inverses))
    return out


_HASH = None


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def anchors(data: bytes, content: bool = True) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, fragment hash, first byte, last byte + 1, anchor's byte) of the fragments of a document.

    Without ``content`` only the anchor hash."""
    global _HASH
    if _HASH is None:
        _HASH = _tables()
    whole = np.frombuffer(data, np.uint8)
    starts = len(whole) - WINDOW + 1
    for lo in range(0, max(starts, 0), STRETCH):
        part = whole[lo : min(lo + STRETCH, starts) + WINDOW - 1]
        n, m = len(part), len(part) - GRAM + 1
        sums = []
        for value, powers, _ in _HASH if content else _HASH[:1]:
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(value[part] * powers[:n], out=total[1:])
            sums.append(total)
        gram = _mix((sums[0][GRAM:] - sums[0][:m]) * _HASH[0][2][:m])
        # the smallest of 44 bits of hash, then the leftmost: both in one word
        key = (gram >> np.uint64(20) << np.uint64(20)) | np.arange(m, dtype=np.uint64)
        width = 1
        while width * 2 <= _SPAN:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if width < _SPAN:
            key = np.minimum(key[: -(_SPAN - width)], key[_SPAN - width :])
        at = (key & np.uint64((1 << 20) - 1)).astype(np.int64)  # the anchor of each start
        first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
        own = at[first]
        if not content:
            yield (gram[own],)
            continue
        end = np.concatenate([first[1:] - 1, [len(at) - 1]]) + WINDOW
        whole_hash = (sums[1][end] - sums[1][first]) * _HASH[1][2][first]
        whole_hash = _mix(whole_hash + _mix((end - first).astype(np.uint64) * np.uint64(1 << 20) + (own - first).astype(np.uint64)))
        yield gram[own], whole_hash, first + lo, end + lo, own + lo


# ---- suffix arrays of a shard -----------------------------------------------


def _stable_order(keys: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Stable order of keys under ``most``, and the keys in it: key and place sorted as one word where both fit."""
    n = len(keys)
    low = max(1, (n - 1).bit_length())
    if (most - 1).bit_length() + low > 64:
        by = np.argsort(keys, kind="stable")
        return by, keys[by]
    packed = np.sort(keys.astype(np.uint64) << np.uint64(low) | np.arange(n, dtype=np.uint64))
    return (packed & np.uint64((1 << low) - 1)).astype(np.int64), packed >> np.uint64(low)


def suffix_array(text: np.ndarray, ends: np.ndarray, longest: int) -> np.ndarray:
    """Suffixes of ``text`` in order, each ending with its fragment (``ends`` per byte).

    Larsson-Sadakane: suffixes are ranked by their first 5 bytes, then groups of
    equal rank are split by the rank of the suffix ``depth`` bytes on, doubling
    the depth; sorted suffixes are not touched again.  Suffixes equal up to
    their ends stay in the order of their places.
    """
    n = len(text)
    place = np.arange(n)
    wide = np.concatenate([text.astype(np.uint64) + np.uint64(1), np.zeros(4, np.uint64)])
    key = wide[:n].copy()
    near = np.flatnonzero(ends - place < 5)  # suffixes of fewer bytes
    short = key[near]
    for i in range(1, 5):  # 257 values a byte, so that an end is less than any byte
        key *= np.uint64(257)
        key += wide[i : i + n]
        short = short * np.uint64(257) + np.where(near + i < ends[near], wide[near + i], np.uint64(0))
    key[near] = short
    order, key = _stable_order(key, 257**5)
    head = np.concatenate([[True], key[1:] != key[:-1]])
    group = np.maximum.accumulate(np.where(head, place, 0))
    rank = np.empty(n, np.int32)
    rank[order] = group
    slots, who, depth = place, order, 5
    while True:
        # slots of the order that are not alone in their group
        several = ~(head & np.concatenate([head[1:], [True]]))
        slots, who, group = slots[several], who[several], group[several]
        if depth >= longest or not len(slots):
            return order
        on = who + depth
        then = np.where(on < ends[who], rank[np.minimum(on, n - 1)] + 1, 0)
        by, mixed = _stable_order(group * np.int64(n + 1) + then, n * (n + 1) + n + 1)
        order[slots] = who = who[by]
        head = np.concatenate([[True], mixed[1:] != mixed[:-1]])
        group = np.maximum.accumulate(np.where(head, slots, 0))
        rank[who] = group
        depth *= 2


def common_prefixes(text: np.ndarray, order: np.ndarray, first: np.ndarray, size: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Kasai: bytes that each suffix shares with its predecessor in ``order``, by place.

    The length drops by at most one from a place to the next.  Fragments (from
    ``first``, ``size`` long) advance together, one place of each at a time.
    """
    n = len(text)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int64)
    length = np.zeros(len(first), np.int64)
    for j in range(int(size.max()) if len(size) else 0):
        here = np.flatnonzero(size > j)
        place = first[here] + j
        other = before[place]
        run = np.maximum(length[here] - 1, 0)
        run[other < 0] = 0
        most = np.where(other < 0, 0, np.minimum(ends[place] - place, ends[other] - other))
        go = np.flatnonzero(run < most)
        while len(go):
            same = text[place[go] + run[go]] == text[other[go] + run[go]]
            go = go[same]
            run[go] += 1
            go = go[run[go] < most[go]]
        length[here] = run
        shared[place] = run
    return shared


class Shard:
    """Fragments with their suffix array: distinct strings in order, each with its earliest place."""

    def __init__(self, docs: np.ndarray, los: np.ndarray, parts: list[bytes]):
        size = np.array([len(p) for p in parts], np.int64)
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        self.text = np.frombuffer(b"".join(parts), np.uint8)
        ends = np.repeat(first + size, size)
        order = suffix_array(self.text, ends, int(size.max()))
        shared = common_prefixes(self.text, order, first, size, ends)
        # only suffixes that hold a whole string
        whole = ends[order] - order >= WINDOW
        low = shared[order]
        places = order[whole]
        head = low[whole] < WINDOW
        skipped = np.flatnonzero(whole)
        if len(skipped):  # a shorter suffix in between breaks a run only if it shares less
            head[1:] = np.minimum.reduceat(low[: skipped[-1] + 1], skipped[:-1] + 1) < WINDOW if len(skipped) > 1 else head[1:]
            head[0] = True
        self.group = (np.cumsum(head) - 1).astype(np.int32)
        owner = np.repeat(np.arange(len(parts)), size)[places]
        self.doc, self.start = docs[owner], los[owner] + places - first[owner]
        # groups follow one another: the earliest place of each is the least of one word a place
        leads = np.flatnonzero(head)
        if len(leads) and self.doc.max() < 1 << 23 and self.start.max() < 1 << 40:
            least = np.minimum.reduceat(self.doc << 40 | self.start, leads)
            self.least_doc, self.least_start = least >> 40, least & (1 << 40) - 1
        else:
            by = np.lexsort((self.start, self.doc, self.group))
            lead = by[leads]
            self.least_doc, self.least_start = self.doc[lead], self.start[lead]
        self.sample = places[leads].astype(np.int32)

    def strings(self) -> np.ndarray:
        """The distinct strings in order, as rows of big-endian words that compare like them."""
        rows = np.zeros((len(self.sample), -(-WINDOW // 8) * 8), np.uint8)
        rows[:, :WINDOW] = np.lib.stride_tricks.sliding_window_view(self.text, WINDOW)[self.sample]
        return rows.view(">u8").astype(np.uint64)

    def repeats(self) -> tuple[np.ndarray, np.ndarray]:
        """(doc, start) of every string here that also starts earlier."""
        late = (self.doc != self.least_doc[self.group]) | (self.start != self.least_start[self.group])
        return self.doc[late], self.start[late]


def _less(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise a < b of word rows."""
    differ = a != b
    at = differ.argmax(axis=1)
    rows = np.arange(len(a))
    return differ.any(axis=1) & (a[rows, at] < b[rows, at])


def find_rows(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Binary search of each row in a sorted table: its index, or -1."""
    low, high = np.zeros(len(rows), np.int64), np.full(len(rows), len(table), np.int64)
    while (open_ := low < high).any():
        mid = (low + high) // 2
        less = np.zeros(len(rows), bool)
        less[open_] = _less(table[mid[open_]], rows[open_])
        low = np.where(open_ & less, mid + 1, low)
        high = np.where(open_ & ~less, mid, high)
    ok = low < len(table)
    ok[ok] = (table[low[ok]] == rows[ok]).all(axis=1)
    return np.where(ok, low, -1)


def merge(shards: list[Shard]) -> None:
    """Give equal strings of different shards their common earliest place."""
    for a in range(len(shards)):
        table = shards[a].strings()  # two shards' strings at a time
        for b in range(a + 1, len(shards)):
            x, y = shards[a], shards[b]
            at = find_rows(table, y.strings())
            mine = np.flatnonzero(at >= 0)
            at = at[mine]
            earlier = (y.least_doc[mine] < x.least_doc[at]) | ((y.least_doc[mine] == x.least_doc[at]) & (y.least_start[mine] < x.least_start[at]))
            for field in ("least_doc", "least_start"):
                one, two = getattr(x, field), getattr(y, field)
                least = np.where(earlier, two[mine], one[at])
                one[at], two[mine] = least, least


def _runs(doc: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Covered bytes of the strings at (doc, start), overlapping ones joined."""
    if not len(doc):
        return doc, start, start
    by = np.lexsort((start, doc))
    doc, start = doc[by], start[by]
    head = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] > start[:-1] + WINDOW)])
    last = np.concatenate([np.flatnonzero(head)[1:] - 1, [len(doc) - 1]])
    return doc[head], start[head], start[last] + WINDOW


def _solve(rows: list[tuple], strings: list | None = None) -> tuple[list[tuple], np.ndarray, np.ndarray]:
    """(key, part, doc, lo[, sum]) of whole keys -> spans of the strings that start earlier elsewhere.

    ``strings`` gets (hash, name, start) of the earliest place of every different string.
    """
    names = sorted({(r[2], *r[4:]) for r in rows})
    rank = {name: i for i, name in enumerate(names)}
    shards, at = [], 0
    while at < len(rows):
        end, held = at, 0
        while end < len(rows) and held < SHARD_BYTES:
            held += len(rows[end][1])
            end += 1
        part = rows[at:end]
        shards.append(Shard(np.array([rank[(r[2], *r[4:])] for r in part]), np.array([r[3] for r in part]), [r[1] for r in part]))
        at = end
    if len(shards) > 1:
        merge(shards)
    if strings is not None:
        for s in shards:
            data, at = s.text.tobytes(), s.sample.tolist()
            hashes = [xxhash.xxh3_128_digest(data[a : a + WINDOW]) for a in at]
            strings += zip(hashes, [names[i] for i in s.least_doc.tolist()], s.least_start.tolist())
    found = [s.repeats() for s in shards]
    doc, lo, hi = _runs(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
    return [names[i] for i in doc.tolist()], lo, hi


def _shard_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, part, doc, lo[, sum[, share]]), in order with ``sum`` before ``lo`` -> spans
    of strings that start earlier elsewhere.

    A row equal to the one before it in key, share and part repeats it wholly; of the
    others, keys with a single one have nothing to repeat.  Of keys in several shares
    (``share`` not negative) the different strings come too, with their ``hash``.
    """
    def table(names, lo, hi, hashes=None) -> pa.RecordBatch:
        cols = {"doc": pa.array([n[0] for n in names], pa.int64()), "lo": pa.array(lo, pa.int64()), "hi": pa.array(hi, pa.int64())}
        if width > 4:
            cols["sum"] = pa.array([n[1] for n in names], pa.int64())
        if width > 5:
            cols["hash"] = pa.array(hashes if hashes is not None else [None] * len(names), pa.binary())
        return pa.RecordBatch.from_pydict(cols)

    def share(row: tuple) -> int:
        return row[5] if width > 5 else -1

    def one_of_many(key: list[tuple]) -> Iterator[pa.RecordBatch]:
        """Shares of hot keys, in pieces of bounded size: spans and strings."""
        for at in range(0, len(key), HOT_CUTS):
            strings: list = []
            yield table(*_solve([r[:5] for r in key[at : at + HOT_CUTS]], strings))
            if strings:
                hashes, names, starts = zip(*strings)
                yield table(names, starts, [x + WINDOW for x in starts], list(hashes))

    width = 4
    ready: list[tuple] = []  # rows of keys with several parts
    size = 0
    many: list[tuple] = []  # rows of shares of hot keys, most of them small: one suffix array for many
    held = 0
    key: list[tuple] = []  # rows of the key at hand
    for batch in batches:
        copies: tuple[list, list, list] = ([], [], [])
        width = batch.num_columns
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            same = key and row[0] == key[-1][0] and share(row) == share(key[-1])
            if same and row[1] == key[-1][1]:
                if row[2:] != key[-1][2:]:  # the very same place is no copy
                    for to, x in zip(copies, ((row[2], *row[4:5]), row[3], row[3] + len(row[1]))):
                        to.append(x)
                continue
            if key and not same:
                if share(key[0]) >= 0:
                    many += key
                    held += sum(len(r[1]) for r in key)
                elif len(key) > 1:
                    ready += [r[:5] for r in key]
                    size += sum(len(r[1]) for r in key)
                key = []
                if held >= SHARD_BYTES:
                    yield from one_of_many(many)
                    many, held = [], 0
                if size >= SHARD_BYTES:
                    yield table(*_solve(ready))
                    ready, size = [], 0
            elif key and share(row) >= 0 and len(key) >= 2 * HOT_CUTS:
                yield from one_of_many(key[:-1])  # its strings meet the rest's by their hashes
                key = key[-1:]
            key.append(row)
        if copies[0]:
            yield table(*copies)
    if key and share(key[0]) >= 0:
        many += key
    elif len(key) > 1:
        ready += [r[:5] for r in key]
    if many:
        yield from one_of_many(many)
    if ready:
        yield table(*_solve(ready))


# ---- Spark ------------------------------------------------------------------


def _bytes_of(batch: pa.RecordBatch) -> list[bytes]:
    return [(t or "").encode() for t in batch["text"].to_pylist()]


def _fragments(rows: DataFrame) -> DataFrame:
    """(anchor, content, doc, sum, lo, shape) of every fragment of every document; ``shape``
    holds the fragment's size and, in its low byte, the anchor's place within."""

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            found: list[list[np.ndarray]] = [[], [], [], [], [], []]
            for doc, digest, data in zip(batch["doc"].to_pylist(), batch["sum"].to_pylist(), _bytes_of(batch)):
                for a, c, lo, hi, own in anchors(data):
                    shape = (hi - lo) << 8 | (own - lo)
                    for to, x in zip(found, (a.view(np.int64), c.view(np.int64), np.full(len(a), doc), np.full(len(a), digest), lo, shape)):
                        to.append(x)
            cols = [np.concatenate(x) if x else np.empty(0, np.int64) for x in found]
            kinds = (*[pa.int64()] * 5, pa.int32())
            return {n: pa.array(x, k) for n, x, k in zip(("anchor", "content", "doc", "sum", "lo", "shape"), cols, kinds)}

        return run

    return map_slices(rows, make, "anchor long, content long, doc long, sum long, lo long, shape int", 256)


def _anchor_counts(rows: DataFrame) -> DataFrame:
    """(anchor, n): fragments of every anchor, those of some documents already summed up."""

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            found = [x[0] for data in _bytes_of(batch) for x in anchors(data, content=False)]
            anchor, n = np.unique(np.concatenate(found) if found else np.empty(0, np.uint64), return_counts=True)
            return {"anchor": pa.array(anchor.view(np.int64)), "n": pa.array(n, pa.int64())}

        return run

    return map_slices(rows.select("text"), make, "anchor long, n long", 1024).groupBy("anchor").agg(F.sum("n").alias("n"))


def cuts(part: bytes, own: int) -> Iterator[tuple[int, int, bytes]]:
    """(key, first byte, bytes) of a fragment's cuts: strings that reach at least
    ``SIDE`` bytes to the left of the anchor at ``own``, and the others."""
    last = len(part) - WINDOW  # the last string's start
    left = own - SIDE
    if left >= 0:
        piece = part[left : own + GRAM]
        yield xxhash.xxh64_intdigest(piece, seed=1), 0, part[: min(left, last) + WINDOW]
    right = max(0, left + 1)
    if right <= last:
        piece = part[own : own + WINDOW - SIDE + 1]
        yield xxhash.xxh64_intdigest(piece, seed=2), right, part[right:]


def _parts(rows: DataFrame, wanted: DataFrame, hot_cuts: int) -> DataFrame:
    """(key, part, doc, lo, sum, share): the cuts of wanted fragments, taken from their documents.

    Cuts of an anchor with many (``k``) different fragments get a share by their content, others -1.
    """

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"key": [], "part": [], "doc": [], "lo": [], "sum": [], "share": []}
            for doc, digest, data, want in zip(batch["doc"].to_pylist(), batch["sum"].to_pylist(), _bytes_of(batch), batch["want"].to_pylist()):
                for w in want:
                    part = data[w["lo"] : w["lo"] + (w["shape"] >> 8)]
                    shares = -(-w["k"] // hot_cuts)
                    for key, at, cut in cuts(part, w["shape"] & 255):
                        out["key"].append(key - (1 << 63))
                        out["part"].append(cut)
                        out["doc"].append(doc)
                        out["sum"].append(digest)
                        out["lo"].append(w["lo"] + at)
                        out["share"].append(xxhash.xxh64_intdigest(cut, seed=3) % shares if shares > 1 else -1)
            return out

        return run

    by_doc = wanted.groupBy("doc", "sum").agg(F.collect_set(F.struct("lo", "shape", "k")).alias("want"))
    ids = _bounded(wanted.select("doc").distinct())  # of a wanted document or another of its id
    # a repeated row has the same bytes: one is enough
    some = (rows.join(ids, "doc", "left_semi") if ids is not None else rows).dropDuplicates(["doc", "sum"])
    return map_slices(some.join(by_doc, ["doc", "sum"]).select("doc", "sum", "text", "want"), make, "key long, part binary, doc long, lo long, sum long, share long", 64)


def _bounded(ids: DataFrame) -> DataFrame | None:
    """The ids as a broadcast side if they are few enough, else None."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else None


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, lo, hi, sum): bytes covered by a string that starts earlier (spans may overlap).

    ``doc`` is the id, a null id counting after all others.  Texts under
    ``WINDOW`` bytes and null texts have none.  Rows that repeat an id and its text
    (``sum`` is its digest) are one document: a repeated row isn't an earlier copy of itself.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = _documents(docs, id_col, text_col)
    every = _fragments(rows)
    twice = kept(spark, _anchor_counts(rows).where("n > 1"), "anchors")
    # rows of a hot anchor are known to stay and are dealt by their place; such anchors are HOT_ANCHORS at most
    least = max(HOT_ROWS, (twice.agg(F.sum("n")).first()[0] or 0) // HOT_ANCHORS)
    hot = twice.where(F.col("n") > least).select("anchor", F.lit(True).alias("hot"))
    marked = every.join(F.broadcast(hot), "anchor", "left")
    marked = marked.withColumn("at", F.when(F.col("hot"), F.xxhash64("doc", "sum", "lo")).otherwise(F.col("anchor")))
    some = marked.join(twice.select(F.col("anchor").alias("at"), "n"), "at", "left").where("hot OR n IS NOT NULL")
    some = kept(spark, some.select(*every.columns), "fragments")
    classes = kept(
        spark,
        some.groupBy("anchor", "content").agg(F.min(F.struct("doc", "sum", "lo", "shape")).alias("first"), F.count("*").alias("n")),
        "fragment-classes",
    )
    # copies of a fragment beyond the first
    again = classes.where("n > 1").select("anchor", "content", F.col("first.doc").alias("doc0"), F.col("first.sum").alias("sum0"), F.col("first.lo").alias("lo0"))
    copies = (
        some.join(again, ["anchor", "content"])
        .where((F.col("doc") != F.col("doc0")) | (F.col("sum") != F.col("sum0")) | (F.col("lo") != F.col("lo0")))
        .select("doc", "lo", (F.col("lo") + F.shiftright("shape", 8)).alias("hi"), "sum")
    )
    # anchors whose fragments differ
    mixed = kept(spark, classes.groupBy("anchor").agg(F.count("*").alias("k")).where("k > 1"), "anchors-mixed")
    wanted = kept(spark, classes.join(mixed, "anchor").select("anchor", "first.*", "k"), "fragment-wanted")
    parts = _parts(rows, wanted, HOT_CUTS)
    dealt = parts.repartition("key", "share").sortWithinPartitions("key", "share", "part", "doc", "sum", "lo")
    dealt = dealt.select("key", "part", "doc", "lo", "sum", "share")
    found = dealt.mapInArrow(_shard_spans, "doc long, lo long, hi long, sum long, hash binary")
    spans = ["doc", "lo", "hi", "sum"]
    if (wanted.agg(F.max("k")).first()[0] or 0) <= HOT_CUTS:
        return copies.unionAll(found.select(*spans))
    # the same string in several shares: all places but the earliest
    found = kept(spark, found, "spans-found")
    strings = found.where("hash IS NOT NULL")
    first = strings.groupBy("hash").agg(F.min(F.struct("doc", "sum", "lo")).alias("first"), F.count("*").alias("times")).where("times > 1")
    late = strings.join(first, "hash").where(F.struct("doc", "sum", "lo") != F.col("first"))
    return copies.unionAll(found.where("hash IS NULL").select(*spans)).unionAll(late.select(*spans))


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = pick(docs, doc_id=id_col, text=text_col)
    return rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("sum"), "doc_id", "text")


def _kept(data: bytes, lo: np.ndarray, hi: np.ndarray) -> tuple[bytes, int, int]:
    """(remaining bytes, bytes removed, maximal removed runs)."""
    if not len(lo):
        return data, 0, 0
    by = np.argsort(lo, kind="stable")
    lo, far = lo[by], np.maximum.accumulate(np.minimum(hi[by], len(data)))
    first = np.concatenate([[0], np.flatnonzero(lo[1:] > far[:-1]) + 1])
    los, his = lo[first], far[np.concatenate([first[1:] - 1, [len(lo) - 1]])]
    edges = [0, *np.stack([los, his], axis=1).ravel().tolist(), len(data)]
    return b"".join([data[a:b] for a, b in zip(edges[::2], edges[1::2])]), int((his - los).sum()), len(first)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", content: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept]) for every row of ``docs``.

    Texts are taken as UTF-8 bytes (null: empty); ``kept`` (with ``content``)
    are the remaining bytes.  An empty table gives an empty result.
    """
    spark = docs.sparkSession
    spans = kept(spark, repeated_spans(docs, id_col, text_col), "spans")
    by_doc = kept(spark, spans.groupBy("doc", "sum").agg(F.collect_set(F.struct("lo", "hi")).alias("spans")), "spans-by-doc")
    rows = _documents(docs, id_col, text_col)
    names = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") + ("kept",) * content

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {n: [] for n in names}
            at, lo, hi = np.zeros(batch.num_rows + 1, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
            if "spans" in batch.schema.names:  # of all rows in one array; a null list has no length
                lists = batch["spans"]
                at, (lo, hi) = lists.offsets.to_numpy(), (lists.values.field(n).to_numpy() for n in ("lo", "hi"))
            for doc_id, data, a, b in zip(batch["doc_id"].to_pylist(), _bytes_of(batch), at[:-1].tolist(), at[1:].tolist()):
                rest, removed, runs = _kept(data, lo[a:b], hi[a:b])
                row = (doc_id, len(data), removed, runs, hashlib.sha256(rest).hexdigest(), rest)
                for name, value in zip(names, row):
                    out[name].append(value)
            return out

        return run

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * content
    ids = _bounded(by_doc.select("doc").distinct())
    if ids is None:
        return map_slices(rows.join(by_doc, ["doc", "sum"], "left").select("doc_id", "text", "spans"), make, schema, 128)
    # documents without a span stay where they are
    clean = rows.join(ids, "doc", "left_anti").select("doc_id", "text")
    cut = rows.join(ids, "doc", "left_semi").join(by_doc, ["doc", "sum"], "left").select("doc_id", "text", "spans")
    return map_slices(clean, make, schema, 128).unionAll(map_slices(cut, make, schema, 128))
