"""Benchmark decontamination by SimHash of item-sized windows.

For every benchmark item of n words, every n-word window of a text that could be
a copy of it gets a 64-bit SimHash of its weighted 5-word shingles.  Items are
kept in a multi-index: a fingerprint is cut into four blocks of 16 bits, and two
fingerprints within ``RADIUS`` bits have a block that differs in no more bits
than its share of the radius (``slacks``), so looking up each block with that
slack finds every item within the radius.  What is found is verified by the exact
weighted similarity of the shingles (sum of minima over sum of maxima of their
counts).

Windows without a shingle of an item of their size have similarity zero and get
no fingerprint.  Texts stay where they are: the items are broadcast, in chunks
of a bounded size, one pass over the texts for each chunk.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitext.llm.common import map_slices, pick, ship
from bitext.llm.simhash import SEED

SHINGLE = 5
SIMILARITY = 0.8
#: Differing bits up to which windows are verified.  At similarity 0.8, the least that
#: counts, fingerprints differ in about 10 bits of 64, with a deviation of 3: of windows
#: just there 99 % and more are within the radius (test), of better ones almost all.
RADIUS = 17
BLOCKS = 4
BLOCK_BITS = 64 // BLOCKS
#: Pairs of a window and a listed item that a lookup holds at once.
CELLS = 1 << 20
#: Bytes of item texts that one broadcast holds.
CHUNK_BYTES = 16 << 20
_PUNCTUATION = b".,;:!?\"'()[]{}<>|*#$%&_~`^=+/\\-"
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """A-Z lower-cased, ASCII punctuation dropped, cut at ASCII white space."""
    return (text or "").encode().lower().translate(None, _PUNCTUATION).split()


def grams(words: list) -> list[tuple]:
    """5-word shingles with repeats; of fewer words the whole sequence."""
    if not words:
        return []
    if len(words) < SHINGLE:
        return [tuple(words)]
    return list(zip(*[words[i:] for i in range(SHINGLE)]))


def similarity(a: list[bytes], b: list[bytes]) -> float:
    """Weighted similarity of two word lists (0 if either has none)."""
    x, y = Counter(grams(a)), Counter(grams(b))
    if not x or not y:
        return 0.0
    return sum((x & y).values()) / sum((x | y).values())


def _bits(hashes: np.ndarray) -> np.ndarray:
    return np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _pack(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=-1, bitorder="little").reshape(-1, 8).view("<u8").ravel()


def _hash(words: list[bytes]) -> np.ndarray:
    joined = [b" ".join(g) for g in grams(words)]
    return np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), joined), np.uint64, len(joined))


def slacks(radius: int) -> list[int]:
    """Bits by which each block may differ, so that of two fingerprints within the radius one
    block does: were all to differ in more, the total would be above the radius."""
    each, more = divmod(radius, BLOCKS)
    return [each if b <= more else each - 1 for b in range(BLOCKS)]


class MultiIndex:
    """Distinct fingerprints listed by each of their blocks, with slack for the radius."""

    def __init__(self, fps: np.ndarray, radius: int = RADIUS):
        self.radius = radius
        # equal fingerprints are one entry with several members
        self.fps, member = np.unique(fps, return_inverse=True)
        self.members = np.argsort(member, kind="stable")
        self.first = np.searchsorted(member[self.members], np.arange(len(self.fps) + 1))
        every = np.arange(1 << BLOCK_BITS)
        self.blocks = []
        for slack, part in zip(slacks(radius), self._parts(self.fps).T):
            rows = np.argsort(part, kind="stable")
            start = np.searchsorted(part[rows], np.arange((1 << BLOCK_BITS) + 1))
            near = every[np.bitwise_count(every) <= slack].astype(np.uint16)
            self.blocks.append((slack, rows, start, np.unique(part), near))

    @staticmethod
    def _parts(fps: np.ndarray) -> np.ndarray:
        return fps.astype("<u8").view("<u2").reshape(-1, BLOCKS)

    def _listed(self, values: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, value in the block) for values in the block's table within its slack."""
        slack, _, start, held, near = self.blocks[block]
        if len(near) < len(held):  # many values: those near a query's are looked up
            values = values[:, None] ^ near[None, :]
            query, at = np.nonzero(start[values.astype(np.int64) + 1] > start[values])
            return query, values[query, at]
        query, at = np.nonzero(np.bitwise_count(values[:, None] ^ held[None, :]) <= slack)
        return query, held[at]

    def candidates(self, fps: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, entry) that share a block within its slack, at most about ``CELLS`` at once; a pair
        comes once for each such block."""
        parts = self._parts(fps)
        for block, (_, rows, start, held, near) in enumerate(self.blocks):
            step = max(1, CELLS // max(min(len(held), len(near)), 1))
            for low in range(0, len(fps), step):
                query, value = self._listed(parts[low : low + step, block], block)
                begin = start[value]
                size = start[value.astype(np.int64) + 1] - begin
                ends = np.cumsum(size)
                at = 0
                while at < len(query):  # lists, as many as fit, one at least
                    done = ends[at - 1] if at else 0
                    to = max(int(np.searchsorted(ends, done + CELLS, "right")), at + 1)
                    n = size[at:to]
                    place = np.arange(int(n.sum())) + np.repeat(begin[at:to] - (ends[at:to] - n - done), n)
                    yield low + np.repeat(query[at:to], n), rows[place]
                    at = to

    def within(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, member) for every member within the radius of a query."""
        found = [np.empty(0, np.int64)]
        for query, entry in self.candidates(fps):
            ok = np.bitwise_count(fps[query] ^ self.fps[entry]) <= self.radius
            found.append(query[ok] * len(self.fps) + entry[ok])
        key = np.unique(np.concatenate(found))
        query, entry = key // len(self.fps), key % len(self.fps)
        n = self.first[entry + 1] - self.first[entry]
        place = np.arange(int(n.sum())) + np.repeat(self.first[entry] - (np.cumsum(n) - n), n)
        return np.repeat(query, n), self.members[place]


@dataclass
class Hit:
    item_id: int
    similarity: float
    first_word: int


class Finder:
    """Items prepared for lookup; ``find`` gives the items that a text holds."""

    def __init__(self, items: list[tuple[int, str]], radius: int = RADIUS, least: float = SIMILARITY):
        self.least = least
        self.ids = [i for i, _ in items]
        self.words = [words_of(t) for _, t in items]
        self.number: dict[bytes, int] = {}
        for w in (w for ws in self.words for w in ws):
            self.number.setdefault(w, len(self.number) + 1)
        fps = np.array([self._fingerprint(_hash(w)) for w in self.words], np.uint64)
        self.of_size: dict[int, np.ndarray] = {}
        for size in {len(w) for w in self.words} - {0}:
            self.of_size[size] = np.array([k for k, w in enumerate(self.words) if len(w) == size])
        self.index = {size: MultiIndex(fps[k], radius) for size, k in self.of_size.items()}
        # keys of shingles, with the sizes of the items that hold them
        pairs = set()
        for w in self.words:
            if len(w) >= SHINGLE:
                pairs.update((int(k), len(w)) for k in self._keys(self._numbers(w)))
        self.key = np.array(sorted({k for k, _ in pairs}), np.uint64)
        self.sizes: dict[int, set[int]] = {}
        for k, size in pairs:
            self.sizes.setdefault(k, set()).add(size)
        self.short = sorted(s for s in self.of_size if s < SHINGLE)

    @staticmethod
    def _fingerprint(hashes: np.ndarray) -> int:
        return int(_pack(_bits(hashes).sum(axis=0, dtype=np.int64) * 2 > len(hashes))[0]) if len(hashes) else 0

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        get = self.number.get
        return np.fromiter((get(w, 0) for w in words), np.uint64, len(words))

    @staticmethod
    def _keys(numbers: np.ndarray) -> np.ndarray:
        n = len(numbers) - SHINGLE + 1
        key = np.zeros(n, np.uint64)
        for i in range(SHINGLE):
            key = (key ^ numbers[i : i + n]) * _SPREAD
            key ^= key >> np.uint64(29)
        return key

    def find(self, text: str | None) -> list[Hit]:
        """The best window for each item that the text holds, by item."""
        words = words_of(text)
        best: dict[int, Hit] = {}
        n = len(words)
        if n >= SHINGLE and len(self.key):
            numbers = self._numbers(words)
            known = numbers > 0
            run = np.flatnonzero(np.logical_and.reduce([known[i : n - SHINGLE + 1 + i] for i in range(SHINGLE)]))
            if len(run):
                keys = np.zeros(len(run), np.uint64)
                for i in range(SHINGLE):
                    keys = (keys ^ numbers[run + i]) * _SPREAD
                    keys ^= keys >> np.uint64(29)
                at = np.minimum(np.searchsorted(self.key, keys), len(self.key) - 1)
                ok = self.key[at] == keys
                seeds, keys = run[ok], keys[ok]
                by_size: dict[int, list[int]] = {}
                for p, k in zip(seeds.tolist(), keys.tolist()):
                    for size in self.sizes[k]:
                        by_size.setdefault(size, []).append(p)
                for size, places in by_size.items():
                    self._windows(words, size, np.array(places), best)
        for size in self.short:  # items of under five words: the whole sequence is the shingle
            for k in self.of_size[size]:
                want = self.words[k]
                for p in range(n - size + 1):
                    if words[p : p + size] == want:
                        self._keep(best, k, 1.0, p)
                        break
        return [best[k] for k in sorted(best)]

    def _keep(self, best: dict, k: int, sim: float, at: int) -> None:
        if sim >= self.least and (k not in best or sim > best[k].similarity):
            best[k] = Hit(self.ids[k], sim, at)

    def _windows(self, words: list[bytes], size: int, seeds: np.ndarray, best: dict) -> None:
        """Fingerprint every ``size``-word window that holds a seed; look up and verify."""
        n = len(words)
        size_here = min(size, n)  # a shorter text is one window
        last = n - size_here
        # starts of windows that hold a seed: marked as ranges
        edge = np.zeros(last + 2, np.int32)
        np.add.at(edge, np.clip(seeds - (size_here - SHINGLE), 0, last), 1)
        np.add.at(edge, np.minimum(seeds, last) + 1, -1)
        starts = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
        held = self.of_size[size]
        # runs of starts, so that a text with few seeds is not hashed whole
        for run in np.split(starts, np.flatnonzero(np.diff(starts) > size_here) + 1):
            for at in range(0, len(run), 2048):
                part = run[at : at + 2048]
                lo, hi = int(part[0]), int(part[-1]) + size_here
                hashes = _hash(words[lo:hi])
                total = np.zeros((len(hashes) + 1, 64), np.int32)
                np.cumsum(_bits(hashes), axis=0, out=total[1:])
                first = part - lo
                count = size_here - SHINGLE + 1
                fps = _pack((total[first + count] - total[first]) * 2 > count)
                query, member = self.index[size].within(fps)
                for q, m in zip(query.tolist(), member.tolist()):
                    p = int(part[q])
                    self._keep(best, int(held[m]), similarity(words[p : p + size_here], self.words[held[m]]), p)


def chunks(items: DataFrame, id_col: str, text_col: str, limit: int = CHUNK_BYTES):
    """Items in lists of at most ``limit`` bytes of text; null texts hold nothing to find."""
    held, size = [], 0
    for row in pick(items, item_id=id_col, text=text_col).where("text is not null").toLocalIterator():
        held.append((row["item_id"], row["text"]))
        size += len(row["text"].encode())
        if size >= limit:
            yield held
            held, size = [], 0
    if held:
        yield held


def contaminated(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, similarity, first_word): which texts hold which items.

    One row per text and item whose best window reaches ``SIMILARITY``;
    ``first_word`` is that window's first word.  Texts and items that are null
    or have no words hold and give nothing; repeated rows give repeated rows;
    an empty table on either side gives an empty result.
    """
    spark, rows = docs.sparkSession, pick(docs, doc_id=id_col, text=text_col)
    schema = "doc_id long, item_id long, similarity double, first_word long"
    out = None
    for chunk in chunks(items, item_col, item_text_col):
        part = _search(rows, spark.sparkContext.broadcast(chunk), schema)
        out = part if out is None else out.unionAll(part)
    return out if out is not None else spark.createDataFrame([], schema)


def _search(rows: DataFrame, shared, schema: str) -> DataFrame:
    def make():
        finder = Finder(shared.value)

        def run(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"doc_id": [], "item_id": [], "similarity": [], "first_word": []}
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                for hit in finder.find(text):
                    out["doc_id"].append(doc_id)
                    out["item_id"].append(hit.item_id)
                    out["similarity"].append(hit.similarity)
                    out["first_word"].append(hit.first_word)
            return out

        return run

    return map_slices(rows, make, schema)


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns kept; judged where they stand, without a join."""
    ship(docs.sparkSession)
    for chunk in chunks(items, item_col, item_text_col):
        docs = docs.where(~_holds(docs.sparkSession.sparkContext.broadcast(chunk))(F.col(text_col)))
    return docs


def _holds(shared):
    @F.pandas_udf("boolean")
    def holds(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        finder = Finder(shared.value)
        for texts in parts:
            yield pd.Series([bool(finder.find(t)) for t in texts], dtype=bool)

    return holds
