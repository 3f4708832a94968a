"""BPE training for large vocabularies: many merges per Spark job.

A round of the plain trainer takes the commonest adjacent pair of all words.  Here a
round takes as many merges as can be proved to be those of the plain trainer:

1. Spark keeps the counts of all pairs.  The driver asks for the commonest ones, the
   *active* pairs, and the count of the next one, the *floor*.
2. Each word is cut where two neighbours are no active pair.  Spark sums the pieces
   over all words; their number is bounded by ``max_pieces`` (fewer pairs are asked
   for when there would be more, more of them when there is room).
3. On the pieces the driver runs plain merges with an inverted index from pairs to
   pieces and a priority queue that is brought up to date lazily.  What was cut away
   can only give pairs whose counts are bounded by the floor, so merges are final as
   long as the best pair is above that bound; then the round ends.
4. Spark applies the round's merges, in order, to the words that hold them and adds
   the changed words' differences to the pair counts.

The commonest pairs stand in nearly all words, so the first rounds are short; later
ones take hundreds of merges.  A symbol that two different merges make has several
kinds of neighbours among what was cut away, which raises the bound (``_Bound``).
"""

from __future__ import annotations

import heapq
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bitext.operators import bpe as B
from bitext.session import written

MAX_PIECES = 200_000  # pieces that one round brings to the driver
FIRST_ACTIVE = 256  # active pairs of the first round
ACTIVE_A_MERGE = 4  # active pairs for each merge that is asked for, where few are
MAX_ACTIVE = 20_000

Pair = tuple[str, str]


# ----------------------------------------------------------------- merges of a round
class _Bound:
    """What the pairs that were cut away can sum up to.

    Next to a cut stand symbols of the round's start.  A symbol remembers with which
    of them it can begin and end; a pair's unseen count is at most the floor for each
    combination.  With one combination a pair is counted in full or not at all.
    """

    def __init__(self, floor: int):
        self.floor = floor
        self.begins: dict[str, set[str]] = {}
        self.ends: dict[str, set[str]] = {}
        self.most_begins = self.most_ends = 1

    def made(self, pair: Pair, existed: bool) -> None:
        left, right = pair
        new = left + right
        begins = self.begins.get(left, {left}) | self.begins.get(new, set())
        ends = self.ends.get(right, {right}) | self.ends.get(new, set())
        if existed and new not in self.begins:
            begins, ends = begins | {new}, ends | {new}
        self.begins[new], self.ends[new] = begins, ends
        self.most_begins = max(self.most_begins, len(begins))
        self.most_ends = max(self.most_ends, len(ends))

    def kinds(self, pair: Pair) -> int:
        return len(self.ends.get(pair[0], (pair[0],))) * len(self.begins.get(pair[1], (pair[1],)))

    def unseen(self) -> int:
        """No pair that is not counted at all has more than this."""
        return self.floor * self.most_ends * self.most_begins


def merge_symbols(symbols: list[str], pair: Pair) -> list[str]:
    """Every occurrence of the pair merged, left to right, without overlaps."""
    left, right = pair
    out, i, last = [], 0, len(symbols) - 1
    while i <= last:
        if i < last and symbols[i] == left and symbols[i + 1] == right:
            out.append(left + right)
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return out


def _order(pair: Pair, count: int) -> tuple:
    return -count, pair[0].encode(), pair[1].encode()


def merges_of_round(pieces: Iterable[tuple[list[str], int]], floor: int, symbols: set[str], budget: int) -> list[Pair]:
    """The merges that the plain trainer would make while its best count is above what was cut away.

    ``symbols`` (all that exist) is extended by those made.  ``floor`` 0: nothing was cut away.
    """
    items = [(list(s), n) for s, n in pieces]
    counts: Counter[Pair] = Counter()
    where: dict[Pair, set[int]] = defaultdict(set)
    for k, (s, n) in enumerate(items):
        for pair in zip(s, s[1:]):
            counts[pair] += n
            where[pair].add(k)
    bound = _Bound(floor)

    def upper(pair: Pair) -> int:
        kinds = bound.kinds(pair)
        return counts[pair] + (floor * kinds if kinds > 1 else 0)

    queue = [(*_order(p, c), p) for p, c in counts.items()]
    heapq.heapify(queue)
    out: list[Pair] = []
    while queue and len(out) < budget:
        top = heapq.heappop(queue)
        pair, claimed = top[-1], -top[0]
        now = upper(pair)
        if now != claimed:  # out of date: back to its place, unless nothing is left
            if counts[pair] > 0:
                heapq.heappush(queue, (*_order(pair, now), pair))
            continue
        if now <= bound.unseen() or bound.kinds(pair) > 1 and floor:
            break
        new = pair[0] + pair[1]
        twice = new in symbols
        bound.made(pair, twice)
        symbols.add(new)
        out.append(pair)
        touched: set[Pair] = set()
        for k in where.pop(pair):
            s, n = items[k]
            merged = merge_symbols(s, pair)
            for p in zip(s, s[1:]):
                counts[p] -= n
                touched.add(p)
            for p in zip(merged, merged[1:]):
                counts[p] += n
                where[p].add(k)
                touched.add(p)
            items[k] = (merged, n)
        if twice and floor:  # its pairs may have more than was claimed
            touched.update(p for p in counts if new in p)
        for p in touched:  # counts that fell are found out when they come up
            if counts[p] > 0:
                if new in p:
                    heapq.heappush(queue, (*_order(p, upper(p)), p))
            else:
                where.pop(p, None)
    return out


# ----------------------------------------------------------------- work on all words
def _symbols_of(batch: pa.RecordBatch) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The different symbols of a batch of words, the numbers of those of all words in
    order, and of which word each one is."""
    lists = pc.split_pattern(pc.utf8_trim(batch["s"], " "), "  ")
    flat = lists.flatten().dictionary_encode()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return flat.dictionary.to_pylist(), flat.indices.to_numpy().astype(np.int64), np.repeat(np.arange(len(sizes)), sizes)


def _summed(keys: np.ndarray, freq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(freq[order], starts) if len(keys) else freq


def _by_side(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
    for side in pc.unique(batch["side"]).to_pylist():
        yield side, batch.filter(pc.equal(batch["side"], side))


def cut_pieces(words: DataFrame, active: dict[str, set[Pair]]) -> DataFrame:
    """``(side, piece, freq)``: runs of neighbours that are active pairs, summed over all words."""
    schema = pa.schema([("side", pa.string()), ("piece", pa.string()), ("freq", pa.int64())])

    def pieces_of(side: str, batch: pa.RecordBatch) -> pa.RecordBatch:
        names, codes, word = _symbols_of(batch)
        number = {name: i for i, name in enumerate(names)}
        wanted = np.array([number[a] * len(names) + number[b] for a, b in active[side] if a in number and b in number], np.int64)
        joined = np.isin(codes[:-1] * len(names) + codes[1:], wanted) & (word[1:] == word[:-1])  # with the next one
        before, after = np.append(False, joined), np.append(joined, False)
        begins, ends = np.flatnonzero(after & ~before), np.flatnonzero(before & ~after)
        kept = np.flatnonzero(before | after)
        bounds = np.append(np.searchsorted(kept, begins), len(kept)).astype(np.int32)
        tokens = pa.array(names, pa.string()).take(pa.array(codes[kept]))
        pieces = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds), tokens), " ").dictionary_encode()
        freq = batch["freq"].to_numpy()[word[ends]]
        found, sums = _summed(pieces.indices.to_numpy().astype(np.int64), freq)
        return pa.RecordBatch.from_arrays([pa.repeat(side, len(found)), pieces.dictionary.take(pa.array(found)), pa.array(sums, pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for side, own in _by_side(batch):
                yield pieces_of(side, own)

    parts = words.select("side", "s", "freq").mapInArrow(run, "side string, piece string, freq long")
    return parts.groupBy("side", "piece").agg(F.sum("freq").alias("freq"))


def count_symbols(words: DataFrame) -> DataFrame:
    """``(side, left_tok, right_tok, freq)`` of neighbours; a symbol itself stands without ``right_tok``."""
    schema = pa.schema([("side", pa.string()), ("left_tok", pa.string()), ("right_tok", pa.string()), ("freq", pa.int64())])

    def counts_of(side: str, batch: pa.RecordBatch) -> pa.RecordBatch:
        names, codes, word = _symbols_of(batch)
        here = np.flatnonzero(word[1:] == word[:-1])
        pairs, sums = _summed(codes[here] * len(names) + codes[here + 1], batch["freq"].to_numpy()[word[here]])
        tokens, n = pa.array(names, pa.string()), len(names)
        left = pa.concat_arrays([tokens.take(pa.array(pairs // n)), tokens])
        right = pa.concat_arrays([tokens.take(pa.array(pairs % n)), pa.nulls(n, pa.string())])
        return pa.RecordBatch.from_arrays([pa.repeat(side, len(left)), left, right, pa.array(np.append(sums, np.zeros(n, np.int64)))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for side, own in _by_side(batch):
                yield counts_of(side, own)

    parts = words.select("side", "s", "freq").mapInArrow(run, "side string, left_tok string, right_tok string, freq long")
    return B._sum_pairs(parts)


def apply_in_order(symbols: list[str], places: dict[Pair, list[int]]) -> list[str]:
    """A word after all merges of a round: ``places`` says at which steps a pair is merged."""
    done = -1
    while len(symbols) > 1:
        step, best = None, None
        for pair in zip(symbols, symbols[1:]):
            at = places.get(pair)
            if at is not None:
                k = bisect_right(at, done)
                if k < len(at) and (step is None or at[k] < step):
                    step, best = at[k], pair
        if best is None:
            break
        symbols, done = merge_symbols(symbols, best), step
    return symbols


def apply_round(words: DataFrame, merges: dict[str, list[Pair]]) -> DataFrame:
    """``(side, freq, old, s)``: the words' symbols before and after a round."""
    places: dict[str, dict[Pair, list[int]]] = {}
    for side, pairs in merges.items():
        of_side = places.setdefault(side, {})
        for step, pair in enumerate(pairs):
            of_side.setdefault(pair, []).append(step)
    schema = pa.schema([("side", pa.string()), ("freq", pa.int64()), ("old", pa.string()), ("s", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for side, text in zip(batch["side"].to_pylist(), batch["s"].to_pylist()):
                symbols = text[1:-1].split("  ")
                merged = apply_in_order(symbols, places.get(side, {}))
                out.append(text if merged is symbols else f" {'  '.join(merged)} ")
            yield pa.RecordBatch.from_arrays([batch["side"], batch["freq"], batch["s"], pa.array(out, pa.string())], schema=schema)

    return words.select("side", "freq", "s").mapInArrow(run, "side string, freq long, old string, s string")


def _commonest(counts: DataFrame, n: dict[str, int]) -> dict[str, list[tuple[str, str, int]]]:
    """The ``n[side] + 1`` commonest pairs of each side, in the trainer's order."""
    order = Window.partitionBy("side").orderBy(F.col("freq").desc(), "left_tok", "right_tok")
    most = max(n.values()) + 1
    rows = counts.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most).orderBy("place").collect()
    found: dict[str, list] = {side: [] for side in n}
    for r in rows:
        if r["side"] in n and r["place"] <= n[r["side"]] + 1:
            found[r["side"]].append((r["left_tok"], r["right_tok"], r["freq"]))
    return found


def train_on_words(words: DataFrame, vocab_size: int = 16_000, num_merges: int | None = None, max_pieces: int = MAX_PIECES,
                   first_active: int = FIRST_ACTIVE, log: list | None = None) -> dict[str, B.Tokenizer]:
    """Tokenizers of all sides of ``words(side, word, freq, s)``; merges equal those of one at a time.

    ``vocab_size`` bounds special tokens, alphabet and merges together, ``num_merges``
    the merges alone.  The driver holds the merges, ``MAX_ACTIVE`` pairs and
    ``max_pieces`` pieces at most.  ``log`` gets (merges so far, active pairs, pieces) of each round.
    """
    words = words.select("side", "freq", "s")
    symbol_counts = written(count_symbols(words), "bpe-pairs")
    letters = symbol_counts.where("right_tok IS NULL").select("side", F.col("left_tok").alias("symbol")).collect()  # the alphabets
    alphabet: dict[str, list[str]] = defaultdict(list)
    for r in letters:
        alphabet[r["side"]].append(r["symbol"])
    alphabet = {side: sorted(a, key=str.encode) for side, a in alphabet.items()}
    symbols = {side: set(a) for side, a in alphabet.items()}
    budget = {side: num_merges if num_merges is not None else max(0, vocab_size - B.N_SPECIAL - len(a)) for side, a in alphabet.items()}
    merges: dict[str, list[Pair]] = {side: [] for side in alphabet}
    # few merges are found among few pairs, which cut words into few different pieces
    active_n = {side: max(1, min(first_active, ACTIVE_A_MERGE * budget[side])) for side in alphabet}
    counts = symbol_counts.where("right_tok IS NOT NULL")
    open_sides = {side for side in alphabet if budget[side]}
    while open_sides:
        top = _commonest(counts, {side: active_n[side] for side in open_sides})
        open_sides = {side for side in open_sides if top[side]}
        if not open_sides:
            break
        while True:
            active, floor = {}, {}
            for side in alphabet:
                pairs = top.get(side, [])[: active_n[side]] if side in open_sides else []
                rest = top.get(side, [])[len(pairs) :]
                floor[side] = rest[0][2] if rest else 0
                # pairs as common as the first one left out are left out too
                active[side] = {(a, b) for a, b, n in pairs if n > floor[side]} or {(a, b) for a, b, _ in pairs[:1]}
            pieces = cut_pieces(words.where(F.col("side").isin(sorted(open_sides))), active)
            found: dict[str, list] = {side: [] for side in open_sides}
            for r in pieces.limit(len(open_sides) * max_pieces + 1).collect():
                found[r["side"]].append((r["piece"].split(" "), r["freq"]))
            over = [side for side in open_sides if len(found[side]) > max_pieces]
            if sum(map(len, found.values())) > len(open_sides) * max_pieces:
                over = over or list(open_sides)
            if not over or all(active_n[side] == 1 for side in over):
                break
            for side in over:
                active_n[side] = max(1, active_n[side] // 2)
        for side in over:  # too many pieces around one pair
            found[side] = []
        made: dict[str, list[Pair]] = {}
        for side in open_sides:
            room = budget[side] - len(merges[side])
            made[side] = merges_of_round(found[side], floor[side], symbols[side], room) if found[side] else []
            if not made[side]:  # the best pair alone is always right
                pair = top[side][0][:2]
                made[side] = [pair]
                symbols[side].add(pair[0] + pair[1])
            merges[side] += made[side]
            if side not in over and len(found[side]) < max_pieces // 4:
                active_n[side] = min(MAX_ACTIVE, active_n[side] * 4)
        if log is not None:
            log.append({side: (len(merges[side]), len(active[side]), len(found[side])) for side in sorted(open_sides)})
        open_sides = {side for side in open_sides if len(merges[side]) < budget[side]}
        if not open_sides:
            break
        words = written(apply_round(words.select("side", "freq", "s"), made), "bpe-words")
        changed = words.where("s <> old")
        delta = B._side_pairs(changed, "old", -1).unionAll(B._side_pairs(changed, "s"))
        counts = written(B._sum_pairs(counts.unionAll(B._sum_pairs(delta))).where("freq > 0"), "bpe-pairs")
    return {side: B.Tokenizer(merges=merges[side], vocab=B.build_vocab(alphabet[side], merges[side])) for side in alphabet}
