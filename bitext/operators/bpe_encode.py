"""Encoding with large merge lists: distinct words of a batch, merged along a rank queue.

A batch's pre-tokens become a dictionary, each different word is encoded once and
remembered by the task up to a number of bytes, and the ids of all rows are put
together from the dictionary's by array arithmetic.  A word's symbols are a linked
list with a queue of the ranks of its neighbours, so a word of n characters takes
n log n steps and not a scan for every merge.

With few merges there is no dictionary: each merge is one pass over all symbols of the
batch (``FlatEncoder``).
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from bitext.config import END_OF_WORD, SPECIAL_TOKENS, UNK_ID
from bitext.functions import pretoken as P
from bitext.operators.bpe import Tokenizer

CACHE_BYTES = 32 << 20  # of words that a task remembers
LONG_WORD = 1000  # characters of a word that is not remembered
FLAT_MERGES = 100  # merges up to which each is a pass over a batch


def encode_word(word: str, ranks: dict[tuple[str, str], int], vocab: dict[str, int]) -> list[int]:
    """Ids of a word: again and again all occurrences of its neighbours of least rank merged, left to right."""
    symbols = list(word)
    if not symbols:
        return []
    symbols[-1] += END_OF_WORD
    n = len(symbols)
    after, before = [*range(1, n), -1], list(range(-1, n - 1))
    queue = []
    for i in range(n - 1):
        rank = ranks.get((symbols[i], symbols[i + 1]))
        if rank is not None:
            queue.append((rank, i, symbols[i], symbols[i + 1]))
    heapq.heapify(queue)
    while queue:
        rank = queue[0][0]
        fresh = []
        # all occurrences of one pair before the pairs that come up by merging them
        while queue and queue[0][0] == rank:
            _, i, left, right = heapq.heappop(queue)
            j = after[i]
            if j < 0 or symbols[i] != left or symbols[j] != right:
                continue  # one of the two is gone
            symbols[i] = left + right
            symbols[j] = ""
            k = after[j]
            after[i], after[j] = k, -1
            if k >= 0:
                before[k] = i
            fresh.append(i)
        for i in fresh:
            if not symbols[i]:
                continue
            for a in (before[i], i):
                b = after[a] if a >= 0 else -1
                if b >= 0:
                    found = ranks.get((symbols[a], symbols[b]))
                    if found is not None:
                        heapq.heappush(queue, (found, a, symbols[a], symbols[b]))
    return [vocab.get(s, UNK_ID) for s in symbols if s]


class WordEncoder:
    """Encodes lists of pre-tokens of Arrow arrays; lives as long as a task."""

    def __init__(self, tok: Tokenizer, cache_bytes: int = CACHE_BYTES):
        self.ranks = {pair: i for i, pair in enumerate(tok.merges)}
        self.vocab = dict(tok.vocab)
        self.cache: dict[str, np.ndarray] = {}
        self.held, self.cache_bytes = 0, cache_bytes

    def word(self, word: str) -> np.ndarray:
        got = self.cache.get(word)
        if got is None:
            got = np.array(encode_word(word, self.ranks, self.vocab), np.int32)
            if len(word) <= LONG_WORD:
                if self.held > self.cache_bytes:
                    self.cache.clear()
                    self.held = 0
                self.cache[word] = got
                self.held += 200 + 5 * len(word)
        return got

    def __call__(self, rows: pa.ListArray) -> pa.ListArray:
        """Ids of every row, null for null."""
        words = rows.flatten().dictionary_encode()
        each = [self.word(w) for w in words.dictionary.to_pylist()]
        lengths = np.array([len(e) for e in each], np.int64)
        starts = np.cumsum(lengths) - lengths
        at = words.indices.to_numpy(zero_copy_only=False)
        own = lengths[at]  # ids of each word in order
        flat = np.concatenate(each) if each else np.zeros(0, np.int32)
        ends = np.cumsum(own)
        ids = flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts[at] - (ends - own), own)]
        per_row = np.nan_to_num(rows.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        word_ends = np.append(0, np.cumsum(per_row))
        offsets = np.append(0, ends)[word_ends].astype(np.int32)
        out = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids, pa.int32()))
        if rows.null_count:
            out = pa.ListArray.from_arrays(pa.array(offsets, mask=np.append(rows.is_null().to_numpy(zero_copy_only=False), False)), pa.array(ids, pa.int32()))
        return out


class FlatEncoder:
    """Encodes Arrow arrays of texts, one merge after the other over all their symbols."""

    def __init__(self, tok: Tokenizer):
        self.middle = np.full(P.CODE_POINTS, UNK_ID, np.int32)  # ids of characters inside and at the end of a word
        self.end = self.middle.copy()
        for token, i in tok.vocab.items():
            if len(token) == 1:
                self.middle[ord(token)] = i
            elif len(token) == 1 + len(END_OF_WORD) and token.endswith(END_OF_WORD):
                self.end[ord(token[0])] = i
        self.merges = [(tok.vocab[left], tok.vocab[right], tok.vocab[left + right]) for left, right in tok.merges]

    @staticmethod
    def fits(tok: Tokenizer) -> bool:
        """Whether merging in the order of ranks is merging by least rank: each merge makes a symbol
        that nothing else gives, out of characters and symbols made before it."""
        made: set[str] = set(SPECIAL_TOKENS)
        known = {t for t in tok.vocab if t not in made and (len(t) == 1 or len(t) == 1 + len(END_OF_WORD) and t.endswith(END_OF_WORD))}
        for left, right in tok.merges:
            new = left + right
            if left not in known or right not in known or new in known or new in made or new not in tok.vocab:
                return False
            known.add(new)
        return len(tok.merges) <= FLAT_MERGES

    def __call__(self, texts: pa.Array) -> pa.ListArray:
        """Ids of every row, null for null."""
        points, last, rows = P.find(texts).characters()
        ids = np.where(last, self.end[points], self.middle[points]) * 2 + last  # odd where a word ends
        for left, right, new in self.merges:
            at = np.flatnonzero(ids[:-1] == 2 * left)
            at = at[ids[at + 1] >> 1 == right]
            if left == right and len(at):  # of a run of them every other one
                begins = np.append(True, np.diff(at) != 1)
                run = np.flatnonzero(begins)
                at = at[(np.arange(len(at)) - run[np.cumsum(begins) - 1]) % 2 == 0]
            if len(at):
                ids[at] = 2 * new + (ids[at + 1] & 1)
                stays = np.ones(len(ids), bool)
                stays[at + 1] = False
                ids = ids[stays]
                rows = rows - np.searchsorted(at + 1, rows)
        return P.as_lists(pa.array(ids >> 1, pa.int32()), rows, texts)


def encode_col(text: Column, tok: Tokenizer) -> Column:
    """Text -> ``array<int>`` of subword ids, row-local; null gives null.

    The merges and the vocabulary (bounded by the vocabulary's size) travel with the function.
    """
    encoder: list = []  # one per worker, made from what travels
    flat = FlatEncoder.fits(tok)

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        if not encoder:
            encoder.append(FlatEncoder(tok) if flat else WordEncoder(tok))
        if flat:
            return encoder[0](texts)
        found = P.find(texts)
        return encoder[0](P.as_lists(found.words(), found.word_bounds(), texts))

    return encode.asNondeterministic()(text)
