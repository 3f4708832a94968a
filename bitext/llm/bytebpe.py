"""Byte-level BPE encoding and decoding with numpy matrices.

Texts are cut by the tokenizer's pattern; each distinct match is encoded once.
Matches of similar length share a matrix of token ids, one row per match, padded
with -1.  In a round every row looks its adjacent pairs up in a hash table of
mergeable pairs, merges its leftmost pair of the smallest rank, and the merged
column is closed up (compaction); rows without a mergeable pair leave the matrix.

A vocabulary is a bounded file (tens of thousands of tokens): the driver reads
it and broadcasts its bytes, each Python worker builds its tables once.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from bitext.llm.common import map_slices, pick

#: Longest vocabulary file that is broadcast, bytes.
MAX_VOCAB_BYTES = 64 << 20
#: Bytes of matches and ids kept encoded per task (the objects around them come on
#: top, about 150 bytes a match); beyond it the cache starts anew.
CACHE_BYTES = 32 << 20
#: What a match counts in it besides its own bytes.
CACHE_ENTRY = 80
#: Matches with more characters are encoded where they stand and not remembered.
CACHED_CHARS = 64
#: Rows of one matrix times its width, at most.
MATRIX_CELLS = 1 << 20
#: Matches longer than this are merged one by one, every occurrence at once.
LONG_MATCH = 96
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TABLES: dict[str, "Vocabulary"] = {}


class Vocabulary:
    """Ranks of a byte-level BPE and the pairs that merge, as a numpy hash table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        left, right, rank = [], [], []
        for token, r in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), rank.append(r)
        left, right, rank = (np.array(x, np.int64) for x in (left, right, rank))
        self._build(left << 32 | right, rank)
        # merges whose result can take part in a pair of smaller rank
        early = np.zeros(len(self.tokens), bool)
        early[left[rank < left]] = True
        early[right[rank < right]] = True
        self.early = early

    def _build(self, keys: np.ndarray, ranks: np.ndarray) -> None:
        bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 4))))
        self.shift, size = np.uint64(64 - bits), 1 << bits
        self.keys, self.ranks = np.full(size + 1, -1, np.int64), np.full(size + 1, NONE, np.int32)
        at, todo = self._slot(keys), np.arange(len(keys))
        self.probes = 0
        while len(todo):  # linear probing, all keys that still lack a slot at once
            self.probes += 1
            free = self.keys[at[todo]] == -1
            self.keys[at[todo[free]]] = keys[todo[free]]
            todo = todo[self.keys[at[todo]] != keys[todo]]
            at[todo] = (at[todo] + 1) & (size - 1)
        done = self._slot(keys)
        wrong = self.keys[done] != keys
        while wrong.any():
            done[wrong] = (done[wrong] + 1) & (size - 1)
            wrong = self.keys[done] != keys
        self.ranks[done] = ranks

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _MIX >> self.shift).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each (left, right) pair, ``NONE`` where it doesn't merge."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        keys[right < 0] = -2
        at = self._slot(keys)
        out = np.where(self.keys[at] == keys, self.ranks[at], NONE)
        todo = np.flatnonzero((self.keys[at] != keys) & (self.keys[at] != -1))
        at, keys = at[todo], keys[todo]
        for _ in range(self.probes):
            if not len(todo):
                break
            at = (at + 1) & (len(self.keys) - 2)
            found = self.keys[at]
            out[todo[found == keys]] = self.ranks[at[found == keys]]
            go = (found != keys) & (found != -1)
            todo, at, keys = todo[go], at[go], keys[go]
        return out

    def encode_many(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece; pieces of similar length share a matrix."""
        out: list[np.ndarray] = [np.empty(0, np.int32)] * len(pieces)
        sizes = np.array([len(p) for p in pieces])
        order = np.argsort(sizes, kind="stable")
        at = 0
        while at < len(order):
            width = int(sizes[order[at]])
            if width > LONG_MATCH:
                for i in order[at:]:
                    out[i] = self._merge_long(self.single[np.frombuffer(pieces[i], np.uint8)])
                break
            # a bucket: up to a quarter longer than its shortest piece
            widest = max(width + 1, width * 5 // 4)
            end = min(int(np.searchsorted(sizes[order], widest, "right")), at + MATRIX_CELLS // max(widest, 1))
            self._merge_rows(pieces, order[at:end], int(sizes[order[end - 1]]), out)
            at = end
        return out

    def _merge_rows(self, pieces: list[bytes], rows: np.ndarray, width: int, out: list) -> None:
        flat = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in rows), np.uint8).reshape(len(rows), width)
        size = np.array([len(pieces[i]) for i in rows])
        ids = np.where(np.arange(width)[None, :] < size[:, None], self.single[flat], -1)
        if width < 2:
            for k, i in enumerate(rows):
                out[i] = ids[k, : size[k]]
            return
        ranks = self.pair_ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
        while len(rows):
            at = ranks.argmin(axis=1)  # the first of equal ranks: the leftmost
            low = ranks[np.arange(len(rows)), at]
            done = low == NONE
            if done.any():
                for k in np.flatnonzero(done):
                    out[rows[k]] = ids[k, : size[k]].copy()
                go = ~done
                rows, ids, ranks, size, at, low = rows[go], ids[go], ranks[go], size[go], at[go], low[go]
                if not len(rows):
                    return
            # close up the column right of each merge
            n, w = ids.shape
            here = np.arange(n)
            col = np.arange(w - 1)[None, :]
            ids[here, at] = low
            ids = np.take_along_axis(ids, col + (col > at[:, None]), axis=1)
            size = size - 1
            keep = max(int(size.max()), 2)
            if ids.shape[1] < 2:
                ids = np.pad(ids, ((0, 0), (0, 1)), constant_values=-1)
            ids = ids[:, :keep]
            if ranks.shape[1] > 1:
                col = np.arange(ranks.shape[1] - 1)[None, :]
                ranks = np.take_along_axis(ranks, col + (col > at[:, None]), axis=1)[:, : keep - 1]
            # only the pairs beside the merged token have changed
            for c in (at - 1, at):
                ok = np.flatnonzero((c >= 0) & (c < ranks.shape[1]))
                if len(ok):
                    ranks[ok, c[ok]] = self.pair_ranks(ids[ok, c[ok]], ids[ok, c[ok] + 1])
            if ids.shape[1] - 1 < ranks.shape[1]:
                ranks = ranks[:, : ids.shape[1] - 1]

    def _merge_long(self, ids: np.ndarray) -> np.ndarray:
        """One long match: all occurrences of the smallest rank merge in a round.

        That equals merging them one by one, leftmost first, unless the merged
        token can itself pair at a smaller rank; then only the leftmost merges.
        """
        ranks = self.pair_ranks(ids[:-1], ids[1:])
        while len(ranks):
            low = int(ranks.min())
            if low == NONE:
                break
            at = np.flatnonzero(ranks == low)
            if self.early[low]:
                at = at[:1]
            elif len(at) > 1:  # of runs of overlapping pairs, every other one
                run = np.concatenate([[0], np.cumsum(np.diff(at) != 1)])
                at = at[(at - at[np.searchsorted(run, run)]) % 2 == 0]
            ids = ids.copy()
            ids[at] = low
            keep = np.ones(len(ids), bool)
            keep[at + 1] = False
            ids = ids[keep]
            new = at - np.arange(len(at))  # where the merged tokens stand now
            ranks = ranks[keep[1:]] if len(ids) > 1 else ranks[:0]
            if len(ids) > 1:
                touched = np.unique(np.concatenate([new - 1, new]))
                touched = touched[(touched >= 0) & (touched < len(ids) - 1)]
                ranks[touched] = self.pair_ranks(ids[touched], ids[touched + 1])
        return ids


NONE = np.int32(2**31 - 1)


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Lines of ``base64(token) rank``."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}


def vocabulary(data: bytes) -> Vocabulary:
    """The tables of a vocabulary file, built once per Python worker."""
    key = hashlib.sha256(data).hexdigest()
    if key not in _TABLES:
        _TABLES[key] = Vocabulary(read_ranks(data))
    return _TABLES[key]


class Encoder:
    """Text -> ids with a cache of encoded matches (as little-endian uint32 bytes)."""

    def __init__(self, vocab: Vocabulary, pattern: str):
        self.vocab, self.find = vocab, regex.compile(pattern).findall
        self.seen, self.held = {}, 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        matches = [self.find(t) for t in texts]
        if self.held > CACHE_BYTES:
            self.seen, self.held = {}, 0
        new = list(set().union(*matches) - self.seen.keys())
        long = []
        for word, ids in zip(new, self.vocab.encode_many([w.encode() for w in new])):
            self.seen[word] = coded = ids.astype("<u4").tobytes()
            if len(word) > CACHED_CHARS:
                long.append(word)
            else:
                self.held += len(word) + len(coded) + CACHE_ENTRY
        done = [b"".join(map(self.seen.__getitem__, m)) for m in matches]
        for word in long:
            del self.seen[word]
        return done

    def decode(self, ids: bytes) -> bytes:
        """The bytes of the tokens, joined."""
        return b"".join(map(self.vocab.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def broadcast_vocabulary(docs: DataFrame, vocab_path: str):
    """The bytes of a vocabulary file, size-checked and broadcast."""
    with open(vocab_path, "rb") as f:
        data = f.read(MAX_VOCAB_BYTES + 1)
    if len(data) > MAX_VOCAB_BYTES:
        raise ValueError(f"the vocabulary file is over {MAX_VOCAB_BYTES} bytes")
    return docs.sparkSession.sparkContext.broadcast(data)


def encode(docs: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>) of every text, whole; a null text has no ids.

    Repeated rows give repeated rows, an empty table an empty result.
    """
    shared = broadcast_vocabulary(docs, vocab_path)

    def make():
        enc = Encoder(vocabulary(shared.value), pattern)

        def run(batch: pa.RecordBatch) -> dict:
            ids = enc.encode([t or "" for t in batch["text"].to_pylist()])
            return {"doc_id": batch["doc_id"], "ids": [np.frombuffer(x, "<i4") for x in ids]}

        return run

    return map_slices(pick(docs, doc_id=id_col, text=text_col), make, "doc_id long, ids array<int>")


def decode(coded: DataFrame, vocab_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, bytes binary): the bytes that the ids stand for; null ids give null."""
    shared = broadcast_vocabulary(coded, vocab_path)

    def make():
        tokens = vocabulary(shared.value).tokens

        def run(batch: pa.RecordBatch) -> dict:
            lists = batch["ids"].to_pylist()
            return {"doc_id": batch["doc_id"], "bytes": [None if x is None else b"".join(tokens[i] for i in x) for x in lists]}

        return run

    return map_slices(pick(coded, doc_id=id_col, ids=ids_col), make, "doc_id long, bytes binary")


def round_trip(docs: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encode, then decode the ids.

    Digests of the ids as little-endian unsigned 32-bit integers and of the
    decoded bytes; both steps in one pass, so that ids never leave the task.
    A null text counts as empty.
    """
    shared = broadcast_vocabulary(docs, vocab_path)

    def make():
        enc = Encoder(vocabulary(shared.value), pattern)

        def run(batch: pa.RecordBatch) -> dict:
            coded = enc.encode([t or "" for t in batch["text"].to_pylist()])
            return {
                "doc_id": batch["doc_id"],
                "n_tokens": [len(x) // 4 for x in coded],
                "ids_sha256": [hashlib.sha256(x).hexdigest() for x in coded],
                "decoded_sha256": [hashlib.sha256(enc.decode(x)).hexdigest() for x in coded],
            }

        return run

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_slices(pick(docs, doc_id=id_col, text=text_col), make, schema)
