import hashlib
import random
import struct

import public_tokenizers
import tiktoken

from bitext.llm import bytebpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
with open(PATH, "rb") as f:
    RANKS = bytebpe.read_ranks(f.read())
TIK = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def row(doc_id, text):
    ids = TIK.encode_ordinary(text or "")
    raw = struct.pack(f"<{len(ids)}I", *ids)
    return doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_ids_equal_the_library(spark):
    rng = random.Random(2)
    alphabets = ["abcdefghijklmnopqrstuvwxyz", "ab", "theaningou ", "éèßü ", "日本語", "0123456789", "\n \t\r\x0b\x1c\x85\u00a0", "#$%&*!?.'\"", "🎉👍🏽e\u0301", "'ll's't a"]
    texts = ["a" * 3000, "ab" * 900, " " * 700, "the" * 60, "<|endoftext|>", "\x00\x01"]
    texts += ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(1, 60))) for _ in range(800)]
    texts += ["".join(rng.choice(a) for _ in range(rng.randint(90, 500))) for a in alphabets for _ in range(4)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {tuple(r) for r in bytebpe.round_trip(docs, PATH, public_tokenizers.PATTERN).collect()}
    assert got == {row(i, t) for i, t in enumerate(texts)}


def test_encode_and_decode_are_inverse(edge_docs, no_docs):
    coded = bytebpe.encode(edge_docs, PATH, public_tokenizers.PATTERN)
    assert coded.count() == 9
    back = {r["doc_id"]: bytes(r["bytes"]).decode() for r in bytebpe.decode(coded, PATH).collect()}
    for r in edge_docs.collect():
        assert back[r["doc_id"]] == (r["text"] or "")
    got = sorted(map(tuple, bytebpe.round_trip(edge_docs, PATH, public_tokenizers.PATTERN).collect()), key=repr)
    assert got == sorted((row(r["doc_id"], r["text"]) for r in edge_docs.collect()), key=repr)
    assert bytebpe.round_trip(no_docs, PATH, public_tokenizers.PATTERN).collect() == []


def test_cache_restart_keeps_results(monkeypatch):
    monkeypatch.setattr(bytebpe, "CACHE_BYTES", 300)
    enc = bytebpe.Encoder(bytebpe.Vocabulary(RANKS), public_tokenizers.PATTERN)
    for text in ("one two three four", "five six one", "one two", "x" * 5000, "one " + "xy" * 900, "x" * 5000):
        assert list(struct.unpack(f"<{len(TIK.encode_ordinary(text))}I", enc.encode([text])[0])) == TIK.encode_ordinary(text)
        assert max(map(len, enc.seen), default=0) <= bytebpe.CACHED_CHARS and enc.held <= 300 + 2000
