"""Fill-in-the-middle by content-defined chunks whose summaries are remembered.

A rolling hash over the last 16 bytes cuts texts into chunks wherever it hits a
mask, so equal passages give equal chunks wherever they stand.  A chunk's summary
(line ends, code points, its first and last bytes, whether it holds a mark) is
computed once and found again by the chunk's bytes themselves.  A text's line
count is the combination of its summaries, marks that lie across a chunk's end
are seen at the joined boundary bytes, and the running sums of line ends and code
points name the chunk in which a cut lies; only that chunk is looked into.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bitext.llm.common import map_slices, pick

SEED = 7
FIM_PER_CENT = 100  # of the texts that can be transformed
SPM_PER_CENT = 50  # of the transformed
MARKS = (b"<P>", b"<S>", b"<M>")  # prefix, suffix, middle

WINDOW = 16  # bytes that decide on a cut
MASK_BITS = 9  # a cut every 512 bytes on average
MAX_CHUNK = 4096  # bytes; also cut where the hash finds nothing for so long
CACHE_BYTES = 32 << 20  # chunk bytes that a task remembers


# ----------------------------------------------------------------- chunks
_GEAR = np.random.default_rng(SEED).integers(0, 1 << 32, 256, dtype=np.uint32)


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """For every byte the hash of the ``WINDOW`` bytes that end there (fewer at the start)."""
    h = _GEAR[data]
    span = 1
    while span < WINDOW:  # the hash of 2 n bytes from two of n
        longer = h.copy()
        longer[span:] += h[:-span] << np.uint32(span)
        h, span = longer, 2 * span
    return h


def chunk_ends(data: np.ndarray) -> list[int]:
    """Ends of the chunks of a text, the last one its length."""
    n = len(data)
    if not n:
        return []
    # the topmost bits of the hash hold all bytes of the window
    ends = (np.flatnonzero(rolling_hash(data) >> np.uint32(32 - MASK_BITS) == 0) + 1).tolist()
    if not ends or ends[-1] != n:
        ends.append(n)
    if ends[0] <= MAX_CHUNK and max(map(int.__sub__, ends[1:], ends), default=0) <= MAX_CHUNK:
        return ends
    out, start = [], 0
    for end in ends:
        out.extend(range(start + MAX_CHUNK, end, MAX_CHUNK))
        out.append(end)
        start = end
    return out


class Summary(NamedTuple):
    lines: int  # line ends inside
    points: int  # code points that begin inside
    marked: bool  # a whole mark inside
    first: bytes  # two bytes, or fewer
    last: bytes


def summary(chunk: bytes) -> Summary:
    return Summary(chunk.count(b"\n"), points(chunk), any(m in chunk for m in MARKS), chunk[:2], chunk[-2:])


def points(data: bytes) -> int:
    """Code points that begin in a piece of UTF-8."""
    return len(data) - len(data.translate(None, _STARTS))


_STARTS = bytes(b for b in range(256) if b & 0xC0 != 0x80)


class ChunkCache:
    """Summaries by chunk bytes; when ``limit`` bytes are held, the older half goes."""

    def __init__(self, limit: int = CACHE_BYTES):
        self.limit, self.young, self.old, self.bytes = limit, {}, {}, 0
        self.hits = self.misses = 0

    def get(self, chunk: bytes) -> Summary:
        found = self.young.get(chunk)
        if found is not None:
            self.hits += 1
            return found
        found = self.old.get(chunk)
        if found is None:
            self.misses += 1
            found = summary(chunk)
        else:
            self.hits += 1
        self.young[chunk] = found
        self.bytes += len(chunk) + 200
        if self.bytes > self.limit // 2:
            self.young, self.old, self.bytes = {}, self.young, 0
        return found


# ----------------------------------------------------------------- cuts
@dataclass
class Layout:
    """A text as its chunks, with running sums over their summaries."""

    data: bytes
    starts: list[int]
    lines: np.ndarray  # line ends before each chunk, and all
    points: np.ndarray  # code points before each chunk, and all
    marked: bool

    @property
    def units(self) -> int:
        """Lines, the last one with or without its end."""
        return int(self.lines[-1]) + bool(self.data and not self.data.endswith(b"\n"))

    def cut(self, unit: int) -> tuple[int, int]:
        """(bytes, code points) of the first ``unit`` lines."""
        if unit <= 0:
            return 0, 0
        if unit > self.lines[-1]:
            return len(self.data), int(self.points[-1])
        # the chunk that holds the line end, and its place in there
        k = int(np.searchsorted(self.lines, unit)) - 1
        at = self.starts[k] - 1
        for _ in range(unit - int(self.lines[k])):
            at = self.data.index(b"\n", at + 1)
        return at + 1, int(self.points[k]) + points(self.data[self.starts[k] : at + 1])


def layout(data: bytes, cache: ChunkCache) -> Layout:
    ends = chunk_ends(np.frombuffer(data, np.uint8))
    starts = [0, *ends[:-1]] if ends else []
    found = [cache.get(data[a:b]) for a, b in zip(starts, ends)]
    marked = any(s.marked for s in found)
    tail = b""
    for s in found:  # marks across the ends of chunks; short chunks hand on what came before
        if not marked:
            joined = tail + s.first
            marked = any(m in joined for m in MARKS)
        tail = s.last if len(s.last) == 2 else (tail + s.last)[-2:]
    sums = np.cumsum([(0, 0), *[(s.lines, s.points) for s in found]], axis=0)
    return Layout(data, starts, sums[:, 0], sums[:, 1], marked)


def draws(doc_id: int | None, seed: int = SEED) -> list[int]:
    """Four numbers from the text's id (a null id counts as no digits)."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]


@dataclass
class Transformed:
    units: int
    form: str  # plain, psm or spm
    prefix_chars: int | None
    middle_chars: int | None
    output: bytes


def transform(doc_id: int | None, text: str | None, cache: ChunkCache, fim_per_cent: int = FIM_PER_CENT,
              spm_per_cent: int = SPM_PER_CENT, seed: int = SEED) -> Transformed:
    data = (text or "").encode()
    at = layout(data, cache)
    n, (h1, h2, h3, h4) = at.units, draws(doc_id, seed)
    if not data or at.marked or h3 % 100 >= fim_per_cent:
        return Transformed(n, "plain", None, None, data)
    one, two = sorted((h1 % (n + 1), h2 % (n + 1)))
    (a, a_points), (b, b_points) = at.cut(one), at.cut(two)
    prefix, middle, suffix = data[:a], data[a:b], data[b:]
    p, s, m = MARKS
    if h4 % 100 < spm_per_cent:
        return Transformed(n, "spm", a_points, b_points - a_points, b"".join((s, suffix, p, prefix, m, middle)))
    return Transformed(n, "psm", a_points, b_points - a_points, b"".join((p, prefix, s, suffix, m, middle)))


def restore(form: str, output: bytes) -> bytes:
    """The text again.  Marks share no beginning with an end of another, and the
    text holds none, so each is found where it was put."""
    p, s, m = MARKS
    if form == "plain":
        return output
    body, _, middle = output.partition(m)
    if form == "psm":
        prefix, _, suffix = body[len(p) :].partition(s)
    else:
        suffix, _, prefix = body[len(s) :].partition(p)
    return prefix + middle + suffix


# ----------------------------------------------------------------- DataFrames
def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", output: bool = True,
                   fim_per_cent: int = FIM_PER_CENT, spm_per_cent: int = SPM_PER_CENT, seed: int = SEED) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output, output_sha256, restored_sha256).

    ``output`` (left out on request) is the transformed text, ``restored`` is
    rebuilt from it and the form alone.  Null and empty texts are plain and empty,
    as are texts that hold a mark; a null id draws like an id without digits;
    repeated rows give repeated rows, an empty table an empty result.
    """
    fields = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"

    fields += ", output string" * output
    names = [f.split()[0] for f in fields.split(", ")]

    def make():
        cache = ChunkCache()

        def row(doc_id: int | None, text: str | None) -> tuple:
            d = transform(doc_id, text, cache, fim_per_cent, spm_per_cent, seed)
            hashes = [hashlib.sha256(x).hexdigest() for x in (d.output, restore(d.form, d.output))]
            return doc_id, d.units, d.form, d.prefix_chars, d.middle_chars, *hashes, *([d.output.decode()] if output else [])

        def run(batch: pa.RecordBatch) -> dict:
            rows = [row(i, t.as_py()) for i, t in zip(batch["doc_id"].to_pylist(), batch["text"])]
            return dict(zip(names, zip(*rows) if rows else [()] * len(names)))

        return run

    return map_slices(pick(docs, doc_id=id_col, text=text_col), make, fields, 64)


def fill_sql(fim_per_cent: int = FIM_PER_CENT, spm_per_cent: int = SPM_PER_CENT, seed: int = SEED) -> str:
    """The same (without the text) in DuckDB's SQL."""
    digest = f"sha256('{seed}:' || coalesce(doc_id::VARCHAR, ''))"
    draw = ", ".join(f"('0x' || substr({digest}, {8 * k + 1}, 8))::BIGINT AS h{k + 1}" for k in range(4))
    p, s, m = (x.decode() for x in MARKS)
    return rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, {draw} FROM documents),
units AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u FROM texts),
cuts AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS c1, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS c2 FROM units),
parts AS (
  SELECT *, coalesce(array_to_string(list_slice(u, 1, c1), ''), '') AS prefix, coalesce(array_to_string(list_slice(u, c1 + 1, c2), ''), '') AS middle,
    coalesce(array_to_string(list_slice(u, c2 + 1, n), ''), '') AS suffix,
    CASE WHEN t = '' OR contains(t, '{p}') OR contains(t, '{s}') OR contains(t, '{m}') OR h3 % 100 >= {fim_per_cent} THEN 'plain'
      WHEN h4 % 100 < {spm_per_cent} THEN 'spm' ELSE 'psm' END AS form
  FROM cuts)
SELECT doc_id, n::BIGINT AS n, form,
  CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '{s}' || suffix || '{p}' || prefix || '{m}' || middle
    ELSE '{p}' || prefix || '{s}' || suffix || '{m}' || middle END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts"""
