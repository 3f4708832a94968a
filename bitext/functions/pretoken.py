"""Pre-tokens of whole Arrow batches: the pattern ``text.PRETOK`` without a regex step per token.

Every character of a batch gets a class from one table (white space, word character,
other), and a pre-token is a run of one class inside a row, so all of them are found by a
few array operations on the bytes.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE, WORD, OTHER = range(3)
CODE_POINTS = 0x110000


@cache
def char_classes() -> np.ndarray:
    """The class of every code point, as ``text.WORD_CHARS`` and ``text.WHITE_SPACE`` say it."""
    of = {c: WORD for c in ("Lu", "Ll", "Lt", "Lm", "Lo", "Mn", "Mc", "Me", "Nd", "Nl", "Pc")} | {c: SPACE for c in ("Zs", "Zl", "Zp")}
    table = np.array([of.get(unicodedata.category(chr(c)), OTHER) for c in range(CODE_POINTS)], np.uint8)
    table[[*range(0x09, 0x0E), 0x85]] = SPACE
    for first, last in ((0x200C, 0x200D), (0x24B6, 0x24E9), (0x1F130, 0x1F149), (0x1F150, 0x1F169), (0x1F170, 0x1F189)):
        table[first : last + 1] = WORD
    return table


def wide_points(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points of the UTF-8 characters of two bytes and more that begin at ``at``."""
    lead = data[at].astype(np.int32)
    size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
    out = lead & (0x7F >> size)
    for k in (1, 2, 3):
        follows = data[np.minimum(at + k, len(data) - 1)].astype(np.int32) & 0x3F
        out = np.where(size > k, out << 6 | follows, out)
    return np.minimum(out, CODE_POINTS - 1)


@dataclass
class Pretokens:
    """The bytes of a batch of texts and the pre-tokens in them."""

    data: np.ndarray  # UTF-8 bytes of all rows
    kind: np.ndarray  # the class of the character that each byte belongs to
    wide: np.ndarray  # where characters of more than one byte begin
    points: np.ndarray  # their code points
    first: np.ndarray  # where pre-tokens begin
    end: np.ndarray  # where they end
    rows: np.ndarray  # where each row begins, and the number of bytes

    def words(self) -> pa.Array:
        """The pre-tokens of all rows, one after the other."""
        if not len(self.first):
            return pa.array([], pa.string())
        bounds = np.stack([self.first, self.end], axis=1).ravel().astype(np.int32)  # words and what is between them
        every = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(self.data))
        return every.take(pa.array(np.arange(0, len(bounds), 2, dtype=np.int32)))

    def word_bounds(self) -> np.ndarray:
        """Number of pre-tokens before each row, and of all."""
        return np.searchsorted(self.first, self.rows)

    def characters(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code points inside pre-tokens, which of them end one, and how many stand before each row, and of all."""
        at = np.flatnonzero((self.kind != SPACE) & ((self.data & 0xC0) != 0x80))
        every = self.data.astype(np.int32)
        every[self.wide] = self.points
        last = np.zeros(len(at), bool)
        last[np.append(np.searchsorted(at, self.first[1:]), len(at))[: len(self.first)] - 1] = True
        return every[at], last, np.searchsorted(at, self.rows)


def find(texts: pa.Array) -> Pretokens:
    """The pre-tokens of an Arrow array of strings (null: none)."""
    texts = (texts.fill_null("") if texts.null_count else texts).cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    rows = offsets - offsets[0]
    classes = char_classes()
    kind = classes[:256][data]
    wide = np.flatnonzero(data >= 0xC0)
    points = wide_points(data, wide)
    if len(wide):
        of_wide, lead = classes[points], data[wide]
        for k, least in enumerate((0xC0, 0xC0, 0xE0, 0xF0)):
            longer = lead >= least
            kind[np.minimum(wide[longer] + k, len(data) - 1)] = of_wide[longer]
    change = np.ones(len(data) + 1, bool)  # a run may begin here, and after the last byte
    change[1:-1] = kind[1:] != kind[:-1]
    change[rows] = True
    inside = kind != SPACE
    return Pretokens(data, kind, wide, points, np.flatnonzero(inside & change[:-1]), np.flatnonzero(inside & change[1:]) + 1, rows)


def as_lists(flat: pa.Array, bounds: np.ndarray, rows: pa.Array) -> pa.ListArray:
    """``flat`` cut at ``bounds`` into a list per row, null where ``rows`` is null."""
    mask = pa.array(rows.is_null().to_numpy(zero_copy_only=False)) if rows.null_count else None
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), flat, mask=mask)


def pretokens(col) -> Column:
    """``text.pretokenize`` by batches: for tables whose every text is cut into tokens."""

    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array) -> pa.Array:
        found = find(texts)
        return as_lists(found.words(), found.word_bounds(), texts)

    return cut(F.col(col) if isinstance(col, str) else col)
