"""Column-level text helpers: Unicode strip, word split, pre-tokenizer, noise
cleaning, detokenizer and the "13a" BLEU tokenizer.

All are regex built-ins (``regexp_replace`` / ``regexp_extract_all``) so they run
inside whole-stage codegen; none needs a Python UDF.  Java's ``\\s``/``\\w`` are
ASCII-only, so the patterns spell out Unicode classes explicitly.  Two notions of
white space are needed: text is stripped and split like Python strings (which also
count U+001C to U+001F), the pre-tokenizer uses the Unicode property.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Text patterns (Java regex syntax).
SPACE = r"\u0009-\u000D\u001C-\u0020\u0085\p{Z}"  # inside a class: str.isspace()
WHITE_SPACE = r"\u0009-\u000D\u0020\u0085\p{Z}"  # the Unicode property White_Space
# Unicode word characters: letters, marks, decimal and letter digits, connectors, joiners
# and the enclosed letters, which count as alphabetic
WORD_CHARS = (  # the ASCII ranges say nothing new, they are only tried first
    r"a-zA-Z0-9_\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\u200C\u200D\u24B6-\u24E9"
    r"\x{1F130}-\x{1F149}\x{1F150}-\x{1F169}\x{1F170}-\x{1F189}"
)
#: The characters of SPACE one by one.
SPACE_LIST = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
WORD = rf"[^{SPACE}]+"
PRETOK = rf"[{WORD_CHARS}]+|[^{WORD_CHARS}{WHITE_SPACE}]+"
NOISE_CHARS = r"\u0640\u064B-\u0652"  # tatweel and Arabic diacritics (Java regex escapes)
NOISE = rf"[{NOISE_CHARS}]"
# detokenizer: no space before closing punctuation, none after opening brackets
DETOK_BEFORE = rf"[{SPACE}]+([،,.؟?!:;)\]»])"
DETOK_AFTER = rf"([(\[«])[{SPACE}]+"
# "13a" BLEU tokenizer steps (public definition), applied to ' ' + text + ' '
BLEU_13A_STEPS = (
    (r"([\{-\~\[-\` -\&\(-\+\:-\@\/])", " $1 "),
    (r"([^0-9])([\.,])", "$1 $2 "),
    (r"([\.,])([^0-9])", " $1 $2"),
    (r"([0-9])(-)", "$1 $2 "),
)
BLEU_13A_UNDO = (
    ("<skipped>", ""),
    ("-\n", ""),
    ("\n", " "),
    ("&quot;", '"'),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
)
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ustrip(col) -> Column:
    """Strip Unicode whitespace at both ends (``trim`` alone strips only U+0020); looks at the ends only."""
    return F.btrim(_c(col), F.lit(SPACE_LIST))


def words(col) -> Column:
    """Whitespace-separated words (same as Python ``str.split()``)."""
    return F.regexp_extract_all(_c(col), F.lit(WORD), 0)


def word_count(col) -> Column:
    return F.size(words(col))


def has_words(col, most: int, noise: str = "") -> Column:
    """Whether a text has 1 to ``most`` words without the characters of ``noise`` (inside of a
    class): one possessive pattern, no arrays, nothing deleted."""
    skip = SPACE + noise
    return F.rlike(_c(col), F.lit(rf"^[{skip}]*+(?:[^{skip}][^{SPACE}]*+[{skip}]*+){{1,{most}}}\z"))


def pretokenize(col) -> Column:
    """Runs of word characters, or runs of other non-space characters; case kept."""
    return F.regexp_extract_all(_c(col), F.lit(PRETOK), 0)


def clean_noise(col, noise: str = NOISE) -> Column:
    """Delete the noise character class, then Unicode-strip."""
    return ustrip(F.regexp_replace(_c(col), noise, ""))


def detok(col) -> Column:
    """Undo the spaces a whitespace pre-tokenizer puts around punctuation."""
    c = F.regexp_replace(_c(col), DETOK_BEFORE, "$1")
    c = F.regexp_replace(c, DETOK_AFTER, "$1")
    return ustrip(c)


def tokenize_13a(col, undo: bool = True) -> Column:
    """The "13a" tokenization used for BLEU, as an ``array<string>``."""
    c = _c(col)
    if undo:
        for old, new in BLEU_13A_UNDO:
            c = F.replace(c, F.lit(old), F.lit(new))
    c = F.concat(F.lit(" "), c, F.lit(" "))
    for pat, rep in BLEU_13A_STEPS:
        c = F.regexp_replace(c, pat, rep)
    return F.regexp_extract_all(c, F.lit(WORD), 0)


def over_length(col, max_words: int) -> Column:
    """True when a text has more words than ``max_words``."""
    return word_count(col) > F.lit(max_words)
