"""Quality rules as a short-circuit cascade.

Each rule reads measures of a text and rejects or passes it; a text is kept if
no rule rejects it.  On a sample drawn from all partitions the cost of each rule
(time to evaluate it and the measures it alone needs) and its selectivity (share
rejected) are estimated, where the rows are, and rules run in the order of
rejection per cost, so that most rejected texts meet a cheap rule first and dear
measures are taken only of those that remain.
The order changes the work, never the verdict: a text is kept exactly if all
rules pass it.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bitext.llm.common import map_slices, pick

#: Rows, on the average, of the sample on which costs and selectivities are estimated.
SAMPLE_ROWS = 400
SAMPLE_SEED = 7
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
WINDOW = 5


class Measures:
    """Measures of one text, each taken when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self._got: dict = {}

    def __getattr__(self, name: str):
        got = self.__dict__["_got"]
        if name not in got:
            got[name] = _MEASURES[name](self)
        return got[name]


def _repeat_words(m: Measures) -> int:
    """Words in 5-word windows that occur twice or more, the first included."""
    words = m.words
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    if len(number) == len(words):
        return 0
    # windows by exact ids: pairs of equal halves get equal numbers
    two = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)[1]
    four = two[:-2] * len(two) + two[2:]
    four = np.unique(four, return_inverse=True)[1]
    _, five, count = np.unique(four[:n] * len(number) + ids[WINDOW - 1 :], return_inverse=True, return_counts=True)
    again = np.flatnonzero(count[five] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + WINDOW, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum())


def _dup_lines(m: Measures) -> int:
    lines = [x for x in m.text.split("\n") if x and _WORD.search(x)]
    return len(lines) - len(set(lines))


_MEASURES: dict[str, Callable[[Measures], object]] = {
    "words": lambda m: _WORD.findall(m.text),
    "n_words": lambda m: len(m.words),
    "word_chars": lambda m: sum(map(len, m.words)),
    "n_symbols": lambda m: len(_SYMBOL.findall(m.text)),
    "n_lines": lambda m: sum(1 for x in m.text.split("\n") if _WORD.search(x)),
    "n_dup_lines": _dup_lines,
    "n_repeat_words": _repeat_words,
}


@dataclass(frozen=True)
class Rule:
    """``sql`` says the same as ``rejects`` over columns named as the measures."""

    name: str
    rejects: Callable[[Measures], bool]
    sql: str


#: Base rules first (contract), then the method's own.
RULES = (
    Rule("few_words", lambda m: m.n_words < 10, "n_words < 10"),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 20 * m.n_words, "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", lambda m: 10 * m.n_symbols > 3 * m.n_words, "10 * n_symbols > 3 * n_words"),
    Rule("word_length", lambda m: m.word_chars > 25 * m.n_words, "word_chars > 25 * n_words"),
    Rule("duplicate_lines", lambda m: 2 * m.n_dup_lines > m.n_lines, "2 * n_dup_lines > n_lines"),
)
BASE_RULES = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Estimate:
    name: str
    cost: float  # seconds a text, with the measures it needs
    rejected: float  # share of the sample


def tally(texts: list[str | None], rules=RULES) -> list[tuple[str, float, int]]:
    """(rule, seconds, texts rejected) of each rule over the texts, each on fresh measures."""
    out = []
    for rule in rules:
        began = time.perf_counter()
        hits = sum(bool(rule.rejects(Measures(t))) for t in texts)
        out.append((rule.name, time.perf_counter() - began, hits))
    return out


def order(estimates: list[Estimate]) -> list[str]:
    """Rule names by rejection per cost, the best first; ties by name."""
    return [e.name for e in sorted(estimates, key=lambda e: (-(e.rejected + 1e-6) / max(e.cost, 1e-9), e.name))]


def estimate(docs: DataFrame, text_col: str = "text", rules=RULES, rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Cost and selectivity of each rule on a random sample of about ``rows`` rows of the whole table.

    Every row has the same chance, wherever it lies.  The texts are measured in
    the tasks that read them; only sums come back.
    """
    n = docs.count()
    sample = docs.select(docs[text_col].cast("string").alias("text")).sample(min(1.0, rows / max(n, 1)), SAMPLE_SEED)

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            texts = batch["text"].to_pylist()
            names, seconds, hits = zip(*tally(texts, rules))
            return {"rule": list(names), "seconds": list(seconds), "hits": list(hits), "texts": [len(texts)] * len(names)}

        return run

    # rules that no text was measured for have no row
    sums = map_slices(sample, make, "rule string, seconds double, hits long, texts long").groupBy("rule").sum()
    got = {r["rule"]: (r["sum(seconds)"] / r["sum(texts)"], r["sum(hits)"] / r["sum(texts)"]) for r in sums.collect()}
    return [Estimate(r.name, *got.get(r.name, (0.0, 0.0))) for r in rules]


def first_rejection(m: Measures, ordered: list[Rule]) -> str | None:
    """The cascade: the first rule, in this order, that rejects; later ones are not run."""
    return next((r.name for r in ordered if r.rejects(m)), None)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES, measures: bool = True) -> DataFrame:
    """(doc_id, kept, [measures, base_failed]) for every text, whole.

    ``measures=False`` runs the bare cascade, which takes no more measures of a
    text than its verdict needs.  A null text has no words; repeated rows give
    repeated rows; an empty table gives an empty result.
    """
    rows = pick(docs, doc_id=id_col, text=text_col)
    names = order(estimate(docs, text_col, rules)) if rules else []
    by_name = {r.name: r for r in rules}
    wanted = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words") if measures else ()
    base = [by_name[n] for n in BASE_RULES if n in by_name]

    def make():
        ordered = [by_name[n] for n in names]

        def run(batch: pa.RecordBatch) -> dict:
            out: dict[str, list] = {"doc_id": batch["doc_id"], "kept": [], **{w: [] for w in wanted}}
            failed = []
            for text in batch["text"].to_pylist():
                m = Measures(text)
                out["kept"].append(first_rejection(m, ordered) is None)
                for w in wanted:
                    out[w].append(getattr(m, w))
                if measures:
                    failed.append(any(r.rejects(m) for r in base))
            return out | ({"base_failed": failed} if measures else {})

        return run

    schema = "doc_id long, kept boolean" + "".join(f", {w} long" for w in wanted) + (", base_failed boolean" if measures else "")
    return map_slices(rows, make, schema)


def judge_sql(rules=RULES) -> str:
    """DuckDB SQL for ``judge`` over ``documents``."""
    base = " OR ".join(f"({r.sql})" for r in rules if r.name in BASE_RULES)
    every = " OR ".join(f"({r.sql})" for r in rules)
    return rf"""
WITH texts AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT row_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM texts),
lines AS (
  SELECT row_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT row_id, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_id),
grams AS (
  SELECT row_id, i, array_to_string(ws[i : i + {WINDOW - 1}], ' ') AS gram
  FROM (SELECT row_id, ws, unnest(generate_series(1, len(ws) - {WINDOW - 1})) AS i FROM words WHERE len(ws) >= {WINDOW})),
again AS (SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, gram) AS c FROM grams) WHERE c > 1),
covered AS (
  SELECT row_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT row_id, unnest(generate_series(i, i + {WINDOW - 1})) AS p FROM again) GROUP BY row_id),
m AS (
  SELECT t.doc_id, len(w.ws) AS n_words, length(array_to_string(w.ws, '')) AS word_chars,
    len(regexp_extract_all(t.text, '[#*$%&|<>]')) AS n_symbols, coalesce(l.n_lines, 0) AS n_lines,
    coalesce(l.n_dup_lines, 0) AS n_dup_lines, coalesce(c.n_repeat_words, 0) AS n_repeat_words
  FROM texts t JOIN words w USING (row_id) LEFT JOIN lines l USING (row_id) LEFT JOIN covered c USING (row_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  ({base}) AS base_failed, NOT ({every}) AS kept FROM m"""
