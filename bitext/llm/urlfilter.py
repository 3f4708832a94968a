"""URL filter: all glob rules at once, by a bit-parallel Shift-And automaton.

A rule is a glob over the canonical URL ``"." + host + path`` (so that ``*.`` in
front of a host also stands for the host itself).  ``**`` is any text, ``*`` any
text without ``/``, everything else stands for itself.  Every literal byte of
every rule is one bit of a state vector that spans several 64-bit words; reading
a byte shifts all states by one and keeps those whose next literal it is, and
states in front of a wildcard stay.  One pass over the bytes of a URL thus runs
every rule; numpy does it for a batch of URLs of similar length at a time.

Rules are configuration: the masks are built on the driver and travel with the
task, with a checked size.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitext.llm.common import map_slices, pick

#: Bits of all rules together: masks of 256 bytes x this many bits, twice.
MAX_STATES = 1 << 20
#: The rules of the registered query, (rule, verdict).
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
#: The method's own globs for URLs that no rule fits; what they don't match is allowed.
BLOCK_GLOBS = ("**spam-farm**", "**cheap-pills**", "**casino**", "**viagra**", "**porn**", "**torrent**")


@dataclass(frozen=True)
class Glob:
    pattern: str
    rule: str | None
    verdict: str
    weight: int  # of the globs that match, the heaviest decides


def rule_globs(rules=RULES, block=BLOCK_GLOBS) -> list[Glob]:
    """Host rules fit the host and its subdomains and any path that they begin; longest wins."""
    out = [Glob("*." + _quoted(rule) + "**", rule, verdict, 1 + len(rule)) for rule, verdict in rules]
    return out + [Glob(g, None, "block", 0) for g in block]


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("*", "\\*")


def glob_parts(pattern: str) -> list[tuple[str, int]]:
    """('lit', byte), ('seg', 0) for ``*`` and ('any', 0) for ``**``; ``\\`` quotes."""
    out = []
    for m in re.finditer(r"\\(.)|(\*\*+)|(\*)|(.)", pattern, re.S):
        if m[2]:
            out.append(("any", 0))
        elif m[3]:
            out.append(("seg", 0))
        else:
            out += [("lit", b) for b in (m[1] or m[4]).encode()]
    return out


class Automaton:
    """Masks of a set of globs; ``match`` gives the heaviest glob of each URL."""

    def __init__(self, globs: list[Glob]):
        self.globs = globs
        step, stay, start, final = [], [], [], []
        for g in globs:
            start.append(len(step))
            step.append(None)  # the state before the first literal: nothing leads there
            stay.append(set())
            for kind, byte in glob_parts(g.pattern):
                if kind == "lit":
                    step.append(byte)
                    stay.append(set())
                else:
                    stay[-1].add(kind)
            final.append(len(step) - 1)
        n = len(step)
        if n > MAX_STATES:
            raise ValueError(f"{n} states are over {MAX_STATES}")
        self.words = words = max(1, -(-n // 64))
        bits = np.zeros((256, words * 64), np.uint8)
        loops = np.zeros((256, words * 64), np.uint8)
        for i, (byte, kinds) in enumerate(zip(step, stay)):
            if byte is not None:
                bits[byte, i] = 1
            if kinds:
                loops[:, i] = 1
                if "any" not in kinds:
                    loops[ord("/"), i] = 0
        pack = lambda x: np.packbits(x, axis=-1, bitorder="little").view("<u8")
        self.step, self.stay = pack(bits), pack(loops)
        first = np.zeros(words * 64, np.uint8)
        first[start] = 1
        self.first = pack(first)
        self.final = np.array(final, np.int64)
        # heaviest first; among equals the one listed first
        self.order = np.array(sorted(range(len(globs)), key=lambda i: -globs[i].weight), np.int64)

    def match(self, urls: list[bytes]) -> np.ndarray:
        """Index of the deciding glob of each URL, -1 for none."""
        out = np.full(len(urls), -1, np.int64)
        sizes = np.array([len(u) for u in urls], np.int64)
        order = np.argsort(sizes, kind="stable")
        at = 0
        while at < len(order):
            top = max(int(sizes[order[at]]) * 5 // 4, int(sizes[order[at]]) + 8)
            end = min(int(np.searchsorted(sizes[order], top, "right")), at + max(1, (1 << 22) // (top * self.words)))
            rows = order[at:end]
            out[rows] = self._run([urls[i] for i in rows], sizes[rows])
            at = end
        return out

    def _run(self, urls: list[bytes], sizes: np.ndarray) -> np.ndarray:
        width = int(sizes.max()) if len(sizes) else 0
        flat = np.frombuffer(b"".join(u.ljust(width, b"\0") for u in urls), np.uint8).reshape(len(urls), width)
        state = np.repeat(self.first[None, :], len(urls), axis=0)
        one, top = np.uint64(1), np.uint64(63)
        for col in range(width):
            live = int(np.searchsorted(sizes, col, "right"))  # rows are sorted by length
            now, byte = state[live:], flat[live:, col]
            moved = now << one
            moved[:, 1:] |= now[:, :-1] >> top
            state[live:] = (moved & self.step[byte]) | (now & self.stay[byte])
        best = np.full(len(urls), -1, np.int64)
        for g in self.order[::-1]:  # the heaviest writes last
            hit = (state[:, self.final[g] // 64] >> np.uint64(self.final[g] % 64)) & one
            best[hit.astype(bool)] = g
        return best


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge(
    pages: DataFrame, rules=RULES, block=BLOCK_GLOBS, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page.

    ``rule`` is the longest rule that fits (of equal ones the one listed first),
    else null; ``verdict`` is that rule's, else ``block`` if a block glob
    matches, else ``allow``.  Null URLs and URLs without ``://`` have an empty
    host and path and are judged so; repeated rows give repeated rows.
    """
    machine = Automaton(rule_globs(rules, block))

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            hosts, paths = batch["host"].to_pylist(), batch["path"].to_pylist()
            hit = machine.match([f".{h}{p}".encode() for h, p in zip(hosts, paths)])
            return {
                "page_id": batch["page_id"], "host": batch["host"], "path": batch["path"],
                "rule": [machine.globs[i].rule if i >= 0 else None for i in hit.tolist()],
                "verdict": [machine.globs[i].verdict if i >= 0 else "allow" for i in hit.tolist()],
            }

        return run

    rows = pick(pages, page_id=id_col, url=url_col)
    parts = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return map_slices(parts, make, "page_id long, host string, path string, rule string, verdict string", 4096)


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def judge_sql(rules=RULES, block=BLOCK_GLOBS) -> str:
    """DuckDB SQL for ``judge`` with the same rules (globs of the form ``**word**``)."""
    values = ", ".join(f"({_sql_text(r)}, {_sql_text(v)}, {i})" for i, (r, v) in enumerate(rules))
    words = " OR ".join(f"contains('.' || host || path, {_sql_text(g.strip('*'))})" for g in block) or "FALSE"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH rules(rule, verdict, pos) AS (VALUES {values}),
parts AS (
  SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{upper}', '{lower}') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
hosts AS (SELECT DISTINCT host FROM parts),
fits AS (
  SELECT h.host, r.rule, r.verdict, r.pos, substr(r.rule, strpos(r.rule, '/')) AS rule_path
  FROM hosts h JOIN rules r
    ON ends_with('.' || h.host, '.' || substr(r.rule, 1, strpos(r.rule, '/') - 1))),
best AS (
  SELECT p.host, p.path, arg_min(f.rule, -1000 * length(f.rule) + f.pos) AS rule,
         arg_min(f.verdict, -1000 * length(f.rule) + f.pos) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) p JOIN fits f ON p.host = f.host AND starts_with(p.path, f.rule_path)
  GROUP BY p.host, p.path)
SELECT p.page_id, p.host, p.path, b.rule,
  coalesce(b.verdict, CASE WHEN {words.replace("host", "p.host").replace("path", "p.path")} THEN 'block' ELSE 'allow' END) AS verdict
FROM parts p LEFT JOIN best b ON p.host = b.host AND p.path = b.path"""
