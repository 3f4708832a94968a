import random
import re

from bitext.llm import urlfilter as U


def brute(url, rules=U.RULES, block=U.BLOCK_GLOBS):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule, verdict in rules:
        name, _, tail = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + tail):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    if best:
        return host, path, *best
    hit = any(g.strip("*") in "." + host + path for g in block)
    return host, path, None, "block" if hit else "allow"


def test_rules_equal_brute_force(spark):
    rng = random.Random(1)
    hosts = ["example.org", "EXAMPLE.org", "a.example.org", "notexample.org", "org", "x.com", "com", "b.c.com", "net", "spam-farm.net", "cheap-pills.example.com", "user@example.org", "É.org", ""]
    paths = ["", "/", "/es/", "/es/1", "/en/1", "/en/12", "/fr/", "/de/x", "/x.org/", "/a/://b.org/", "/casino"]
    urls = [f"{s}{h}{p}{q}" for s in ("http://", "HTTPS://", "", "://", "a\nb://") for h in hosts for p in paths for q in ("", "?q=/es/", "#t")]
    urls += [None, "", "no scheme", "http://" + "a" * 70000 + ".org/x", "http://x.com/fr/" + "é" * 500]
    rng.shuffle(urls)
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls)], "page_id long, url string, host string, verdict string").repartition(3)
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in U.judge(pages).collect()}
    assert got == {i: brute(u) for i, u in enumerate(urls)}


def as_regex(glob):
    out = []
    for m in re.finditer(r"\\(.)|(\*\*+)|(\*)|(.)", glob, re.S):
        out.append(".*" if m[2] else "[^/]*" if m[3] else re.escape(m[1] or m[4]))
    return re.compile("".join(out), re.S)


def test_automaton_over_many_words_equals_regular_expressions():
    rng = random.Random(3)
    def glob():
        return "".join(rng.choice(["a", "b", "/", "*", "**", "ab", "."]) for _ in range(rng.randint(1, 9)))
    globs = [glob() for _ in range(120)]
    machine = U.Automaton([U.Glob(g, g, "x", len(globs) - i) for i, g in enumerate(globs)])
    assert machine.words > 5
    urls = ["".join(rng.choice("ab/.") for _ in range(rng.randint(0, 14))) for _ in range(600)]
    want = [next((i for i, g in enumerate(globs) if as_regex(g).fullmatch(u)), -1) for u in urls]
    assert machine.match([u.encode() for u in urls]).tolist() == want


def test_repeats_and_empty_table(spark):
    assert U.judge(spark.createDataFrame([(1, "http://a.org/")] * 2, "page_id long, url string")).count() == 2
    assert U.judge(spark.createDataFrame([], "page_id long, url string")).collect() == []
