import random

from bitext.llm import cascade as C


def brute(text):
    text = text or ""
    def cut(s):
        out, word = [], ""
        for c in s + " ":
            if c in " \t\n\x0b\x0c\r":
                out += [word] if word else []
                word = ""
            else:
                word += c
        return out
    words = cut(text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    covered = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if cut(x)]
    m = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": sum(x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(covered)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    kept = not failed and not (10 * m["n_symbols"] > 3 * len(words) or m["word_chars"] > 25 * len(words) or 2 * m["n_dup_lines"] > len(lines))
    return m | {"base_failed": failed, "kept": kept}


def texts():
    rng = random.Random(12)
    out = ["", None, "a b c d e f g h i j", "x " * 40, "one two three four five\n" * 3, " \x1c\x85 nbsp is a word here", "#" * 30]
    for _ in range(150):
        vocab = [rng.choice("ab#") * rng.randint(1, 3) + str(i) for i in range(rng.randint(1, 30))]
        out.append("".join(rng.choice(vocab) + rng.choice([" ", " ", "\n", "\t", "\x0b"]) for _ in range(rng.randint(0, 60))))
    return out


def test_measures_and_verdicts_equal_brute_force(spark):
    rows = list(enumerate(texts()))
    got = C.judge(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    for r in got:
        want = brute(rows[r["doc_id"]][1])
        assert {k: r[k] for k in want} == want, rows[r["doc_id"]]
    assert len(got) == len(rows)


def test_order_is_rejection_per_cost_and_never_changes_the_verdict():
    e = [C.Estimate("dear", 10.0, 0.5), C.Estimate("cheap", 0.1, 0.1), C.Estimate("idle", 0.1, 0.0)]
    assert C.order(e) == ["cheap", "dear", "idle"]
    rng = random.Random(1)
    for text in texts():
        verdicts = set()
        for _ in range(4):
            rules = list(C.RULES)
            rng.shuffle(rules)
            verdicts.add(C.first_rejection(C.Measures(text), rules) is None)
        assert len(verdicts) == 1


def test_cascade_stops_at_the_first_rejection():
    m = C.Measures("too few")
    by_name = {r.name: r for r in C.RULES}
    assert C.first_rejection(m, [by_name["few_words"], by_name["repeated_words"]]) == "few_words"
    assert "n_repeat_words" not in m._got


def test_sample_is_drawn_from_the_whole_table(spark):
    """A table sorted so that its first partitions hold nothing that a rule rejects."""
    good = "these are ten words of a line that no rule rejects here"
    rows = [(i, good if i < 8_000 else f"bad {i}") for i in range(16_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(8, "doc_id")
    got = {e.name: e for e in C.estimate(table)}
    assert set(got) == {r.name for r in C.RULES}
    assert 0.35 < got["few_words"].rejected < 0.65 and got["symbols"].rejected == 0
    assert all(e.cost > 0 for e in got.values())
    assert C.order(list(got.values()))[0] == "few_words"


def test_no_rows_and_no_rules(spark, no_docs, edge_docs):
    assert all((e.cost, e.rejected) == (0, 0) for e in C.estimate(no_docs))
    assert C.judge(edge_docs, rules=(), measures=False).where("kept").count() == 9


def test_edges_of_the_input(edge_docs, no_docs):
    got = C.judge(edge_docs)
    assert got.count() == 9
    assert C.judge(edge_docs, measures=False).columns == ["doc_id", "kept"]
    assert C.judge(no_docs).collect() == []
