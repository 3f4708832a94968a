"""Toxicity classifier whose scores may not depend on which group is named.

Logistic regression over the presence of word pieces (whole words and their
beginnings).  Each labelled sentence that names a group is rewritten with the
group's other names; the squared change of the raw score between a text and its
rewritten twin is added to the loss, so that the names themselves, which stand in
attacks as well as in neutral mentions, get no weight that their exchange would
show.  Every list of names holds a neutral word too, which anchors them.

Spark counts in how many toxic and other texts a piece stands, the pieces with
the clearest difference become the features, and each round of the optimiser is
one job that sums loss and gradient over the partitions of a written table of
feature numbers.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitext.llm.common import kept, map_slices, pick, ship

#: Labelled texts that the fit uses at most; beyond it an even share by hash of the id.
MAX_TRAIN_ROWS = 40_000
MAX_FEATURES = 20_000
MIN_Z = 4.0  # standard deviations between the two rates of a piece that becomes a feature
PIECES = (3, 4, 5, 6, 7, 8)  # code points of the beginnings of words
MAX_WORD = 24  # code points of a word that count
RIDGE = 1e-4
SWAP_WEIGHT = 1.0  # of the squared score changes against the logistic loss
ROUNDS = 60
THRESHOLD = 0.5
FOLDS = 5  # one of five is held out

#: Names of groups, each list with a neutral word first: a parameter of ``classify``.
GROUPS: tuple[tuple[str, ...], ...] = (
    ("people", "women", "men", "girls", "boys", "muslims", "christians", "jews", "hindus", "buddhists", "immigrants", "refugees",
     "gays", "lesbians", "transgender", "africans", "asians", "arabs", "mexicans", "latinos", "disabled", "elderly"),
    ("person", "woman", "man", "girl", "boy", "muslim", "christian", "jew", "hindu", "buddhist", "immigrant", "refugee",
     "gay", "lesbian", "african", "asian", "arab", "mexican", "latino", "black", "white", "deaf", "blind"),
    ("menschen", "frauen", "männer", "muslime", "christen", "juden", "ausländer", "flüchtlinge", "behinderte", "homosexuelle", "afrikaner", "türken"),
    ("mensch", "frau", "mann", "muslim", "christ", "jude", "ausländer", "flüchtling", "afrikaner", "türke"),
    ("gens", "femmes", "hommes", "musulmans", "chrétiens", "juifs", "immigrés", "réfugiés", "handicapés", "homosexuels", "africains", "arabes"),
    ("personne", "femme", "homme", "musulman", "chrétien", "juif", "immigré", "réfugié", "handicapé", "homosexuel", "africain", "arabe"),
    ("personas", "mujeres", "hombres", "musulmanes", "cristianos", "judíos", "inmigrantes", "refugiados", "discapacitados", "homosexuales", "africanos", "árabes"),
    ("persona", "mujer", "hombre", "musulmán", "cristiano", "judío", "inmigrante", "refugiado", "discapacitado", "homosexual", "africano", "árabe"),
)

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    """Different lower-cased runs of letters, cut to ``MAX_WORD``."""
    return {w[:MAX_WORD] for w in _WORD.findall((text or "").lower())}


def pieces_of(word: str) -> list[str]:
    """The beginnings of a word and, with a mark, the whole of it."""
    return [word[:n] for n in PIECES if n <= len(word)] + [word + "$"]


def twins(words: set[str], groups: tuple[tuple[str, ...], ...] = GROUPS) -> list[set[str]]:
    """The words of a text with every group name replaced by the list's next one, and by its neutral word.

    None where no group is named, so that most texts have no twins.
    """
    out = []
    for shift in (0, 1):
        swapped = set(words)
        for names in groups:
            for name in words.intersection(names):
                swapped.discard(name)
                swapped.add(names[0] if shift == 0 else names[(names.index(name) + 1) % len(names)])
        if swapped != words:
            out.append(swapped)
    return out


def is_held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0 (a null id is not held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def word_counts(train: DataFrame) -> DataFrame:
    """``(word, toxic, other)``: in how many texts a word stands, weighted by their labels."""
    ship(train.sparkSession)
    schema = pa.schema([("word", pa.string()), ("toxic", pa.float64()), ("other", pa.float64())])

    def batch_of(toxic: Counter, other: Counter) -> pa.RecordBatch:
        words = list(toxic.keys() | other.keys())
        columns = words, [toxic[w] for w in words], [other[w] for w in words]
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, other = Counter(), Counter()
        for batch in batches:
            for text, y in zip(batch["text"], batch["y"].to_pylist()):
                words = words_of(text.as_py())
                if y == 0 or y == 1:
                    (toxic if y else other).update(words)
                else:
                    for w in words:
                        toxic[w] += y
                        other[w] += 1 - y
                if len(toxic) + len(other) > 300_000:
                    yield batch_of(toxic, other)
                    toxic, other = Counter(), Counter()
        yield batch_of(toxic, other)

    parts = train.select("text", "y").mapInArrow(run, "word string, toxic double, other double")
    return parts.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def choose_features(train: DataFrame, n_toxic: float, n_other: float, max_features: int = MAX_FEATURES, min_z: float = MIN_Z) -> list[str]:
    """The pieces whose rates in toxic and other texts differ most clearly, in order.

    A piece's texts are counted as the sum of its words', at most all texts.
    """
    counts = word_counts(train)
    marked = F.concat("word", F.lit("$"))
    starts = F.array(*[F.when(F.length("word") >= n, F.substring("word", 1, n)) for n in PIECES], marked)
    pieces = counts.select(F.explode(starts).alias("piece"), "toxic", "other").where("piece is not null")
    sums = pieces.groupBy("piece").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    p = F.least(F.col("toxic") / n_toxic, F.lit(1.0))
    q = F.least(F.col("other") / n_other, F.lit(1.0))
    both = (F.least(F.col("toxic"), F.lit(n_toxic)) + F.least(F.col("other"), F.lit(n_other)) + 1) / (n_toxic + n_other + 2)
    z = (p - q) / F.sqrt(F.greatest(both * (1 - both), F.lit(1e-12)) * (1 / n_toxic + 1 / n_other))
    best = sums.withColumn("z", F.abs(z)).where(F.col("z") >= min_z).orderBy(F.col("z").desc(), "piece").limit(max_features)
    return [r["piece"] for r in best.select("piece").collect()]


@dataclass
class Model:
    """Features by number, their weights and the constant."""

    features: list[str]
    weights: np.ndarray
    constant: float

    def scorer(self):
        """A function from texts to scores with a memory of words, for one task."""
        weight = dict(zip(self.features, self.weights.tolist()))
        numbers = {piece: k for k, piece in enumerate(self.features)}
        seen: dict[str, tuple[int, ...]] = {}

        def score(text: str | None) -> float:
            found: set[int] = set()
            for word in words_of(text):
                got = seen.get(word)
                if got is None:
                    if len(seen) >= 200_000:
                        seen.clear()
                    got = seen[word] = numbers_of(word, numbers)
                found.update(got)
            raw = self.constant + sum(weight[self.features[k]] for k in sorted(found))
            return float(1 / (1 + np.exp(-np.clip(raw, -700, 700))))

        return score


def numbers_of(word: str, numbers: dict[str, int]) -> tuple[int, ...]:
    return tuple(numbers[p] for p in pieces_of(word) if p in numbers)


def training_rows(train: DataFrame, features: list[str], groups=GROUPS) -> DataFrame:
    """``(y, on, plus, minus)``: a text's feature numbers and, per twin, those it gains and loses."""
    numbers = {piece: k for k, piece in enumerate(features)}

    def make():
        def on(words: set[str]) -> set[int]:
            return {k for w in words for k in numbers_of(w, numbers)}

        def run(batch: pa.RecordBatch) -> dict:
            out = {"y": batch["y"], "on": [], "plus": [], "minus": []}
            for text in batch["text"]:
                words = words_of(text.as_py())
                own = on(words)
                others = [on(t) for t in twins(words, groups)]
                out["on"].append(sorted(own))
                out["plus"].append([sorted(o - own) for o in others])
                out["minus"].append([sorted(own - o) for o in others])
            return out

        return run

    return map_slices(train.select("text", "y"), make, "y double, on array<int>, plus array<array<int>>, minus array<array<int>>")


def _sums(lists: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Sum of the weights of each list of numbers."""
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    total = np.append(0.0, np.cumsum(weights[flat]))
    return total[ends] - total[np.append(0, ends[:-1])] if len(ends) else np.zeros(0)


def _spread(lists: pa.Array, values: np.ndarray, size: int) -> np.ndarray:
    """Each row's value added at each number of its list."""
    flat, lengths = lists.flatten().to_numpy(zero_copy_only=False), lists.value_lengths().to_numpy(zero_copy_only=False)
    return np.bincount(flat, np.repeat(values, lengths), size)


def loss_and_gradient(rows: DataFrame, theta: np.ndarray, n: float, swap_weight: float) -> tuple[float, np.ndarray]:
    """Mean logistic loss plus ``swap_weight`` times the mean squared score change, and its gradient.

    ``theta``: the weights and the constant.  One job; a partition returns one row.
    """
    size = len(theta) - 1
    schema = pa.schema([("part", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros(size + 2)
        w, c = theta[:-1], theta[-1]
        for batch in batches:
            y, on = batch["y"].to_numpy(zero_copy_only=False), batch["on"]
            raw = _sums(on, w) + c
            out[0] += np.sum(np.logaddexp(0, raw) - y * raw)
            error = 1 / (1 + np.exp(-np.clip(raw, -700, 700))) - y
            out[1:-1] += _spread(on, error, size)
            out[-1] += error.sum()
            plus, minus = batch["plus"].flatten(), batch["minus"].flatten()
            if len(plus):
                change = _sums(plus, w) - _sums(minus, w)
                out[0] += swap_weight * np.sum(change**2)
                out[1:-1] += 2 * swap_weight * (_spread(plus, change, size) - _spread(minus, change, size))
        yield pa.RecordBatch.from_pydict({"part": [out.tobytes()]}, schema=schema)

    parts = rows.mapInArrow(run, "part binary").collect()  # a row per partition, 32 at most
    total = sum(np.frombuffer(r["part"]) for r in parts) / n
    loss = total[0] + RIDGE / 2 * float(theta[:-1] @ theta[:-1])
    return float(loss), total[1:] + RIDGE * np.append(theta[:-1], 0.0)


def minimise(value, theta: np.ndarray, rounds: int = ROUNDS, memory: int = 10, tolerance: float = 1e-5) -> np.ndarray:
    """Quasi-Newton steps with a limited memory; ``value`` gives loss and gradient."""
    loss, gradient = value(theta)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    used = 1
    while used < rounds and np.abs(gradient).max() > tolerance:
        direction, kept_dots = -gradient, []
        for s, g in reversed(steps):
            a = (s @ direction) / (s @ g)
            direction = direction - a * g
            kept_dots.append(a)
        if steps:
            s, g = steps[-1]
            direction = direction * (s @ g) / (g @ g)
        for (s, g), a in zip(steps, reversed(kept_dots)):
            direction = direction + (a - (g @ direction) / (s @ g)) * s
        rate = 1.0 if steps else 1 / max(np.abs(gradient).sum(), 1e-12)
        slope = gradient @ direction
        while True:
            there = theta + rate * direction
            new_loss, new_gradient = value(there)
            used += 1
            if new_loss <= loss + 1e-4 * rate * slope or used >= rounds:
                break
            rate /= 4
        if new_loss > loss:
            break
        s, g = there - theta, new_gradient - gradient
        if s @ g > 1e-12:
            steps = [*steps[-memory + 1 :], (s, g)]
        theta, loss, gradient = there, new_loss, new_gradient
    return theta


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", max_rows: int = MAX_TRAIN_ROWS, groups=GROUPS,
        swap_weight: float = SWAP_WEIGHT, id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """Fit on labelled texts that are not held out; None unless both labels occur.

    Rows with a null id or label don't count; several labels of one id are averaged.
    """
    spark = docs.sparkSession
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y"))
        .where("doc_id is not null and y is not null")
        .where(~is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.avg("y").alias("y"))
    )
    n = marks.count()
    if not n:
        return None
    if n > max_rows:
        marks = marks.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(1_000_000 * max_rows // n))
    marks = F.broadcast(marks)  # about max_rows rows of 16 bytes at most
    train = kept(spark, pick(docs, doc_id=id_col, text=text_col).join(marks, "doc_id").select("text", "y"), "toxicity-train")
    n, n_toxic = train.agg(F.count("*"), F.sum("y")).first()
    if not n or not 0 < n_toxic < n:
        return None
    features = choose_features(train, float(n_toxic), float(n - n_toxic))
    rows = kept(spark, training_rows(train, features, groups).coalesce(32), "toxicity-rows").coalesce(32)
    start = np.append(np.zeros(len(features)), np.log(n_toxic / (n - n_toxic)))
    theta = minimise(lambda t: loss_and_gradient(rows, t, n, swap_weight), start)
    return Model(features, theta[:-1], float(theta[-1]))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
             max_rows: int = MAX_TRAIN_ROWS, groups=GROUPS, swap_weight: float = SWAP_WEIGHT) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Only the text enters a score.  Null texts score like empty ones; repeated rows
    give repeated rows; an empty table an empty result.  Without labelled texts of
    both kinds to learn from every score is 0: nothing is known against a text.
    """
    model = fit(docs, labels, max_rows=max_rows, groups=groups, swap_weight=swap_weight, id_col=id_col, text_col=text_col)
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)

    def make():
        score = sent.value.scorer() if sent.value else (lambda _: 0.0)

        def run(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch["doc_id"], "score": [score(t.as_py()) for t in batch["text"]]}

        return run

    scored = map_slices(pick(docs, doc_id=id_col, text=text_col), make, "doc_id long, score double")
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
