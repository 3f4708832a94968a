"""Quality classifier: ridge regression on random Fourier features, calibrated.

Document statistics (lengths, character classes, repetition) are standardised
and mapped to random Fourier features, whose inner products approximate a
Gaussian kernel.  Each partition sums its part of the normal equations, Spark
adds the parts row by row, and the driver solves one small system whose size is
the number of features.  Raw scores of a fold that the ridge has not seen are
counted in bins, and isotonic regression turns them into probabilities.

A text is read once: its statistics are written to the shared folder, the fit
and the scores work on those.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitext.llm.common import is_held_out, kept, map_slices, pick

#: Labelled rows that the fit uses at most; beyond it an even share by hash of the id.
MAX_TRAIN_ROWS = 2_000_000
FEATURES = 256
RIDGE = 1e-3
GAMMA = 0.06  # of the Gaussian kernel exp(-gamma |x - y|^2) over standardised statistics
THRESHOLD = 0.7
BIN = 1e-3  # width of the bins in which raw scores are counted
SEED = 7

_CLASSES = {
    "letters": bytes(range(65, 91)) + bytes(range(97, 123)), "upper": bytes(range(65, 91)), "digits": b"0123456789",
    "spaces": b" \t\n\r\x0b\x0c", "stops": b".?", "commas": b",;:", "bangs": b"!", "symbols": b"#*$%&<>@^~+=",
    "bars": b"|", "quotes": b"\"'`()[]{}", "high": bytes(range(128, 256)), "control": bytes(range(9)) + bytes(range(14, 32)),
}
_CLASS_OF = np.zeros((256, len(_CLASSES)))
for _k, _v in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_v), _k] = 1
STATISTICS = (
    "log_words", "word_length", "log_line_words", "distinct_words", "equal_neighbours", "dup_lines", "long_words",
    *_CLASSES, "upper_of_letters", "symbols_a_word", "bangs_a_word", "bars_a_word", "stops_a_word",
)


def statistics(text: str | None) -> list[float]:
    """The statistics of a text, in the order of ``STATISTICS``; all zero for an empty one."""
    if not text:
        return [0.0] * len(STATISTICS)
    data = text.encode()
    share = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ _CLASS_OF
    by = dict(zip(_CLASSES, share))
    words = data.split()
    n = max(len(words), 1)
    lines = [x for x in data.split(b"\n") if x.strip()]
    n_lines = max(len(lines), 1)
    return [
        float(np.log1p(len(words))),
        min(len(data) / n, 50.0),
        float(np.log1p(n / n_lines)),
        len(set(words)) / n**0.75,
        sum(map(eq, words, words[1:])) / n,
        1 - len(set(lines)) / n_lines if lines else 0.0,
        sum(1 for w in words if len(w) > 20) / n,
        *(share / len(data)).tolist(),
        by["upper"] / max(by["letters"], 1),
        min(by["symbols"] / n, 5.0),
        min(by["bangs"] / n, 5.0),
        min(by["bars"] / n, 5.0),
        min(by["stops"] / n, 5.0),
    ]


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x array<double>) of every whole text."""

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            return {"doc_id": batch["doc_id"], "x": [statistics(t) for t in batch["text"].to_pylist()]}

        return run

    return map_slices(pick(docs, doc_id=id_col, text=text_col), make, "doc_id long, x array<double>")


@dataclass
class Model:
    """Standardisation, Fourier features, ridge weights and the calibration curve."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    curve_x: np.ndarray
    curve_y: np.ndarray

    def fourier(self, x: np.ndarray) -> np.ndarray:
        return fourier((x - self.mean) / self.scale)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.fourier(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.curve_x, self.curve_y), 0.0, 1.0)


def fourier(x: np.ndarray) -> np.ndarray:
    """cos(xW + b) scaled so that inner products approximate the kernel, and a constant."""
    rng = np.random.default_rng(SEED)
    w = rng.normal(0.0, np.sqrt(2 * GAMMA), (x.shape[1], FEATURES))
    b = rng.uniform(0.0, 2 * np.pi, FEATURES)
    return np.hstack([np.sqrt(2 / FEATURES) * np.cos(np.clip(x, -8, 8) @ w + b), np.ones((len(x), 1))])


def isotonic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: the non-decreasing fit, as points (mean x, value) of its blocks."""
    blocks: list[list[float]] = []
    for a, b, w in sorted(zip(x.tolist(), y.tolist(), weight.tolist())):
        blocks.append([a * w, b * w, w])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    got = np.array(blocks)
    return got[:, 0] / got[:, 2], got[:, 1] / got[:, 2]


def _normal_equations(train: DataFrame, mean: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    size = FEATURES + 1

    def parts(batches):
        total, right = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            x = np.array(batch["x"].to_pylist(), float).reshape(-1, len(mean))
            y = batch["y"].to_numpy(zero_copy_only=False)
            for at in range(0, len(y), 4096):
                z = fourier((x[at : at + 4096] - mean) / scale)
                total += z.T @ z
                right += z.T @ y[at : at + 4096]
        rows = np.hstack([total, right[:, None]])
        yield pa.RecordBatch.from_pydict({"i": np.arange(size, dtype=np.int32), "row": [r.tobytes() for r in rows]}, schema=out)

    out = pa.schema([("i", pa.int32()), ("row", pa.binary())])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(r) for r in group["row"])
        return pd.DataFrame({"i": [group["i"].iloc[0]], "row": [total.tobytes()]})

    sums = train.select("x", "y").mapInArrow(parts, "i int, row binary").groupBy("i").applyInPandas(add, "i int, row binary")
    got = np.array([np.frombuffer(r["row"]) for r in sorted(sums.collect(), key=lambda r: r["i"])])  # FEATURES + 1 rows
    return got[:, :-1], got[:, -1]


def fit(stats: DataFrame, labels: DataFrame, label_col: str = "quality", max_rows: int = MAX_TRAIN_ROWS) -> Model | None:
    """Fit on labelled rows of ``stats`` that are not held out; None without any.

    Rows with a null id or label don't count; several labels of one id are averaged.
    """
    marks = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("double").alias("y"))
        .where("doc_id is not null and y is not null")
        .where(~is_held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.avg("y").alias("y"))
    )
    train = stats.join(marks, "doc_id").withColumn("fold", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4)
    train = kept(stats.sparkSession, train, "quality-train")
    n = train.count()
    if not n:
        return None
    if n > max_rows:
        train = train.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(1_000_000 * max_rows // n))
    train = train.coalesce(32)
    k = len(STATISTICS)
    row = train.agg(*[f(F.col("x")[i]) for i in range(k) for f in (F.avg, F.stddev_pop)]).first()
    mean, dev = np.array(row[0::2], float), np.array(row[1::2], float)
    scale = np.where(dev > 1e-9, dev, 1.0)
    # the ridge learns from two folds, the curve from the third
    left, right = _normal_equations(train.where("fold <> 3"), mean, scale)
    used = left[-1, -1]  # rows in the equations: the last feature is 1
    weights = np.linalg.solve(left + RIDGE * max(used, 1) * np.diag([1.0] * FEATURES + [1e-6]), right)
    model = Model(mean, scale, weights, np.array([0.0]), np.array([0.0]))

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            raw = model.raw(np.array(batch["x"].to_pylist(), float))
            return {"bin": np.rint(np.clip(raw, -1, 2) / BIN).astype(int).tolist(), "y": batch["y"]}

        return run

    curve = train.where("fold = 3") if not train.where("fold = 3").isEmpty() else train
    bins = map_slices(curve.select("x", "y"), make, "bin long, y double", 4096).groupBy("bin").agg(
        F.avg("y").alias("y"), F.count("*").alias("n")
    )
    got = np.array([(r["bin"] * BIN, r["y"], r["n"]) for r in bins.collect()], float)  # at most 3 / BIN rows
    model.curve_x, model.curve_y = isotonic(got[:, 0], got[:, 1], got[:, 2])
    return model


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
    max_rows: int = MAX_TRAIN_ROWS,
) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    Only the text enters a score.  Null texts score like empty ones; repeated
    rows give repeated rows; an empty table an empty result.  Without any
    labelled row to learn from every score is 1: nothing is known against a text.
    """
    stats = kept(docs.sparkSession, with_statistics(docs, id_col, text_col), "quality-stats")
    model = fit(stats, labels, max_rows=max_rows)

    def make():
        def run(batch: pa.RecordBatch) -> dict:
            if model is None:
                score = np.ones(batch.num_rows)
            else:
                score = model.score(np.array(batch["x"].to_pylist(), float))
            return {"doc_id": batch["doc_id"], "score": pa.array(score)}

        return run

    scored = map_slices(stats, make, "doc_id long, score double", 4096)
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text the classifier accepts, all columns kept.

    The fitted model is applied to each row's own text where it stands, so rows
    need no join and ids may be null or repeated.
    """
    stats = kept(docs.sparkSession, with_statistics(docs, id_col, text_col), "quality-stats")
    model = fit(stats, labels)
    if model is None:
        return docs

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        if not len(texts):
            return pd.Series([], dtype=float)
        return pd.Series(model.score(np.array([statistics(t) for t in texts])))

    return docs.where(score(F.col(text_col)) >= threshold)
