"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Letters (lower case, any other character counts as a space) give n-grams of 1 to ``longest`` characters, hashed into
``2 ** bits`` features. Document frequencies come from every training text. The weights are fitted by
follow-the-regularised-leader with an elastic net on a bounded sample (``per_label`` texts of each label,
chosen by a hash of their id), and a temperature is fitted on the part of the sample kept out of the training.

Defined results: null texts and texts without letters are ``und`` with score 0, as is every text where
nothing could be learned (no labels, an empty table).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    bits: int = 16
    longest: int = 3
    per_label: int = 500
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.01
    l2: float = 0.0001


@dataclass(frozen=True)
class Model:
    labels: list[str]
    weights: np.ndarray  # features x labels
    bias: np.ndarray
    idf: np.ndarray
    temperature: float


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


def features(text: str, settings: Settings) -> np.ndarray:
    """Feature number of every n-gram of the text; empty without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[points]
    if not letter.any():
        return np.empty(0, np.int64)
    letters = np.where(letter, points, 32).astype(np.uint64)
    blank = ~letter
    keep = np.ones(len(letters), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    letters = np.concatenate([[np.uint64(32)], letters[keep], [np.uint64(32)]])
    out, code = [], letters
    for size in range(1, settings.longest + 1):
        if size > 1:
            code = code[:-1] * np.uint64(0x100000001B3) + letters[size - 1 :]
        mixed = (code + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)
        out.append((mixed >> np.uint64(64 - settings.bits)).astype(np.int64))
    return np.concatenate(out)


def vector(text: str, idf: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Features and TF-IDF values of unit length."""
    found = features(text, settings)
    if not len(found):
        return found, np.empty(0)
    counts = np.bincount(found, minlength=len(idf))
    at = np.flatnonzero(counts)
    values = (1 + np.log(counts[at])) * idf[at]
    return at, values / max(np.sqrt((values * values).sum()), 1e-12)


def _frequencies(texts: DataFrame, settings: Settings) -> tuple[np.ndarray, int]:
    """Number of texts that have each feature, and of texts, over all rows."""
    width = 2**settings.bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(width + 1, np.int64)
        for batch in batches:
            for value in batch.column(0):
                seen[:width][np.unique(features(value.as_py(), settings))] += 1
            seen[width] += batch.num_rows
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(seen[at])], names=["feature", "n"])

    rows = texts.mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(width + 1, np.int64)
    for row in rows:
        found[row.feature] = row.n
    return found[:width], int(found[width])


def softmax(scores: np.ndarray) -> np.ndarray:
    raised = np.exp(scores - scores.max(-1, keepdims=True))
    return raised / raised.sum(-1, keepdims=True)


def fit_ftrl(rows: list, labels: int, width: int, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias; ``rows``: (features, values, label number)."""
    z = np.zeros((width + 1, labels))
    n = np.zeros((width + 1, labels))
    order = np.random.default_rng(7)

    def weights(at: np.ndarray) -> np.ndarray:
        held, size = z[at], (settings.beta + np.sqrt(n[at])) / settings.alpha + settings.l2
        return np.where(np.abs(held) <= settings.l1, 0.0, -(held - np.sign(held) * settings.l1) / size)

    for _ in range(settings.epochs):
        for i in order.permutation(len(rows)):
            at, values, label = rows[i]
            at, values = np.append(at, width), np.append(values, 1.0)
            w = weights(at)
            error = softmax(values @ w)
            error[label] -= 1
            g = values[:, None] * error
            old = n[at]
            z[at] += g - (np.sqrt(old + g * g) - np.sqrt(old)) / settings.alpha * w
            n[at] = old + g * g
    final = weights(np.arange(width + 1))
    return final[:width], final[width]


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the smallest log loss, over a fine grid."""
    if not len(labels):
        return 1.0
    grid = np.exp(np.linspace(np.log(0.05), np.log(10), 200))
    own = np.arange(len(labels))
    loss = [-np.log(np.maximum(softmax(scores / t)[own, labels], 1e-300)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


def fit(docs: DataFrame, id_col: str, text_col: str, label_col: str, settings: Settings = Settings()) -> Model:
    """Learn from the rows of ``docs`` that have a text and a label."""
    known = docs.select(
        F.col(text_col).alias("text"), F.col(label_col).alias("label"), F.xxhash64(F.col(id_col)).alias("draw")
    ).filter("text IS NOT NULL AND label IS NOT NULL")
    seen, total = _frequencies(known.select("text"), settings)
    idf = np.log((1 + total) / (1 + seen)) + 1
    # a label's texts are thinned out by their draw first, so that few more than needed are sorted
    sizes = known.groupBy("label").count()
    share = F.least(F.lit(1.0), F.lit(4.0 * settings.per_label) / F.col("count"))
    drawn = F.pmod(F.col("draw"), F.lit(1_000_000)) < share * 1_000_000
    known = known.join(sizes, "label").filter(drawn)
    window = Window.partitionBy("label").orderBy("draw", F.xxhash64("text"))
    sample = known.withColumn("n", F.row_number().over(window)).filter(F.col("n") <= settings.per_label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [vector(value.as_py(), idf, settings) for value in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(1),
                    batch.column(2),
                    pa.array([at.astype(np.int32) for at, _ in vectors], pa.list_(pa.int32())),
                    pa.array([values.astype(np.float32) for _, values in vectors], pa.list_(pa.float32())),
                ],
                names=["label", "n", "at", "values"],
            )

    table = sample.select("text", "label", "n").mapInArrow(
        run, "label string, n int, at array<int>, values array<float>"
    ).toArrow()
    labels = sorted(set(table.column("label").to_pylist()))
    rows = [
        (np.array(at, np.int64), np.array(values, np.float64), labels.index(label), n)
        for label, n, at, values in zip(*(table.column(i).to_pylist() for i in range(4)))
        if at
    ]
    rows.sort(key=lambda row: (row[3], row[2]))
    train = [row[:3] for row in rows if row[3] % 5]
    weights, bias = fit_ftrl(train, len(labels), len(idf), settings)
    checked = [row for row in rows if row[3] % 5 == 0]
    scores = np.array([row[1] @ weights[row[0]] + bias for row in checked]).reshape(len(checked), len(labels))
    return Model(labels, weights, bias, idf, fit_temperature(scores, np.array([row[2] for row in checked], int)))


def language(text: str | Column, model: Model, settings: Settings = Settings()) -> Column:
    """A struct of the most likely label and its calibrated probability."""

    @F.arrow_udf("lang_pred string, score double")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            names, scores = [], []
            for value in batch:
                at, values = vector(value.as_py() or "", model.idf, settings)
                if not len(at) or not model.labels:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                chance = softmax((values @ model.weights[at] + model.bias) / model.temperature)
                best = int(chance.argmax())
                names.append(model.labels[best])
                scores.append(float(chance[best]))
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
            )

    return predict.asNondeterministic()(F.col(text) if isinstance(text, str) else text)
