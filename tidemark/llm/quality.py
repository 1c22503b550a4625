"""Text quality by a generalised additive model with pairwise interactions.

Every whole text gives a row of numbers (shares of kinds of characters, repetition, compressibility and so on). The
numbers are binned. Shallow trees, boosted in turn over the numbers, add up to one lookup table for each number; then
over the pairs of numbers that explain most of what is left, to one table for each pair. A score is a sum of looked-up
values, for a batch of texts at a time.

The model is fitted on the driver to the numbers (not the texts) of a bounded sample of labelled documents; all documents
are scored in tasks. Defined results: a null or empty text is a text of no words and has a score too. Without labelled
rows, or with one label only, every text gets the smoothed share of that label. Repeated rows get equal scores, and
texts are read whole, whatever their length; of equally good cuts the first is taken. Other columns are not looked at.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tidemark.llm.common import in_fold, labelled_sample, query, table

BINS, COARSE = 32, 8
ROUNDS, PAIR_ROUNDS, PAIRS = 60, 30, 6
RATE, RIDGE = 0.15, 1.0
NAMES = (
    "bytes", "words", "upper", "digits", "symbols", "marks", "bars", "stops", "spaces", "lines", "other_letters",
    "word_length", "short_words", "different_words", "twice_in_a_row", "different_lines", "compressed",
)
SYMBOLS = np.frombuffer(b"#$%&*<>{}[]\\^~@=+_`", dtype=np.uint8)


def numbers(text: str | None) -> list[float]:
    """What the model knows of a text, in the order of ``NAMES``."""
    raw = (text or "").encode("utf-8", "replace")
    count = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    n = max(1, len(raw))
    words = (text or "").split()
    n_words = max(1, len(words))
    lines = (text or "").split("\n")
    return [
        np.log1p(len(raw)),
        np.log1p(len(words)),
        count[65:91].sum() / n,
        count[48:58].sum() / n,
        count[SYMBOLS].sum() / n,
        (count[33] + count[63]) / n,
        count[124] / n,
        (count[44] + count[46]) / n,
        count[32] / n,
        len(lines) / n_words,
        count[128:].sum() / n,
        (n - count[32] - count[10]) / n_words,
        sum(len(word) <= 3 for word in words) / n_words,
        len(set(words)) / n_words,
        sum(map(operator.eq, words, words[1:])) / n_words,
        len(set(lines)) / len(lines),
        len(zlib.compress(raw, 1)) / n,
    ]


@dataclass
class Model:
    """A constant, the inner edges of the bins of each number, fine ones and coarse ones for pairs, and the tables of numbers
    and of pairs of numbers."""

    bias: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    coarse_edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def logits(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.bias)
        for own, values in zip(placed(rows, self.edges).T, self.tables):
            total += values[own]
        small = placed(rows, self.coarse_edges)
        for (a, b), values in zip(self.pairs, self.pair_tables):
            total += values[small[:, a], small[:, b]]
        return total

    def score(self, rows: np.ndarray) -> np.ndarray:
        logits = self.logits(rows) if self.edges else np.full(len(rows), self.bias)
        return 1 / (1 + np.exp(-np.clip(logits, -30, 30)))


def inner_edges(values: np.ndarray, bins: int) -> np.ndarray:
    """Between the bins that hold about equal numbers of values; each value of a number with few of them has its own."""
    different = np.unique(values)
    if len(different) <= bins:
        return (different[1:] + different[:-1]) / 2
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def placed(rows: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The bin of each number."""
    return np.stack([np.searchsorted(own, rows[:, k], side="right") for k, own in enumerate(edges)], axis=1)


def _gain(slope: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return slope**2 / (weight + RIDGE)


def _cut(slope: np.ndarray, weight: np.ndarray) -> tuple[int, float]:
    """Where to cut a row of bins in two, and what that gains."""
    left, left_weight = np.cumsum(slope)[:-1], np.cumsum(weight)[:-1]
    if not len(left):
        return 0, 0.0
    gains = _gain(left, left_weight) + _gain(slope.sum() - left, weight.sum() - left_weight)
    best = int(np.argmax(gains))
    return best + 1, float(gains[best] - _gain(slope.sum(), weight.sum()))


def tree(slope: np.ndarray, weight: np.ndarray, depth: int = 2) -> np.ndarray:
    """The values of a shallow tree over a row of bins."""
    at, gain = _cut(slope, weight) if depth else (0, 0.0)
    if gain <= 0:
        return np.full(len(slope), slope.sum() / (weight.sum() + RIDGE))
    return np.concatenate([tree(slope[:at], weight[:at], depth - 1), tree(slope[at:], weight[at:], depth - 1)])


def pair_tree(slope: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """A tree over a grid of bins: one cut across, then one along in each half, or the other way round."""
    options = []
    for turn in (False, True):
        s, w = (slope.T, weight.T) if turn else (slope, weight)
        at, _ = _cut(s.sum(axis=1), w.sum(axis=1))
        values = np.empty(s.shape)
        for half in (slice(0, at), slice(at, None)):
            if s[half].size:
                values[half] = tree(s[half].sum(axis=0), w[half].sum(axis=0), 1)
        options.append((float((values * s - 0.5 * values**2 * w).sum()), values.T if turn else values))
    return max(options, key=lambda option: option[0])[1]


def fit(rows: np.ndarray, labels: np.ndarray) -> Model:
    """Cyclic boosting on the rows of a sample."""
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    model = Model(bias=float(np.log(share / (1 - share))))
    if len(labels) == 0 or len(np.unique(labels)) < 2:
        return model
    model.edges = [inner_edges(column, BINS) for column in rows.T]
    model.coarse_edges = [inner_edges(column, COARSE) for column in rows.T]
    model.tables = [np.zeros(BINS) for _ in model.edges]
    bins, small = placed(rows, model.edges), placed(rows, model.coarse_edges)
    logits = model.logits(rows)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
        return labels - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k in range(len(model.edges)):
            slope, weight = slopes()
            own = bins[:, k]
            step = RATE * tree(np.bincount(own, slope, BINS), np.bincount(own, weight, BINS))
            model.tables[k] += step
            logits += step[own]
    slope, weight = slopes()

    def grid(a: int, b: int, values: np.ndarray) -> np.ndarray:
        return np.bincount(small[:, a] * COARSE + small[:, b], values, COARSE * COARSE).reshape(COARSE, COARSE)

    left = {pair: _gain(grid(*pair, slope), grid(*pair, weight)).sum() for pair in combinations(range(rows.shape[1]), 2)}
    model.pairs = sorted(left, key=left.get, reverse=True)[:PAIRS]
    model.pair_tables = [np.zeros((COARSE, COARSE)) for _ in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(model.pairs):
            slope, weight = slopes()
            step = RATE * pair_tree(grid(a, b, slope), grid(a, b, weight))
            model.pair_tables[k] += step
            logits += step[small[:, a], small[:, b]]
    return model


def train(documents: DataFrame, labels: DataFrame, keep: Column, rows: int = 20_000) -> Model:
    """Fit to at most ``rows`` labelled documents that ``keep`` lets through."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array([numbers(text) for text in batch.column(0).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([values, batch.column(1)], ["x", "label"])

    sample = labelled_sample(documents, labels, "quality", rows, keep).select("text", "label")
    found = sample.mapInArrow(measure, "x array<double>, label int").collect()
    x = np.array([row["x"] for row in found], dtype=float).reshape(-1, len(NAMES))
    return fit(x, np.array([row["label"] for row in found], dtype=float))


def score_column(spark: SparkSession, model: Model, text: Column | str) -> Column:
    """The score of a text, from 0 to 1."""
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = np.array([numbers(text) for text in texts.to_pylist()], dtype=float).reshape(-1, len(NAMES))
            yield pa.array(shared.value.score(rows), pa.float64())

    score.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(score, "double").asNondeterministic()(text)


#: Labels of ids in this fold are never learnt from.
PARTS, HELD_OUT = 3, 1


@query("op9_quality")
def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = train(documents, table(spark, folder, "labels"), ~in_fold("doc_id", PARTS, HELD_OUT))
    scored = documents.select(
        "doc_id",
        in_fold("doc_id", PARTS, HELD_OUT).alias("held_out"),
        score_column(spark, model, documents["text"]).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
