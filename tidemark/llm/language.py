"""Language of texts by sparse multinomial logistic regression on TF-IDF of character n-grams.

A text is reduced to its letters in lower case, with one blank for whatever stands between; its runs of one to four
characters are hashed to buckets and counted over the whole text, slice by slice. Counts are damped by a logarithm, weighted by
the inverse document frequency over all documents that may be learnt from, and scaled to length one. The weights of the languages
are trained online by follow-the-regularised-leader with an elastic net: the absolute penalty leaves most weights zero. A part
of the sample is kept back, and the temperature that fits its labels best scales the logits to shares.

The document frequencies come from all texts that may be learnt from. The weights are fitted on the driver, row by row, to a
sample of at most ``rows`` texts (one at least for each language), an equal number of each language, chosen by hash; rows are
fetched partition by partition in each pass. All documents are scored in tasks.

Defined results: a null text and one without a letter are ``und`` with score 0, and so is every text if no language can be
learnt. With one language every other text has it, with score 1. Equal scores go to the first language in order. An id that is
repeated with one language counts once in the sample. Rows of a null language teach nothing. Repeated rows get equal
results. Columns that are not named stay, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_fold, query, ready, table
from tidemark.session import cut_lineage

BUCKETS = 1 << 16
ORDERS = 4
#: Characters that are hashed at once.
SLICE = 1 << 17
UNKNOWN = "und"

SAMPLE_ROWS = 6_000
EPOCHS = 3
#: Step size and its damping, absolute and squared penalty.
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.05, 0.05
#: One in so many rows of the sample fits the temperature.
CALIBRATION = 5


# --- texts to numbers --------------------------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(code).isalpha() for code in range(0x110000)])


def letters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased letters, each run of others one blank, a blank at both ends; empty without letters."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype="<u4")
    is_letter = _letters()[codes]
    if not is_letter.any():
        return np.zeros(0, dtype=np.uint32)
    kept = np.zeros(len(codes) + 2, dtype=np.uint32)
    kept[1:-1] = np.where(is_letter, codes, 32)
    kept[0] = kept[-1] = 32
    blank = kept == 32
    return kept[np.append(True, ~(blank[1:] & blank[:-1]))]


def hashes(codes: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of all runs of all orders, slice by slice."""
    for first in range(0, len(codes), SLICE):
        part = codes[first : first + SLICE + ORDERS - 1]
        state, found = np.full(len(part), 0x811C9DC5, dtype=np.uint32), []
        for order in range(1, ORDERS + 1):
            # Runs that start in this slice.
            n = min(SLICE, len(part) - order + 1)
            if n <= 0:
                break
            state = (state[:n] ^ part[order - 1 : order - 1 + n]) * np.uint32(0x01000193)
            mixed = (state ^ (state >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            found.append((mixed ^ (mixed >> np.uint32(12))) & np.uint32(BUCKETS - 1))
        yield np.concatenate(found)


def counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a whole text and how often each occurs; none if it has no letter."""
    total = None
    for found in hashes(letters(text)):
        times = np.bincount(found, minlength=BUCKETS)
        total = times if total is None else total + times
    if total is None:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    held = np.flatnonzero(total)
    return held, total[held]


def weigh(held: np.ndarray, times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF of length one."""
    x = np.log1p(times) * idf[held]
    return x / max(float(np.sqrt(x @ x)), 1e-12)


# --- the model ---------------------------------------------------------------------------------------------------


class Leader:
    """Follow-the-regularised-leader for several classes: weights follow from the sums of gradients and of their squares."""

    def __init__(self, features: int, classes: int):
        self.z = np.zeros((features, classes))
        self.n = np.zeros((features, classes))

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        free = np.abs(z) > L1
        return np.where(free, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def learn(self, held: np.ndarray, x: np.ndarray, label: int) -> None:
        weights = self.weights(held)
        error = shares(x @ weights)
        error[label] -= 1.0
        slope = np.outer(x, error)
        n = self.n[held]
        grown = n + slope * slope
        self.z[held] += slope - (np.sqrt(grown) - np.sqrt(n)) / ALPHA * weights
        self.n[held] = grown


def shares(logits: np.ndarray) -> np.ndarray:
    found = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return found / found.sum(axis=-1, keepdims=True)


def loss(logits: np.ndarray, labels: np.ndarray, temperature: float) -> float:
    """Mean negative log likelihood of the labels, one in all but one of them taken to be of any language: without an error
    among few rows the shares would go to one."""
    scaled = logits / temperature
    top = scaled.max(axis=1)
    total = top + np.log(np.exp(scaled - top[:, None]).sum(axis=1))
    doubt = 1 / (1 + len(labels))
    right = (1 - doubt) * scaled[np.arange(len(labels)), labels] + doubt * scaled.mean(axis=1)
    return float((total - right).mean())


def fit_temperature(logits: np.ndarray, labels: np.ndarray, low: float = 0.02, high: float = 20.0) -> float:
    """The temperature of least loss, by golden section on its logarithm; 1 without rows."""
    if not len(labels):
        return 1.0
    a, b, golden = np.log(low), np.log(high), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        c, d = b - golden * (b - a), a + golden * (b - a)
        if loss(logits, labels, float(np.exp(c))) <= loss(logits, labels, float(np.exp(d))):
            b = d
        else:
            a = c
    return float(np.exp((a + b) / 2))


@dataclass
class Model:
    """Languages in order, weights of the buckets that have any, document frequencies as weights, and the temperature."""

    languages: list[str] = field(default_factory=list)
    idf: np.ndarray = field(default_factory=lambda: np.ones(BUCKETS, dtype=np.float32))
    used: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.int64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), dtype=np.float32))
    temperature: float = 1.0

    def __post_init__(self) -> None:
        self.row = np.full(BUCKETS, -1, dtype=np.int64)
        self.row[self.used] = np.arange(len(self.used))

    def logits(self, held: np.ndarray, times: np.ndarray) -> np.ndarray:
        x, row = weigh(held, times, self.idf), self.row[held]
        return x[row >= 0] @ self.weights[row[row >= 0]]

    def predict(self, text: str | None) -> tuple[str, float]:
        held, times = counts(text)
        if not len(held) or not self.languages:
            return UNKNOWN, 0.0
        found = shares(self.logits(held, times) / self.temperature)
        best = int(np.argmax(found))
        return self.languages[best], float(found[best])


def document_frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """The number of texts with letters, and of those that hold each bucket, over all rows. Texts are the first column."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                held, _ = counts(text.as_py())
                total[held] += 1
                n += len(held) > 0
        if n:
            held = np.flatnonzero(total)
            arrays = [pa.array(np.append(held, -1)), pa.array(np.append(total[held], n))]
            yield pa.RecordBatch.from_arrays(arrays, ["bucket", "texts"])

    found = texts.mapInArrow(count, "bucket long, texts long").groupBy("bucket").agg(F.sum("texts").alias("texts"))
    total = np.zeros(BUCKETS + 1, dtype=np.int64)
    for row in found.collect():
        total[row["bucket"]] = row["texts"]
    return int(total[-1]), total[:-1]


def sample(documents: DataFrame, rows: int) -> tuple[list[str], DataFrame]:
    """The languages in order, and (language, text, part) of an equal number of texts of each. One text for each id.

    A hash of the id keeps about one and a half times as many as wanted before anything is ordered, so a language that
    holds most documents is no large group.
    """
    key = F.xxhash64("doc_id", "lang")
    ids = documents.groupBy("lang").agg(F.approx_count_distinct(F.coalesce(key, F.lit(0))).alias("ids")).collect()
    sizes = {row["lang"]: row["ids"] for row in ids}
    languages = sorted(sizes)
    if not languages:
        return [], documents.select("lang", "text", F.lit(0).alias("part")).where(F.lit(False))
    each = max(1, rows // len(languages))
    bounds = documents.sparkSession.createDataFrame(
        [(name, k, min(1.0, 1.5 * (each + 20) / max(1, sizes[name]))) for k, name in enumerate(languages)],
        "lang string, language int, bound double",
    )
    # Written, so that Spark knows its size and need not shuffle the texts for it.
    bounds = cut_lineage(bounds)
    place = F.pmod(key, F.lit(1 << 30)) / F.lit(float(1 << 30))
    near = documents.join(bounds, "lang").where(place < F.col("bound"))
    near = near.groupBy("language", "doc_id", place.alias("place")).agg(F.max(F.coalesce("text", F.lit(""))).alias("text"))
    rank = F.row_number().over(Window.partitionBy("language").orderBy("place", "doc_id"))
    near = near.withColumn("rank", rank).where(F.col("rank") <= each)
    return languages, near.select("language", "text", F.pmod("rank", F.lit(CALIBRATION)).alias("part"), "place")


def train(documents: DataFrame, rows: int = SAMPLE_ROWS, epochs: int = EPOCHS) -> Model:
    """Fit to ``documents`` (doc_id, lang, text); rows of a null language are left out."""
    ready(documents.sparkSession)
    documents = documents.select("doc_id", F.col("lang").cast("string").alias("lang"), "text").where(F.col("lang").isNotNull())
    n, held_by = document_frequencies(documents.select("text"))
    idf = (np.log((1 + n) / (1 + held_by)) + 1).astype(np.float32)
    languages, chosen = sample(documents, rows)
    if not languages:
        return Model()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts(text) for text in batch.column(1).to_pylist()]
            x = [weigh(held, times, idf).astype("<f4").tobytes() for held, times in found]
            held = [held.astype("<u4").tobytes() for held, _ in found]
            arrays = [batch.column(0), batch.column(2), batch.column(3), pa.array(held, pa.binary()), pa.array(x, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["language", "part", "place", "held", "x"])

    # Learnt from in an order that has nothing to do with the language.
    measured = chosen.mapInArrow(measure, "language int, part int, place double, held binary, x binary")
    measured = cut_lineage(measured.where(F.length("held") > 0).repartition(8, "place").sortWithinPartitions("place", "language"))
    leader = Leader(BUCKETS, len(languages))
    for _ in range(epochs):
        for row in measured.where(F.col("part") != 0).toLocalIterator():
            leader.learn(np.frombuffer(row["held"], "<u4"), np.frombuffer(row["x"], "<f4"), row["language"])
    weights = leader.weights(slice(None))
    logits, labels = [], []
    for row in measured.where(F.col("part") == 0).toLocalIterator():
        logits.append(np.frombuffer(row["x"], "<f4") @ weights[np.frombuffer(row["held"], "<u4")])
        labels.append(row["language"])
    temperature = fit_temperature(np.array(logits).reshape(-1, len(languages)), np.array(labels, dtype=int))
    used = np.flatnonzero((weights != 0).any(axis=1))
    return Model(languages, idf, used, weights[used].astype(np.float32), temperature)


def identify(rows: DataFrame, text: str, model: Model, lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """The rows with the language of each whole text and the share the model gives it."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    columns = [*rows.columns, lang_pred, score]
    at = columns.index(text)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(text.as_py()) for text in batch.column(at)]
            new = [pa.array([name for name, _ in found], pa.string()), pa.array([share for _, share in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], columns)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(predict, f"{schema}, `{lang_pred}` string, `{score}` double")


# --- query -------------------------------------------------------------------------------------------------------

#: Documents whose id is in this fold are never learnt from.
PARTS, HELD_OUT = 4, 2


def may_learn() -> Column:
    return ~in_fold("doc_id", PARTS, HELD_OUT)


@query("op12_language")
def op12_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = train(documents.where(may_learn()))
    rows = documents.select("doc_id", in_fold("doc_id", PARTS, HELD_OUT).alias("held_out"), "text")
    return identify(rows, "text", model).drop("text")
