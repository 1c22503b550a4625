"""Toxicity by a noisy channel: obfuscated words are restored first, then the restored words are scored.

Words that show signs of obfuscation (characters that stand for letters, stretched letters, separators, letters set
apart by spaces) become lattices of possible readings. A Viterbi search finds the likeliest reading under a character
language model, whose counts are taken from all documents. A lexicon learnt from labelled documents weighs words and
their beginnings; a logistic curve turns the weights found in a document into a score.

Defined results: a null or empty text has no words and gets the score of a text without weighted words. Without
labelled rows, or with one label only, every text gets the (smoothed) share of that label. Repeated rows get equal scores; of
equally likely readings the first found counts.
Texts, words and runs of letters set apart are read whole, whatever their length.
Other columns of the table are not looked at, and stay.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tidemark.llm.common import in_fold, labelled_sample, query, ready, table

#: Codes of the language model: 0 between words, 1 to 26 letters without accents, 27 any other letter.
OTHER = 27
BITS = 5
CACHE = 300_000

# Letters that a character may stand for.
STANDS_FOR = {
    "0": "o",
    "1": "il",
    "3": "e",
    "4": "a",
    "5": "s",
    "6": "g",
    "7": "t",
    "8": "b",
    "9": "g",
    "@": "a",
    "$": "s",
    "!": "i",
    "|": "il",
    "+": "t",
    "*": "aeiou",
}
EDGES = "\"'`´.,:;?!()[]{}<>«»¿¡*#%&=~^/\\|-_+…“”„‘’"
#: Edges that stand for no letter.
BARE_EDGES = "".join(mark for mark in EDGES if mark not in STANDS_FOR)
MARKS = re.escape("0123456789@$!|+*._-")
SUSPECT = re.compile(rf"[a-z].*[{MARKS}]|[{MARKS}].*[a-z]|([a-z])\1\1", re.DOTALL)
SPACED = re.compile(r"(?<!\S)[a-z0-9@$!|](?:[\s.\-_*]{1,3}[a-z0-9@$!|]){2,}(?![^\s.,!?;:])")
RUNS = re.compile(r"(.)\1*", re.DOTALL)

# Costs of the channel, as logarithms.
MAPPED, DOUBLED, DROPPED, SEPARATOR, BROKEN, SHRUNK, STRETCHED = -1.0, -1.5, -3.0, -1.0, -2.0, -1.0, -0.7


def _base(character: str) -> str:
    plain = unicodedata.normalize("NFKD", character.lower())[:1]
    return {"ß": "s", "æ": "a", "œ": "o", "ø": "o", "ð": "d", "þ": "t", "ł": "l"}.get(plain, plain)


FOLD = {code: base for code in range(0xC0, 0x250) if (base := _base(chr(code))).isascii() and base}


def fold_text(text: str) -> str:
    """Lower case, without accents."""
    text = text.lower()
    return text if text.isascii() else text.translate(FOLD)


def code_of(character: str) -> int:
    base = _base(character)
    if "a" <= base <= "z":
        return ord(base) - 96
    return OTHER if character.isalpha() else 0


_CODES: list[np.ndarray] = []


def codes() -> np.ndarray:
    """Code of every character of the basic plane."""
    if not _CODES:
        found = np.zeros(65536, dtype=np.uint8)
        for number in range(65536):
            if not 0xD800 <= number <= 0xDFFF:
                found[number] = code_of(chr(number))
        _CODES.append(found)
    return _CODES[0]


def count_ngrams(texts: list[str]) -> np.ndarray:
    """How often each run of four codes occurs. What lies before the start of the current word counts as no letter."""
    joined = "\n\n\n\n".join(["", *texts, ""])
    letters = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    x = codes()[np.minimum(letters, 65535)].astype(np.int32)
    c, d = x[2:-1], x[3:]
    b = np.where(c == 0, 0, x[1:-2])
    a = np.where(b == 0, 0, x[:-3])
    grams = ((a << 3 * BITS) | (b << 2 * BITS) | (c << BITS) | d)[(c > 0) | (d > 0)]
    return np.bincount(grams, minlength=1 << 4 * BITS)


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 4 * BITS, dtype=np.int64)
    for batch in batches:
        total += count_ngrams([text or "" for text in batch.column(0).to_pylist()])
    grams = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(grams, pa.int32()), pa.array(total[grams], pa.int64())], ["gram", "n"])


def language_model(documents: DataFrame) -> np.ndarray:
    """Log probability of a code after three others, from the texts of all documents.

    Tasks count on their own and Spark adds up. The number of counts is bounded by the alphabet (28 ** 4), not by the
    corpus, so the sums may be taken to the driver.
    """
    counted = documents.select("text").mapInArrow(_count_task, "gram int, n long")
    sums = counted.groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(1 << 4 * BITS)
    counts[sums["gram"].to_numpy(dtype=np.int64)] = sums["n"].to_numpy(dtype=np.float64)
    size = 1 << BITS
    counts = counts.reshape(size, size, size, size)
    # Each order is smoothed with the next lower one (Witten and Bell).
    probability = np.full(size, 1.0 / (OTHER + 1))
    for order in range(4):
        seen = counts.sum(axis=tuple(range(3 - order)))
        total = seen.sum(axis=-1, keepdims=True)
        kinds = (seen > 0).sum(axis=-1, keepdims=True) + 1.0
        probability = (seen + kinds * probability) / (total + kinds)
    return np.log(probability).astype(np.float32)


def lattice(word: str, apart: bool = False) -> list[list[tuple[tuple[tuple[int, str], ...], float]]]:
    """The readings of each run of equal characters: (letters, cost). ``apart``: letters stand apart, so white space may
    join or part them."""
    slots = []
    for match in RUNS.finditer(word):
        character, n = match[1], len(match[0])
        code = code_of(character)
        if character.isspace():
            slots.append([((), -0.3), (((0, " "),), BROKEN)])
        elif code:
            one = (code, character)
            if n < 3:
                slots.append([((one,) * n, 0.0)])
            else:
                slots.append([((one,), SHRUNK), ((one, one), DOUBLED), ((one,) * min(n, 8), STRETCHED * n)])
        else:
            readings = [((), SEPARATOR if character in "._-*" else DROPPED), (((0, " "),), BROKEN)]
            if apart:
                readings = readings[:1]
            for letter in STANDS_FOR.get(character, ""):
                one = (ord(letter) - 96, letter)
                readings.append(((one,), MAPPED if n == 1 else DOUBLED))
                if n > 1:
                    readings.append(((one, one), DOUBLED))
            slots.append(readings)
    return slots


def restore(word: str, model: np.ndarray, apart: bool = False) -> str:
    """The likeliest reading of a word; several words if separators part it.

    A state is the last three letters, so there are as many as the readings of the last three runs allow, and the work grows with
    the length of the word.
    """
    states: dict[tuple[int, int, int], tuple[float, tuple | None]] = {(0, 0, 0): (0.0, None)}
    for slot in lattice(word, apart):
        reached: dict[tuple[int, int, int], tuple[float, tuple | None]] = {}
        for state, (score, back) in states.items():
            for letters, cost in slot:
                (a, b, c), total, trail = state, score + cost, back
                for code, letter in letters:
                    if code or c:
                        total += model[a, b, c, code]
                    a, b, c = (0, 0, 0) if code == 0 else (b, c, code)
                    trail = (trail, letter)
                if (old := reached.get((a, b, c))) is None or total > old[0]:
                    reached[a, b, c] = (total, trail)
        states = reached
    _, trail = max(
        ((score + (model[(*state, 0)] if state[2] else 0.0), back) for state, (score, back) in states.items()),
        key=lambda item: item[0],
    )
    letters = []
    while trail is not None:
        trail, letter = trail
        letters.append(letter)
    return "".join(reversed(letters))


def strip_edges(word: str) -> str:
    word = word.strip(EDGES)
    if word[-2:] in ("$$", "@@") or word[:2] in ("$$", "@@"):
        word = word.strip("$@" + EDGES)
    return word


def readings(word: str, model: np.ndarray) -> list[str]:
    """A word as it stands, and the words of its restored forms, also with the marks at its edges that may be letters."""
    core = strip_edges(word)
    found = [core]
    whole = word.strip(BARE_EDGES)
    for form in (core, whole) if whole != core else (core,):
        if SUSPECT.search(form):
            found += restore(form, model).split()
    return found


def spaced_words(text: str, model: np.ndarray) -> list[str]:
    """Words whose letters stand apart."""
    found = []
    for match in SPACED.finditer(text):
        found += restore(re.sub(r"\s+", " ", match[0]), model, apart=True).split()
    return found


def traits(word: str) -> list[str]:
    """What is learnt about a word: itself and its beginnings."""
    return [f"={word}", *(f"^{word[:n]}" for n in (4, 5, 6) if len(word) >= n)] if word else []


@dataclass
class Model:
    """Language model, weights of traits, and the curve over (largest weight, next two, number of weighted words)."""

    language: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    curve: tuple[float, float, float, float] = (0.0, 0.0, 0.0, 0.0)

    def parts(self) -> tuple:
        return self.language, self.weights, self.curve


class Reader:
    """Scores texts in a task. Weights of words are remembered, up to ``CACHE`` words."""

    def __init__(self, model: Model):
        self.model, self.known = model, {}

    def weight(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            weights = self.model.weights
            found = max(
                (weights.get(trait, 0.0) for form in readings(word, self.model.language) for trait in traits(form)),
                default=0.0,
            )
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[word] = found
        return found

    def evidence(self, text: str | None) -> tuple[float, float, float]:
        folded = fold_text(text or "")
        words = set(folded.split())
        words.update(spaced_words(folded, self.model.language))
        found = sorted((weight for word in words if (weight := self.weight(word)) > 0), reverse=True)
        return (found[0] if found else 0.0, sum(found[1:3]), math.log1p(sum(weight >= 2 for weight in found)))

    def score(self, text: str | None) -> float:
        bias, *slopes = self.model.curve
        logit = bias + sum(slope * value for slope, value in zip(slopes, self.evidence(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))


def fit_curve(values: np.ndarray, labels: np.ndarray, ridge: float = 0.1) -> tuple[float, ...]:
    """Logistic regression by Newton's method."""
    x = np.column_stack([np.ones(len(labels)), values]) if len(labels) else np.ones((0, values.shape[1] + 1))
    share = (labels.sum() + 0.5) / (len(labels) + 1.0) if len(labels) else 0.01
    beta = np.zeros(x.shape[1])
    beta[0] = math.log(share / (1 - share))
    if len(set(labels.tolist())) < 2:
        return tuple(beta)
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + penalty, x.T @ (labels - p) - penalty @ beta)
        beta = beta + np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-6:
            break
    return tuple(float(value) for value in beta)


def train(spark: SparkSession, documents: DataFrame, labels: DataFrame, keep: Column, rows: int = 20_000) -> Model:
    """Learn from at most ``rows`` labelled documents that ``keep`` lets through; the language model from all documents.

    Three quarters of the labelled documents give the weights of traits (log odds of being toxic, drawn towards none where
    a trait is rare), the rest the curve.
    """
    ready(spark)
    model = Model(language_model(documents))
    sample = labelled_sample(documents, labels, "toxic", rows, keep)
    part = F.pmod(F.xxhash64("doc_id"), F.lit(4))
    totals = sample.where(part != 0).agg(F.count("*").alias("n"), F.sum("label").alias("toxic")).first()
    shared = spark.sparkContext.broadcast(model.language)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, set[str]] = {}
        n, toxic = Counter(), Counter()
        language = shared.value
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                folded = fold_text(text)
                found: set[str] = set()
                for word in [*set(folded.split()), *spaced_words(folded, language)]:
                    if (own := known.get(word)) is None:
                        if len(known) >= CACHE // 4:
                            known.clear()
                        own = known[word] = {trait for form in readings(word, language) for trait in traits(form)}
                    found |= own
                n.update(found)
                if label:
                    toxic.update(found)
            if len(n) > CACHE:
                yield _trait_batch(n, toxic)
                n, toxic = Counter(), Counter()
        yield _trait_batch(n, toxic)

    if totals["n"] and totals["toxic"] and totals["toxic"] < totals["n"]:
        counted = sample.where(part != 0).select("text", "label").mapInArrow(count, "trait string, n long, toxic long")
        counted = counted.groupBy("trait").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
        base, prior = totals["toxic"] / totals["n"], 8.0
        share = (F.col("toxic") + prior * base) / (F.col("n") + prior)
        weight = F.log(share / (1 - share)) - math.log(base / (1 - base))
        # A trait needs three toxic documents of the bounded sample, which bounds the lexicon too.
        found = counted.where("toxic >= 3").select("trait", weight.alias("weight")).where("weight >= 1").collect()
        model.weights = {row["trait"]: row["weight"] for row in found}
    weighted = spark.sparkContext.broadcast(model.parts())

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(Model(*weighted.value))
        for batch in batches:
            rows = [reader.evidence(text) for text in batch.column(0).to_pylist()]
            columns = [pa.array([row[k] for row in rows], pa.float64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(1)], ["a", "b", "c", "label"])

    seen = sample.where(part == 0).select("text", "label").mapInArrow(weigh, "a double, b double, c double, label int")
    points = np.array([tuple(row) for row in seen.collect()], dtype=float).reshape(-1, 4)
    model.curve = fit_curve(points[:, :3], points[:, 3])
    return model


def _trait_batch(n: Counter, toxic: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(n), pa.string()),
            pa.array(list(n.values()), pa.int64()),
            pa.array([toxic[trait] for trait in n], pa.int64()),
        ],
        ["trait", "n", "toxic"],
    )


def score_column(spark: SparkSession, model: Model, text: Column | str) -> Column:
    """The score of a text, from 0 to 1."""
    shared = spark.sparkContext.broadcast(model.parts())

    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(Model(*shared.value))
        for texts in batches:
            yield pa.array([reader.score(text) for text in texts.to_pylist()], pa.float64())

    score.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # Marked so that a filter on the score does not compute it twice.
    return arrow_udf(score, "double").asNondeterministic()(text)


#: Labels of ids in this fold are never learnt from.
PARTS, HELD_OUT = 5, 0


def model_for(spark: SparkSession, documents: DataFrame, labels: DataFrame) -> Model:
    return train(spark, documents, labels, ~in_fold("doc_id", PARTS, HELD_OUT))


def remove_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents whose score is below one half."""
    model = model_for(spark, docs, table(spark, folder, "labels"))
    return docs.where(score_column(spark, model, docs["text"]) < 0.5)


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = model_for(spark, documents, table(spark, folder, "labels"))
    scored = documents.select(
        "doc_id",
        in_fold("doc_id", PARTS, HELD_OUT).alias("held_out"),
        score_column(spark, model, documents["text"]).alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
