"""Language identification: its parts against naive versions, the whole against held-out labels and odd tables."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import QUERIES, language
from tidemark.llm.common import ready
from tidemark.session import new_table_path

FOLDER = "/root/testdata/sf0.01"


def bucket(run):
    state = 0x811C9DC5
    for c in run:
        state = ((state ^ ord(c)) * 0x01000193) & 0xFFFFFFFF
    mixed = ((state ^ (state >> 15)) * 0x2C1B3C6D) & 0xFFFFFFFF
    return (mixed ^ (mixed >> 12)) & 0xFFFF


def plain_counts(text):
    kept = "".join(c if c.isalpha() else " " for c in text.lower())
    if not kept.strip():
        return Counter()
    kept = " " + " ".join(kept.split()) + " "
    return Counter(bucket(kept[k : k + n]) for n in range(1, 5) for k in range(len(kept) - n + 1))


@pytest.mark.parametrize("text", ["a", "Ab, c", "  Élan 12 vital!\n", "漢字かな x", "İstanbul", "ab" * 500, "12 !", "", "word " * 40])
def test_counts_of_whole_texts_in_slices(text, monkeypatch):
    for size in (1 << 17, 7, 64):
        monkeypatch.setattr(language, "SLICE", size)
        held, times = language.counts(text)
        assert dict(zip(held.tolist(), times.tolist())) == dict(plain_counts(text))


def test_leader_against_single_weights(monkeypatch):
    """Gradient by gradient and weight by weight, by the published update."""
    monkeypatch.setattr(language, "L1", 1.0)
    chance = random.Random(5)
    rows = [(sorted(chance.sample(range(12), 4)), [chance.random() for _ in range(4)], chance.randrange(3)) for _ in range(300)]
    leader = language.Leader(12, 3)
    z, n = [[0.0] * 3 for _ in range(12)], [[0.0] * 3 for _ in range(12)]

    def weight(j, k):
        if abs(z[j][k]) <= language.L1:
            return 0.0
        return -(z[j][k] - math.copysign(language.L1, z[j][k])) / ((language.BETA + math.sqrt(n[j][k])) / language.ALPHA + language.L2)

    for held, x, label in rows:
        w = {j: [weight(j, k) for k in range(3)] for j in held}
        logits = [sum(v * w[j][k] for j, v in zip(held, x)) for k in range(3)]
        e = [math.exp(v) for v in logits]
        for j, v in zip(held, x):
            for k in range(3):
                g = (e[k] / sum(e) - (k == label)) * v
                z[j][k] += g - (math.sqrt(n[j][k] + g * g) - math.sqrt(n[j][k])) / language.ALPHA * w[j][k]
                n[j][k] += g * g
        leader.learn(np.array(held), np.array(x), label)
    assert np.allclose(leader.weights(slice(None)), [[weight(j, k) for k in range(3)] for j in range(12)])
    assert (leader.weights(slice(None)) == 0).any()


def test_temperature_has_the_least_loss():
    chance = np.random.default_rng(3)
    labels = chance.integers(0, 3, 500)
    logits = chance.normal(size=(500, 3)) * 4
    logits[np.arange(500), labels] += 3
    best = language.fit_temperature(logits, labels)
    assert all(language.loss(logits, labels, best) <= language.loss(logits, labels, best * f) + 1e-9 for f in (0.5, 0.95, 1.05, 2))
    assert 0.02 < best < 20 and language.fit_temperature(np.zeros((0, 2)), np.zeros(0, dtype=int)) == 1.0


def test_document_frequencies_cover_all_rows(spark):
    texts = [None, "", "12", "ab", "ab ab", "b", "a long text of words"] * 9
    table = ready(spark).createDataFrame([(t,) for t in texts], "text string").repartition(5)
    n, found = language.document_frequencies(table)
    expected = Counter(b for t in texts for b in plain_counts(t or ""))
    assert n == 36 and {k: int(found[k]) for k in np.flatnonzero(found)} == dict(expected)


def test_sample_has_all_languages_and_one_text_an_id(spark):
    rows = [(k, "big", f"t{k}") for k in range(3000)] + [(7, "one", "same")] * 500 + [(9000 + k, "few", "t") for k in range(3)]
    rows += [(None, "none", "t"), (None, "none", None)]
    table = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)
    languages, found = language.sample(table, 400)
    assert languages == ["big", "few", "none", "one"]
    assert Counter(row["language"] for row in found.collect()) == {0: 100, 1: 3, 2: 1, 3: 1}
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, language.sample(table.repartition(7), 400)[1].collect()))


def test_held_out_languages(spark):
    found = QUERIES["op12_language"](ready(spark), FOLDER)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    labels = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = found.join(labels, "doc_id").collect()
    assert len(rows) == labels.count()
    assert all(row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2) for row in rows)
    held = [row for row in rows if row["held_out"]]
    assert len(held) > 200 and np.mean([row["lang"] == row["lang_pred"] for row in held]) > 0.99
    assert all(0 <= row["score"] <= 1 for row in rows) and np.mean([row["score"] for row in held]) > 0.98


def test_held_out_rows_teach_nothing(spark):
    """Another language and other texts in the held-out fold change no prediction of the others."""
    path = new_table_path(spark, "changed")
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(400)
    learn = language.may_learn()
    changed = documents.withColumn("lang", F.when(learn, F.col("lang")).otherwise("xx"))
    changed = changed.withColumn("text", F.when(learn, F.col("text")).otherwise("zzz qqq"))
    for name, table in (("a", documents), ("b", changed)):
        table.coalesce(1).write.parquet(f"{path}/{name}/documents.parquet")
    one, other = (
        {row["doc_id"]: row for row in QUERIES["op12_language"](spark, f"{path}/{name}").where("not held_out").collect()} for name in "ab"
    )
    assert one == other and "xx" not in {row["lang_pred"] for row in other.values()}


def test_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, lang_pred int, score string, held_out int, language int, place int"
    rest = ("s", 1, "x", 2, 3, 4)
    rows = [(k, "das ist ein haus und ein garten" if k % 2 else "this is the house and the garden", "de" if k % 2 else "en", *rest) for k in range(60)]
    rows += [(100, None, "en", *rest), (101, "", "en", *rest), (102, "12 !?", "en", *rest), (103, "the house " * 30_000, None, *rest)]
    rows += [(None, "ein haus", None, *rest), (None, "ein haus", None, *rest), (4, "the house", "en", *rest)]

    def run(rows):
        path = new_table_path(spark, "odd")
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{path}/documents.parquet")
        return QUERIES["op12_language"](spark, path)

    found = {row["doc_id"]: row for row in run(rows).collect()}
    assert run(rows).count() == len(rows)
    assert [(found[k]["lang_pred"], found[k]["score"]) for k in (100, 101, 102)] == [("und", 0.0)] * 3
    assert (found[103]["lang_pred"], found[None]["lang_pred"], found[None]["held_out"]) == ("en", "de", False)
    only = run([row for row in rows if row[2] == "de"]).collect()
    assert {(row["lang_pred"], row["score"]) for row in only} == {("de", 1.0)}
    untaught = run([(k, "some text", None, *rest) for k in range(5)]).collect()
    assert {(row["lang_pred"], row["score"]) for row in untaught} == {("und", 0.0)}
    empty = run([])
    assert empty.collect() == [] and empty.columns == ["doc_id", "held_out", "lang_pred", "score"]
