"""Nulls, empty and long texts, repeated rows, empty tables and columns with clashing names, for operators and stages."""

from collections import Counter

import pytest

import __spark_entry__ as entry_point
import corpus_pipeline
from tidemark.llm import QUERIES
from tidemark.llm.common import ready
from tidemark.session import new_table_path

EXTRA = "score double, node long, label int, window long, host string, _salt int, gone array<long>, sequence_id string, comp string, "
EXTRA += "rank string, text_key int, gone_id string, host_key long, i string, n string, tree int, `row` string, lang_pred int, path string"
DOCUMENTS = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"
CLASH = (0.5, 1, 2, 3, "h", 4, [1], "s", "c", "r", 1, "g", 2, "i", "n", 3, "w", 4, "p")


@pytest.fixture(scope="module")
def folders(spark):
    """Two folders of tables: odd rows, and none."""
    ready(spark)
    long = "very long text " * 20_000
    texts = [None, "", " ", "\n\n", "one", "same text here\nfooter", "same text here\nfooter", long, "i d i o t", "1d10t " * 30, "\ufffd\x00 odd 漢字"]
    rows = [(k, text, "en", "src0" if k % 3 else None, len(text or "")) + CLASH for k, text in enumerate(texts)]
    rows += [(None, "no id", None, None, None) + CLASH, (None, "no id", None, None, None) + CLASH, rows[5], rows[5]]
    rows += [(50 + k, f"plain words number {k} of some kind", "en", "src0", 5) + CLASH for k in range(20)]
    tables = {
        "documents": (rows, DOCUMENTS),
        "labels": ([(k, k % 2, int(k % 3 == 0), "x") for k in range(70)] + [(None, 1, 1, "x"), (3, None, None, "x"), (5, 1, 1, "x")],
                   "doc_id long, quality int, toxic int, text string"),
        "benchmark": ([(1, "the very long text very long text very long text"), (1, None), (None, ""), (2, "plain words number 7 of some kind")],
                      "item_id long, text string"),
        "pages": ([(1, None, "h", "p"), (2, "http://a.net/x", "h", "p"), (2, "http://a.net/x", "h", "p"), (None, "", "h", "p"),
                   (3, "http://b.org/fr/1", "h", "p")], "page_id long, url string, host string, label string"),
        "embeddings": ([(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (20, None, 1), (40, [0.0, 0.0], 1), (3, [0.5, 0.5], 1), (None, [1.0, 1.0], 1)],
                       "vec_id long, embedding array<float>, point int"),
    }
    odd, none = new_table_path(spark, "odd"), new_table_path(spark, "none")
    for name, (own, schema) in tables.items():
        spark.createDataFrame(own, schema).repartition(3).write.parquet(f"{odd}/{name}.parquet")
        spark.createDataFrame([], schema).write.parquet(f"{none}/{name}.parquet")
    return odd, none, len(rows)


ONE_ROW_EACH = ("op2_toxicity", "op4_licenses", "op6_simhash", "op8_linefreq", "op9_quality", "op11_merkle", "op12_language")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_tables(spark, folders, name):
    odd, none, n = folders
    rows = QUERIES[name](spark, odd).collect()
    assert rows or name == "op3_decontaminate"
    if name in ONE_ROW_EACH:
        assert len(rows) == n
    empty = QUERIES[name](spark, none)
    assert empty.columns == QUERIES[name](spark, odd).columns and empty.count() == 0


def test_odd_rows_have_the_stated_results(spark, folders):
    odd = folders[0]
    simhash = [row for row in QUERIES["op6_simhash"](spark, odd).collect()]
    assert {row["component_id"] for row in simhash if row["fingerprint"] == "0" * 16} == {0}
    assert {row["component_id"] for row in simhash if row["doc_id"] is None} == {None}
    packed = QUERIES["op1_packing"](spark, odd).where("doc_id <= 1").collect()
    assert [(row["length"], row["doc_tokens"]) for row in packed] == [(1, 1)] * 2
    found = QUERIES["op5_neighbours"](spark, odd).collect()
    assert [(row["query_id"], row["vec_id"]) for row in found] == [(0, 3)]
    languages = {row["doc_id"]: (row["lang_pred"], row["score"]) for row in QUERIES["op12_language"](spark, odd).collect()}
    assert languages[0] == languages[1] == languages[2] == languages[3] == ("und", 0.0) and languages[4] == ("en", 1.0)
    merkle = QUERIES["op11_merkle"](spark, odd).collect()
    assert len({row["root"] for row in merkle}) == 1 and len({row["subroot"] for row in merkle}) == 2  # of en and of null
    assert all(row["verified"] == (row["folded_root"] == row["root"]) for row in merkle) and any(row["verified"] for row in merkle)
    whitened = QUERIES["op13_whitening"](spark, odd).collect()
    assert {row["vec_id"] for row in whitened} == {0, 40, 3, None} and {row["n"] for row in whitened} == {4}
    assert Counter(row["component"] for row in whitened) == {1: 5, 2: 5}
    lines = {row["doc_id"]: row for row in QUERIES["op8_linefreq"](spark, odd).collect()}
    assert (lines[0]["text"], lines[0]["n_lines"], lines[1]["text"], lines[3]["text"]) == (None, 0, "", "\n\n")
    for name in ("op2_toxicity", "op9_quality"):
        scores = {row["doc_id"]: row["score"] for row in QUERIES[name](spark, odd).collect()}
        assert all(0 <= score <= 1 for score in scores.values()) and scores[0] == scores[1]
    licences = {row["doc_id"]: row for row in QUERIES["op4_licenses"](spark, odd).collect()}
    assert (licences[0]["n_words"], licences[0]["first_word"], licences[0]["labels"], licences[0]["score"]) == (0, None, "", 0)


def test_stages(spark, folders):
    odd, none, n = folders
    for folder in (odd, none):
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        columns = docs.columns
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
            assert docs.columns == columns, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() >= docs.count()


def test_near_copies_keep_one_row_of_repeated_rows(spark, folders):
    kept = dict(corpus_pipeline.STAGES)["near dedup"](spark, spark.read.parquet(f"{folders[0]}/documents.parquet"), folders[0]).collect()
    assert [row["doc_id"] for row in kept].count(5) == 1 and sum(row["doc_id"] is None for row in kept) == 1
    assert [row["doc_id"] for row in kept if not (row["text"] or "").split()] == [0]


def test_queries_are_registered():
    names = entry_point.queries()
    assert "pipeline" in names and all(any(name.startswith(f"op{n}_") for name in names) for n in range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line dedup", "near dedup", "decontamination", "packing"]


def test_pipeline_runs(spark):
    rows = corpus_pipeline.run(ready(spark), "/root/testdata/sf0.001")
    assert rows.count() > 100 and "sequence_id" in rows.columns
