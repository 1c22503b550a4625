"""The Merkle manifest against trees built naively in one place."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import QUERIES, merkle
from tidemark.llm.common import ready
from tidemark.session import new_table_path


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree_of(leaves, fan):
    """All levels of one tree."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([sha(*levels[-1][k : k + fan]) for k in range(0, len(levels[-1]), fan)])
    return levels


def path_of(levels, at, fan):
    path = []
    for nodes in levels[:-1]:
        first = at // fan * fan
        path.append(("".join(nodes[first:at]), "".join(nodes[at + 1 : first + fan])))
        at //= fan
    return path


@pytest.mark.parametrize("fan, height", [(2, 1), (2, 3), (3, 2), (8, 2)])
def test_proofs_of_trees_of_many_sizes(spark, fan, height):
    chance = random.Random(fan * 10 + height)
    sizes = [1, 2, 3, fan, fan + 1, fan**height, fan**height + 1, 2 * fan**height, 3 * fan ** (2 * height) // 2, 4]
    rows = [(f"t{k:02d}", n, sha(str(k), str(n)), "x") for k, size in enumerate(sizes) for n in range(size)]
    chance.shuffle(rows)
    table = ready(spark).createDataFrame(rows, "tree string, place int, hashed string, n string").repartition(5)
    manifest = merkle.build(table, F.col("tree"), [F.col("place")], F.col("hashed"), fan, height)
    root, found = merkle.forest_proofs(manifest)
    trees = [tree_of([sha(str(k), str(n)) for n in range(size)], fan) for k, size in enumerate(sizes)]
    over = tree_of([levels[-1][0] for levels in trees], fan)
    assert root == over[-1][0]
    got = {(row["tree"], row["i"]): row for row in found.collect()}
    assert len(got) == sum(sizes)
    for k, levels in enumerate(trees):
        for n, hashed in enumerate(levels[0]):
            row = got[f"t{k:02d}", n]
            expected = path_of(levels, n, fan) + path_of(over, k, fan)
            assert (row["h"], row["top"], row["row"]["place"]) == (hashed, levels[-1][0], n)
            assert [(step["left"], step["right"]) for step in row["path"]] == expected
    folded = found.select(merkle.folded(F.col("h"), F.col("path")).alias("root")).distinct().collect()
    assert [row["root"] for row in folded] == [root]


def test_only_every_few_levels_are_stored(spark):
    table = ready(spark).range(1000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("hashed"))
    manifest = merkle.build(table, F.lit(""), [F.col("id")], F.col("hashed"), 2, 3)
    assert [level.count() for level in manifest.levels] == [1000, 125, 16, 2, 1]


def test_query_against_one_place(spark):
    """Nulls everywhere, empty and repeated texts, equal ids, letters that only Unicode lowers, one tree with most rows."""
    chance = random.Random(3)
    rows = []
    for k in range(1500):
        text = chance.choice([None, "", "Ä", f"Text {k}", "SAME", "漢字 A", "x" * 5000])
        lang = chance.choice([None, "", "en", "en", "en", "en", "é", "z"])
        rows.append((chance.choice([k, k, k, 7, None]), text, lang, chance.choice([None, "s"]), chance.choice([None, k])))
    rows += rows[:20] + [(5000, "Alone", "only", "s", 1)]
    path = new_table_path(ready(spark), "odd")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).selectExpr("*", "1 AS tree", "'c' AS row", "2 AS i").repartition(7).write.parquet(f"{path}/documents.parquet")

    def leaf(doc_id, text, lang, source, n_chars):
        fields = (doc_id, source, lang, n_chars, text)
        return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))

    def lowered(text):
        return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)

    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf(*row), row))
    langs = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    levels = {lang: tree_of([leaf for *_, leaf, _ in sorted(trees[lang], key=lambda r: r[:3])], 8) for lang in langs}
    over = tree_of([levels[lang][-1][0] for lang in langs], 8)
    expected = []
    for k, lang in enumerate(langs):
        for n, (_, _, own, row) in enumerate(sorted(trees[lang], key=lambda r: r[:3])):
            siblings = path_of(levels[lang], n, 8) + path_of(over, k, 8)
            node = own
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0:
                node = leaf(row[0], lowered(row[1]), *row[2:])
            for left, right in siblings:
                node = sha(left, node, right)
            proof = sha(*(part for step in siblings for part in step))
            expected.append((row[0] or -1, own, levels[lang][-1][0], over[-1][0], proof, node, node == over[-1][0]))
    columns = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = QUERIES["op11_merkle"](spark, path)
    assert found.columns == columns
    assert sorted((row[0] or -1, *row[1:]) for row in found.collect()) == sorted(expected)
    assert {row["verified"] for row in found.collect()} == {True, False}
