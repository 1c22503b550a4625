"""Whitening against a dense solver over exact whole numbers."""

import math
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import QUERIES, whitening
from tidemark.llm.common import ready
from tidemark.session import new_table_path

FOLDER = "/root/testdata/sf0.01"


def expected(vectors):
    """By definition: (n, sums, trace, eigenvalues, components) of {id: vector}."""
    distinct = {tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for v in vectors}
    n, size = len(distinct), len(next(iter(distinct)))
    sums = [sum(x[d] for x in distinct) for d in range(size)]
    centred = np.array([[float(Fraction(n * x[d] - sums[d], n)) for d in range(size)] for x in distinct])
    covariance = centred.T @ centred / n
    values, components = np.linalg.eigh(covariance)
    return n, sums, np.trace(covariance), values[::-1], components[:, ::-1]


def compare(rows, vectors, kept):
    n, sums, trace, values, components = expected([v for _, v in vectors])
    assert len(rows) == kept * len(vectors)
    by_id = {}
    for row in rows:
        by_id.setdefault((row["vec_id"], row["component"]), []).append(row)
    signs = {}
    for vec_id, vector in vectors:
        x = [math.floor(64 * float(c)) + 1_000_000 for c in vector]
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        centred = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])
        for k in range(kept):
            row = by_id[vec_id, k + 1].pop()
            assert (row["n"], row["deviation"]) == (n, deviation if deviation < 2**63 else None)
            assert row["explained"] == pytest.approx(values[k] / trace, rel=1e-9)
            wanted = centred @ components[:, k] / math.sqrt(values[k])
            if abs(wanted) > 1e-3:
                sign = signs.setdefault(k, np.sign(wanted * row["whitened"]))
                assert row["whitened"] * sign == pytest.approx(wanted, rel=1e-6, abs=1e-9)
    assert {row["identity_error"] for row in rows} == {rows[0]["identity_error"]} and 0 <= rows[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("size, rank", [(1, 1), (2, 2), (5, 5), (6, 3), (40, 40), (33, 7)])
def test_factor_and_rotations_give_eigenvalues(size, rank):
    chance = np.random.default_rng(size + rank)
    factor = chance.normal(size=(size, rank)) * 10.0 ** -np.arange(rank).clip(max=5)
    matrix = factor @ factor.T
    lower = whitening.pivoted_cholesky(matrix)
    assert lower.shape == (size, rank) and np.allclose(lower @ lower.T, matrix, rtol=0, atol=1e-12 * np.trace(matrix))
    columns = whitening.orthogonal_columns(lower)
    values = np.sort((columns * columns).sum(axis=0))[::-1]
    assert np.allclose(values, np.linalg.eigvalsh(matrix)[::-1][:rank], rtol=1e-6)
    unit = columns / np.sqrt((columns * columns).sum(axis=0))
    assert np.allclose(unit.T @ unit, np.eye(rank), atol=1e-9)


def test_every_two_columns_meet_once():
    pairs = [tuple(sorted(pair)) for one, other in whitening._rounds(10) for pair in zip(one.tolist(), other.tolist())]
    assert sorted(pairs) == [(a, b) for a in range(10) for b in range(a + 1, 10)]


def test_query_against_dense_solver(spark):
    rows = ready(spark).read.parquet(f"{FOLDER}/embeddings.parquet").collect()
    compare(QUERIES["op13_whitening"](spark, FOLDER).collect(), [(row["vec_id"], row["embedding"]) for row in rows], 16)


def test_odd_vectors(spark):
    """Nulls, holes, zeros, repeats under many ids, other lengths, huge entries, ids that are null; columns in the way."""
    chance = np.random.default_rng(4)
    good = [(k, [float(v) for v in chance.normal(size=5) * [1, 2, 3, 0.1, 50]]) for k in range(200)]
    good += [(300 + k, good[0][1]) for k in range(100)] + [(None, good[3][1]), (3, good[3][1]), (5, [0.0] * 5)]
    bad = [(1000, None), (1001, []), (1002, [1.0, None, 1.0, 1.0, 1.0]), (1003, [float("nan")] * 5), (1004, [1.0, float("-inf"), 1.0, 1.0, 1.0])]
    bad += [(1005, [1.0, 2.0]), (1006, [1.0] * 6)]

    def run(rows):
        path = new_table_path(spark, "vectors")
        table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        table = table.selectExpr("*", "1 AS x", "'c' AS component", "2 AS cell").repartition(6)
        table.write.parquet(f"{path}/embeddings.parquet")
        return QUERIES["op13_whitening"](spark, path)

    compare(run(good + bad).collect(), good, 5)
    huge = [(k, [v * 1e15 for v in vector]) for k, vector in good[:50]]
    found = run(huge).collect()
    assert len(found) == 250 and all(row["deviation"] is None for row in found) and found[0]["identity_error"] < 1e-6
    wide = [(k, [v * 1e5, float(k)]) for k, (v, *_) in good[:60]]
    compare(run(wide).collect(), wide, 2)
    # Five numbers that depend on two.
    flat = [(k, [v[0], v[0], v[0] + 0, v[1], v[1]]) for k, v in good[:50]]
    compare(run(flat).collect(), flat, 2)
    for rows in ([], bad[:5], [(1, [1.0, 2.0])], [(k, [1.0, 2.0]) for k in range(5)]):
        empty = run(rows)
        assert empty.collect() == [] and empty.columns == found[0].__fields__


def test_sums_are_exact(spark):
    table = spark.createDataFrame([([2**53 - k, -(2**53) + 3 * k],) for k in range(999)], "x array<long>").repartition(3)
    assert whitening._sums(table, 2) == (999, [sum(2**53 - k for k in range(999)), sum(-(2**53) + 3 * k for k in range(999))])
    assert whitening._sums(table.where(F.lit(False)), 2) == (0, [])
