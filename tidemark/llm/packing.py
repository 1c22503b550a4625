"""Packing into windows, planned on the histogram of lengths by non-negative least squares.

Documents longer than a window fill windows of their own; what is left of each is shorter than a window. Combinations of
two or three such lengths that fill a window exactly are enumerated. Non-negative least squares finds how often to use
each, so that they use up the histogram of lengths. The repeat counts are rounded without using any length more often than
it occurs, and what remains is packed greedily, longest first, again by length and not by document. The plan is as
large as the number of combinations, whatever the number of documents. Each piece then finds its place by its rank among
pieces of its length: ranks are counted within salted groups of bounded size, and the sizes of the groups before are
added. So a length that very many pieces share is not one task.

Defined results: a null or empty text has the end id alone. Ties in a group are ordered by all columns of a piece, so
only equal pieces can change places. Repeated rows are packed each. Empty tables give no pieces. Other columns are
not looked at.
"""

from __future__ import annotations

import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tidemark.llm.common import query, ready, table
from tidemark.llm.tokens import VOCABULARY, document_ids
from tidemark.session import cut_lineage

CAPACITY = 1024
#: Pieces of one length that are ranked by one task.
GROUP_ROWS = 50_000
STEPS = 200


# --- the plan ------------------------------------------------------------------------------------------------------


def combinations_filling(capacity: int, present: np.ndarray) -> np.ndarray:
    """Every two or three lengths that add up to the capacity, in order, from those present; a missing third is 0."""
    have = np.zeros(capacity + 1, dtype=bool)
    have[present] = True
    a, b = np.meshgrid(np.arange(1, capacity), np.arange(1, capacity), indexing="ij")
    c = capacity - a - b
    found = (a >= b) & (b >= c) & (c >= 0)
    a, b, c = a[found], b[found], c[found]
    usable = have[a] & have[b] & (have[c] | (c == 0))
    return np.stack([a[usable], b[usable], c[usable]], axis=1)


def repeat_counts(filling: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Non-negative least squares by accelerated projected gradients: how often to use each combination."""
    if not len(filling):
        return np.zeros(0)
    size = len(histogram)

    def used(x: np.ndarray) -> np.ndarray:
        found = sum(np.bincount(filling[:, k], x, size) for k in range(3))
        found[0] = 0
        return found

    def slope(rest: np.ndarray) -> np.ndarray:
        return rest[filling].sum(axis=1)

    v = np.ones(len(filling))
    for _ in range(12):
        v = slope(used(v))
        scale = np.linalg.norm(v)
        v /= scale
    step = 1 / (1.05 * scale)
    x = y = np.zeros(len(filling))
    momentum = 1.0
    goal = histogram.astype(float).copy()
    goal[0] = 0
    for _ in range(steps):
        following = np.maximum(0, y - step * slope(used(y) - goal))
        ahead = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y = following + (momentum - 1) / ahead * (following - x)
        x, momentum = following, ahead
    return x


def patterns(histogram: np.ndarray, capacity: int = CAPACITY) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a window, number of such windows) that use every piece of the histogram once."""
    left = histogram.astype(np.int64).copy()
    found: list[tuple[tuple[int, ...], int]] = []

    def take(lengths: tuple[int, ...], wanted: int) -> None:
        n = min([wanted, *(int(left[length]) // many for length, many in Counter(lengths).items())])
        if n > 0:
            for length in lengths:
                left[length] -= n
            found.append((lengths, n))

    take((capacity,), int(left[capacity]))
    filling = combinations_filling(capacity, np.flatnonzero(left[:capacity]))
    counts = repeat_counts(filling, left[:capacity])
    # Rounded so that what is lost by one combination is passed on to the next.
    whole = np.diff(np.floor(np.cumsum(counts) + 0.5), prepend=0.0).astype(np.int64)
    for k in np.argsort(-counts, kind="stable"):
        if whole[k] > 0:
            take(tuple(int(length) for length in filling[k] if length), int(whole[k]))
    # What remains, longest first, each time with the longest that fit.
    while (present := np.flatnonzero(left)).size:
        lengths, room, spare = [int(present[-1])], capacity - int(present[-1]), left.copy()
        spare[lengths[0]] -= 1
        while room:
            fitting = np.flatnonzero(spare[: room + 1])
            if not fitting.size:
                break
            longest = int(fitting[-1])
            many = min(room // longest, int(spare[longest]))
            lengths += [longest] * many
            spare[longest] -= many
            room -= longest * many
        take(tuple(lengths), sys.maxsize)
    return found


def places(planned: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """(length, first rank, first sequence, offset) in order: the pieces of a length from that rank on go to that sequence
    and the following ones, up to the next row."""
    rows, next_rank, sequence = [], Counter(), 0
    for lengths, n in planned:
        offset = 0
        for length in lengths:
            rows.append((length, next_rank[length], sequence, offset))
            next_rank[length] += n
            offset += length
        sequence += n
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)


# --- pieces --------------------------------------------------------------------------------------------------------


def cut(text: Column | str, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> Column:
    """The pieces of a text: {start, length, ids_crc32}. All but the last fill a window."""
    ready(SparkSession.active())
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))

    def pieces(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = []
            for text in texts.to_pylist():
                ids = document_ids(text, name=vocabulary)
                if sys.byteorder != "little":
                    ids.byteswap()
                raw = memoryview(ids).cast("B")
                found.append(
                    [
                        {"start": k, "length": min(capacity, len(ids) - k), "ids_crc32": zlib.crc32(raw[4 * k : 4 * (k + capacity)])}
                        for k in range(0, len(ids), capacity)
                    ]
                )
            yield pa.array(found, kind)

    pieces.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    # Marked so that a filter on the pieces does not cut a text twice.
    return arrow_udf(pieces, "array<struct<start:bigint,length:bigint,ids_crc32:bigint>>").asNondeterministic()(text)


def pack(pieces: DataFrame, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS) -> DataFrame:
    """``pieces`` with their ``sequence_id`` and ``offset``. Needs a column ``length`` from 1 to ``capacity``; equal rows
    are interchangeable."""
    ready(pieces.sparkSession)
    columns = pieces.columns
    pieces = cut_lineage(pieces)
    counted = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for row in counted:
        histogram[row["length"]] = row["n"]
    shared = pieces.sparkSession.sparkContext.broadcast(places(patterns(histogram, capacity)))

    salts = max(1, -(-int(histogram.max()) // group_rows))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(*columns), F.lit(salts)))
    groups = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("_n")
    groups = groups.select("length", "_salt", before.alias("_before"))
    rank = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*columns)) - 1
    ranked = salted.withColumn("_rank", rank).join(groups, ["length", "_salt"])
    ranked = ranked.select(*columns, (F.col("_rank") + F.col("_before")).alias("_rank"))
    at, rank_at = columns.index("length"), len(columns)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        # Lengths and ranks in one ordered key.
        stride = int(table[:, 1].max()) + 1 + int(histogram.max()) if len(table) else 1
        ordered = table[:, 0] * stride + table[:, 1]
        for batch in batches:
            length = batch.column(at).to_numpy(zero_copy_only=False)
            rank = batch.column(rank_at).to_numpy(zero_copy_only=False)
            row = np.searchsorted(ordered, length * stride + rank, side="right") - 1
            sequence = table[row, 2] + rank - table[row, 1]
            arrays = [*batch.columns[:rank_at], pa.array(sequence, pa.int64()), pa.array(table[row, 3], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, "sequence_id", "offset"])

    schema = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in pieces.schema)
    return ranked.mapInArrow(place, f"{schema}, sequence_id bigint, offset bigint")


def document_pieces(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The pieces of all documents, tokenized once."""
    ready(spark)
    cut_up = docs.select("doc_id", cut("text").alias("pieces"))
    last = F.element_at("pieces", -1)
    # Every document has a piece. A plain explode would first filter on the number of pieces.
    cut_up = cut_up.select("doc_id", (last["start"] + last["length"]).alias("doc_tokens"), F.explode_outer("pieces").alias("piece"))
    return cut_up.select("doc_id", "piece.start", "piece.length", "piece.ids_crc32", "doc_tokens")


def pack_documents(spark: SparkSession, docs: DataFrame, folder: str | None = None) -> DataFrame:
    """The pieces of all documents and their places."""
    packed = pack(document_pieces(spark, docs))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query("op1_packing")
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(spark, table(spark, folder, "documents"))
