"""Token ids packed into fixed rows by best-fit decreasing, ready for training.

Documents are packed in blocks of bounded size, each within one task, so nothing is shuffled. Documents longer than a row
are cut losslessly into pieces. The pieces of a block are placed longest first; a segment tree over the number of rows
by free room finds the row with the least room that is enough. A row holds the ids (little-endian, as many bytes each as
the vocabulary needs), the cumulative lengths of its segments and the positions within each segment, which start again at 0.

Defined results: a null or empty text has the end id alone. Ties keep the order of the block. Repeated rows are packed
each. Empty tables give no rows. Very long texts are cut like others; a block holds at most ``BLOCK_TOKENS`` ids and one
document. Other columns are not looked at. Row names are made from what the row holds, so a task that is run again gives
the same rows; rows of equal documents under equal ids, in two blocks, have one name.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import query, ready, table
from tidemark.llm.tokens import VOCABULARY, document_ids

CONTEXT = 1024
#: Ids that a task holds at once.
BLOCK_TOKENS = 2_000_000


class RoomTree:
    """How many rows have each free room, as a segment tree; finds the least room that is enough."""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.rows = [0] * (2 * self.size)

    def add(self, room: int, change: int) -> None:
        node = room + self.size
        while node:
            self.rows[node] += change
            node >>= 1

    def at_least(self, room: int) -> int | None:
        node = room + self.size
        if self.rows[node]:
            return room
        while node > 1:
            # Rooms to the right of this one, nearest first.
            if not node & 1 and self.rows[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.rows[2 * node] else 2 * node + 1
                return node - self.size
            node >>= 1
        return None


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Rows, each a list of indices of pieces."""
    tree, open_rows, rows = RoomTree(capacity), defaultdict(list), []
    for piece in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        length = lengths[piece]
        room = tree.at_least(length)
        if room is None:
            row, room = len(rows), capacity
            rows.append([])
        else:
            row = open_rows[room].pop()
            tree.add(room, -1)
        rows[row].append(piece)
        if room > length:
            open_rows[room - length].append(row)
            tree.add(room - length, 1)
    return rows


SCHEMA = (
    "row_id long, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, used int, ids binary, position_ids binary"
)


def pack_block(pieces: list[tuple[int | None, int, np.ndarray]], context: int, width: str) -> pa.RecordBatch:
    """Rows of a block of (doc_id, start, ids)."""
    out = defaultdict(list)
    for row in best_fit_decreasing([len(ids) for _, _, ids in pieces], context):
        parts = [pieces[k][2] for k in row]
        lengths = [len(part) for part in parts]
        ids, positions = np.zeros(context, dtype=width), np.zeros(context, dtype="<u2" if context <= 65536 else "<u4")
        used = sum(lengths)
        ids[:used] = np.concatenate(parts)
        positions[:used] = np.concatenate([np.arange(length) for length in lengths])
        doc_ids, starts = [pieces[k][0] for k in row], [pieces[k][1] for k in row]
        raw = ids.tobytes()
        name = xxhash.xxh64_intdigest(repr((doc_ids, starts)).encode() + raw)
        for key, value in (
            ("row_id", int(np.uint64(name).astype(np.int64))), ("doc_ids", doc_ids), ("starts", starts),
            ("cu_seqlens", np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), ("used", used), ("ids", raw),
            ("position_ids", positions.tobytes()),
        ):
            out[key].append(value)
    kinds = (
        ("row_id", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())),
        ("cu_seqlens", pa.list_(pa.int32())), ("used", pa.int32()), ("ids", pa.binary()), ("position_ids", pa.binary()),
    )
    return pa.RecordBatch.from_arrays([pa.array(out[key], kind) for key, kind in kinds], [key for key, _ in kinds])


def packed_rows(
    documents: DataFrame, context: int = CONTEXT, block: int = BLOCK_TOKENS, vocabulary: str = VOCABULARY, ids: int = 50_257
) -> DataFrame:
    """The rows of all documents. ``ids``: size of the vocabulary, which decides the width of an id."""
    ready(documents.sparkSession)
    width = "<u2" if ids <= 65_536 else "<u4"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, tokens = [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.frombuffer(document_ids(text, name=vocabulary), dtype=np.uint32).astype(width)
                held += [(doc_id, k, found[k : k + context]) for k in range(0, len(found), context)]
                tokens += len(found)
                if tokens >= block:
                    yield pack_block(held, context, width)
                    held, tokens = [], 0
        if held:
            yield pack_block(held, context, width)

    return documents.select("doc_id", "text").mapInArrow(task, SCHEMA)


def write_rows(rows: DataFrame, path: str) -> None:
    """Packed rows as Parquet, in any folder Spark can write to."""
    rows.write.mode("overwrite").parquet(path)


@query("op7_binary_packing")
def op7_binary_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_rows(table(ready(spark), folder, "documents"))
