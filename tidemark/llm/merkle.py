"""Merkle manifest of a dataset that keeps only every few levels of its trees.

Rows are hashed to leaves, ordered within their tree and numbered by a distributed sort. ``FAN`` consecutive nodes become
one node of the next level, until one is left. Only every ``HEIGHT``-th level is written: a block of ``FAN ** HEIGHT``
consecutive stored nodes is an aligned subtree, one group of bounded size, whose root is one node of the next stored
level. The levels between are never stored. To extract proofs the stored levels are walked from the top: each block
rebuilds its missing interior nodes from its stored descendants, emits the siblings of each descendant on the way to the
block's root, appends the siblings that are known of that root, and forgets the interior nodes. The roots of the trees are
the leaves of one last tree in the same way.

Proofs are as long as the trees are high, and no step holds more than a block. Level 0 and every stored level above it are
tables in the shared folder, so a lost executor costs a recomputed block.

Defined results: a null value is hashed as ``-``, so that it differs from the empty text. Rows of a null tree are a tree of
their own, the first. Rows are ordered by the given columns, nulls first, then by their leaf; rows alike in all of these are
interchangeable and keep their number. A tree of one row has its leaf as root and no siblings. No rows give no trees and no
proofs. Texts are hashed whole, whatever their length. Columns that are not named as fields are not looked at.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import in_fold, numbered, query, ready, table
from tidemark.session import cut_lineage

#: Nodes that make one node of the next level, and the levels from one stored level to the next.
FAN = 8
HEIGHT = 3

PATH = "array<struct<left:string,right:string>>"
_PATH = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


# --- hashes ----------------------------------------------------------------------------------------------------------


def digest(parts: list[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field_text(column: Column) -> Column:
    """``-`` for null, else the length in bytes, a colon and the value, so that no two rows run into one."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*columns: Column) -> Column:
    return F.sha2(F.concat(*[field_text(column) for column in columns]), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its way up lead to."""
    return F.aggregate(path, start, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def siblings_digest(path: Column) -> Column:
    """One hash of all siblings, level by level from the leaf, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def levels_above(n: int, fan: int) -> int:
    """How often ``n`` nodes must be taken together until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // fan), levels + 1
    return levels


def regenerate(nodes: list[str], levels: int, fan: int = FAN) -> list[list[str]]:
    """The stored nodes of a block and the levels above them."""
    found = [nodes]
    for _ in range(levels):
        below = found[-1]
        found.append([digest(below[k : k + fan]) for k in range(0, len(below), fan)])
    return found


def siblings(levels: list[list[str]], at: int, fan: int = FAN) -> list[dict[str, str]]:
    """What stands to the left and right of a node and of each of its ancestors within the block."""
    found = []
    for nodes in levels[:-1]:
        first = at - at % fan
        found.append({"left": "".join(nodes[first:at]), "right": "".join(nodes[at + 1 : first + fan])})
        at //= fan
    return found


# --- the manifest ----------------------------------------------------------------------------------------------------


@dataclass
class Manifest:
    """Stored levels, the lowest first: (tree, i, n, h), with the rows themselves as ``row`` in the lowest."""

    levels: list[DataFrame]
    fan: int
    height: int

    @property
    def roots(self) -> DataFrame:
        """(tree, h): one row a tree."""
        return self.levels[-1].select("tree", "h")


def _numbered(rows: DataFrame, tree: Column, order: list[Column], hashed: Column) -> DataFrame:
    """(tree, row, h, i, n): the place of each row in its tree, and the size of the tree."""
    keys = [f"k{k}" for k in range(len(order))]
    given = rows.select(
        tree.alias("tree"), F.struct(*rows.columns).alias("row"), hashed.alias("h"), *[c.alias(k) for c, k in zip(order, keys)]
    )
    return numbered(given, "tree", [*keys, "h"]).select("tree", "row", "h", "i", "n")


def _ordered(group: pa.Table) -> pa.Table:
    return group.take(pc.sort_indices(group, [("i", "ascending")]))


def build(
    rows: DataFrame, tree: Column, order: list[Column], hashed: Column, fan: int = FAN, height: int = HEIGHT
) -> Manifest:
    """The stored levels over all rows. ``tree`` must not be null. One job for each stored level."""
    ready(rows.sparkSession)
    size = fan**height
    level = _numbered(rows, tree, order, hashed)
    largest = level.agg(F.max("n")).first()[0] or 0
    levels = [level]

    def root(group: pa.Table) -> pa.Table:
        group = _ordered(group)
        n, block = group["n"][0].as_py(), group["block"][0].as_py()
        nodes = group["h"].to_pylist()
        top = regenerate(nodes, height if n > size else levels_above(n, fan), fan)[-1]
        return pa.table({"tree": group["tree"][:1], "i": [block], "n": [-(-n // size)], "h": top})

    while largest > 1:
        blocks = level.select("tree", "i", "n", "h", F.floor(F.col("i") / size).cast("bigint").alias("block"))
        level = cut_lineage(blocks.groupBy("tree", "block").applyInArrow(root, "tree string, i long, n long, h string"))
        levels.append(level)
        largest = -(-largest // size)
    return Manifest(levels, fan, height)


def proofs(manifest: Manifest, top: DataFrame | None = None) -> DataFrame:
    """(row, tree, i, h, path, top) for each leaf: its siblings from the bottom to the root of its tree.

    ``top``: (tree, path, top) known of the roots; their paths are appended, and ``top`` is handed down.
    """
    fan, height, size = manifest.fan, manifest.height, manifest.fan**manifest.height
    upper = manifest.roots.select("tree", F.col("h").alias("top"), F.array().cast(PATH).alias("path")) if top is None else top
    upper = upper.select("tree", F.lit(0).cast("bigint").alias("block"), "path", "top")
    if len(manifest.levels) == 1:
        lowest = manifest.levels[0].withColumn("block", F.lit(0).cast("bigint"))
        return lowest.join(upper, ["tree", "block"]).select("row", "tree", "i", "h", "path", "top")

    def extract(group: pa.Table, above: pa.Table) -> pa.Table:
        group = _ordered(group)
        n = group["n"][0].as_py()
        levels = regenerate(group["h"].to_pylist(), height if n > size else levels_above(n, fan), fan)
        rest = above["path"][0].as_py()
        paths = [siblings(levels, at, fan) + rest for at in range(len(group))]
        kept = group.drop_columns(["n", "block"])
        kept = kept.append_column("path", pa.array(paths, _PATH))
        return kept.append_column("top", pa.chunked_array([pa.repeat(above["top"][0], len(group))]))

    for k in reversed(range(len(manifest.levels) - 1)):
        level = manifest.levels[k]
        columns = ["row", "tree", "i", "h"] if k == 0 else ["tree", "i", "h"]
        blocks = level.select(*columns, "n", F.floor(F.col("i") / size).cast("bigint").alias("block"))
        schema = T.StructType([*[blocks.schema[c] for c in columns], T.StructField("path", T.ArrayType(
            T.StructType([T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))),
            T.StructField("top", T.StringType())])
        found = blocks.groupBy("tree", "block").cogroup(upper.groupBy("tree", "block")).applyInArrow(extract, schema)
        upper = found.select("tree", F.col("i").alias("block"), "path", "top") if k else found
    return upper.select("row", "tree", "i", "h", "path", "top")


def forest_proofs(manifest: Manifest) -> tuple[str | None, DataFrame]:
    """The root over the roots of all trees, in order of the tree, and the proofs of all leaves up to it."""
    over = build(manifest.roots, F.lit(""), [F.col("tree")], F.col("h"), manifest.fan, manifest.height)
    root = over.roots.first()
    above = proofs(over).select("row.tree", "path", F.col("h").alias("top"))
    return root and root["h"], proofs(manifest, above)


# --- query -----------------------------------------------------------------------------------------------------------

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_LEAF = "sha256(" + " || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || {c} END" for c in FIELDS
) + ")"
#: crc32 of the id's digits, bit by bit.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, [CAST(ord(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, z: xor(x >> 1, (x & 1) * 3988292384))))"""

OP11_SQL = f"""
WITH RECURSIVE hashed AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {_LEAF} AS leaf,
    CASE WHEN {_CRC} % 3 = 0 THEN 1 ELSE 0 END AS tampered, source, lang, n_chars, translate(text, '{UPPER}', '{UPPER.lower()}') AS text FROM documents),
leaves AS (SELECT doc_id, tree, leaf, CASE WHEN tampered = 1 THEN {_LEAF} ELSE leaf END AS changed,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY tree) AS n FROM hashed),
nodes AS (SELECT tree, 0 AS level, i, leaf AS h, n FROM leaves
  UNION ALL
  SELECT tree, level + 1, i // {FAN}, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + {FAN - 1}) // {FAN} FROM nodes WHERE n > 1 GROUP BY tree, level, i // {FAN}),
subroots AS (SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (SELECT 0 AS level, i, subroot AS h, n FROM subroots
  UNION ALL
  SELECT level + 1, i // {FAN}, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + {FAN - 1}) // {FAN} FROM tops WHERE n > 1 GROUP BY level, i // {FAN}),
heights AS (SELECT tree, max(level) AS height FROM nodes GROUP BY tree),
way AS (SELECT l.doc_id, l.tree, l.i AS leaf_i, 0 AS level, l.i, l.changed AS h, '' AS proof, l.n AS n, 0 AS above, height FROM leaves l JOIN heights USING (tree)
  UNION ALL
  SELECT doc_id, tree, leaf_i, level + 1, i // {FAN}, sha256(lefts || h || rights), proof || lefts || rights, n, above, height FROM (
    SELECT w.doc_id, w.tree, w.leaf_i, w.level, w.i, w.h, w.proof, w.n, w.above, w.height,
      coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i < w.i), '') AS lefts, coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i > w.i), '') AS rights
    FROM way w JOIN nodes s ON s.tree = w.tree AND s.level = w.level AND s.i // {FAN} = w.i // {FAN}
    WHERE w.level < w.height GROUP BY ALL)),
higher AS (SELECT w.doc_id, w.tree, leaf_i, 0 AS level, s.i, w.h, w.proof FROM way w JOIN subroots s ON s.tree = w.tree WHERE w.level = w.height
  UNION ALL
  SELECT doc_id, tree, leaf_i, level + 1, i // {FAN}, sha256(lefts || h || rights), proof || lefts || rights FROM (
    SELECT w.doc_id, w.tree, w.leaf_i, w.level, w.i, w.h, w.proof,
      coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i < w.i), '') AS lefts, coalesce(string_agg(s.h, '' ORDER BY s.i) FILTER (s.i > w.i), '') AS rights
    FROM higher w JOIN tops s ON s.level = w.level AND s.i // {FAN} = w.i // {FAN}
    WHERE w.level < (SELECT max(level) FROM tops) GROUP BY ALL))
SELECT l.doc_id, l.leaf, s.subroot, t.h AS root, sha256(p.proof) AS proof_sha256, p.h AS folded_root, p.h = t.h AS verified
FROM leaves l JOIN subroots s USING (tree) JOIN higher p ON p.tree = l.tree AND p.leaf_i = l.i, (SELECT h FROM tops WHERE n = 1) t
WHERE p.level = (SELECT max(level) FROM tops)"""


@query("op11_merkle", OP11_SQL)
def op11_merkle(spark: SparkSession, folder: str) -> DataFrame:
    """The proof of every document, folded from its leaf, or from the leaf of a tampered text."""
    documents = table(spark, folder, "documents").select(*FIELDS)
    fields = [F.col(name) for name in FIELDS]
    lowered = F.translate("text", UPPER, UPPER.lower())
    tampered = F.when(in_fold("doc_id", 3, 0), leaf(*fields[:-1], lowered))
    # Null is the first tree, and no language is equal to it.
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    leaves = documents.select("doc_id", tree.alias("tree"), leaf(*fields).alias("leaf"), tampered.alias("tampered"))
    manifest = build(leaves, F.col("tree"), [F.col("doc_id")], F.col("leaf"))
    root, found = forest_proofs(manifest)
    root = F.lit(root).cast("string")
    found = found.select(
        "row.doc_id",
        "row.leaf",
        F.col("top").alias("subroot"),
        root.alias("root"),
        siblings_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("row.tampered", "row.leaf"), F.col("path")).alias("folded_root"),
    )
    return found.withColumn("verified", F.col("folded_root") == root)
