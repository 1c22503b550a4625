"""Near copies by SimHash, found with Golay-code keys.

Fingerprints of 64 bits are cut into segments A and B of 23 bits and C of 18. The perfect binary Golay code (23, 12) gives
every 23-bit word one codeword within three bits. The codewords of a word and of all words one bit away are its *near*
codewords (about five). If two words differ in one bit, the codeword of either is near to the other; if in two, they
share a near codeword. When two fingerprints differ in at most four bits, either two segments differ in at most one bit
each, or two segments differ in exactly two bits and the third in none. The keys of ``KINDS`` cover every such case, so a
join on the keys, verified by counting bits, loses no link.

Only different fingerprints take part, whatever number of documents has them. First rounds link every node to one neighbour
for each key, which joins most of a dense group by few links. The last round then only looks for links between
different components; so no group is written out as all its pairs.

Defined results: a null text is an empty text; empty texts have fingerprint zero, which links like any other. Ties have no
meaning here: a component is named by its smallest id. A null id is never the smallest unless all are null. Repeated rows
are in one component. Empty tables give empty results. Texts are read
whole, whatever their length. Other columns are not looked at, and stay.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tidemark.llm.common import fresh, query, ready, table
from tidemark.session import cut_lineage

#: Bits in which linked fingerprints may differ. The keys cover no more.
MAX_BITS = 4
WIDTHS = {"A": 23, "B": 23, "C": 18}
#: Generator polynomial of the Golay code, by its bits.
GENERATOR = 0b110001110101


# --- fingerprints --------------------------------------------------------------------------------------------------


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of the shingles of ``size`` words, repeats included; of all words if there are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype="<u8")
    one = xxhash.xxh64_intdigest
    if size == 1:
        hashes = [one(word, 42) for word in words]
    else:
        hashes = [one(b" ".join(words[k : k + size]), 42) for k in range(max(1, len(words) - size + 1))]
    return np.array(hashes, dtype="<u8")


def remix(hashes: np.ndarray, salt: int) -> np.ndarray:
    """Other hashes of the same things."""
    with np.errstate(over="ignore"):
        x = hashes + np.uint64(salt) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def majority(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes."""
    if not len(hashes):
        return 0
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    chosen = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(chosen, bitorder="little").view("<u8")[0])


def _arrow_column(function, kind: str, arrow: pa.DataType):
    ready(SparkSession.active())

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([function(text) for text in texts.to_pylist()], arrow)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return arrow_udf(run, kind)


def fingerprint(text: Column | str, size: int = 4) -> Column:
    """The fingerprint of the shingles of a text, as a signed 64-bit number."""

    def one(value: str | None) -> int:
        return int(np.uint64(majority(shingle_hashes(value, size))).astype(np.int64))

    return _arrow_column(one, "bigint", pa.int64())(text)


def shingle_set(text: Column | str, size: int) -> Column:
    def different(value: str | None) -> np.ndarray:
        return np.unique(shingle_hashes(value, size)).view(np.int64)

    return _arrow_column(different, "array<bigint>", pa.list_(pa.int64()))(text)


def _parity(hashes: np.ndarray, places: int) -> np.ndarray:
    """Bitmap of the parity of the number of hashes in each place, as bytes."""
    odd = np.bincount((hashes & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def least_hashes(hashes: np.ndarray) -> np.ndarray:
    """The least of the elements of a set in each of ``KEYS`` times ``HASHES`` random orders."""
    orders = remix(np.arange(1, KEYS * HASHES + 1, dtype=np.uint64), 7)[:, None]
    factors, salts, short = orders.astype("<u4") | np.uint32(1), (orders >> np.uint64(32)).astype("<u4"), hashes.astype("<u4")
    least = np.full(KEYS * HASHES, 0xFFFFFFFF, dtype="<u4")
    for start in range(0, len(short), 1024):
        x = (short[None, start : start + 1024] ^ salts) * factors
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x85EBCA6B)
        np.minimum(least, x.min(axis=1), out=least)
    return least


def least_keys(least: np.ndarray) -> list[int]:
    """``KEYS`` keys of a set, each of ``HASHES`` of its least elements."""
    return [xxhash.xxh64_intdigest(row.tobytes(), k) - (1 << 63) for k, row in enumerate(least.reshape(KEYS, HASHES))]


def one_bit_sketches(least: np.ndarray) -> np.ndarray:
    """``SKETCHES`` fingerprints of 64 bits, each bit the last of a least element.

    In two sets of similarity s a bit is equal with a probability of (1 + s) / 2.
    """
    bits = (least[: 64 * SKETCHES] & np.uint32(1)).astype(np.uint8)
    return np.packbits(bits, bitorder="little").view("<i8")


def shingle_sketch(text: Column | str, size: int) -> Column:
    """(size, parity, folded, keys, bits) of the different shingles of a text: their number, a bitmap of the parity of their
    number in each of 2^k places, the same for ``PLACES`` places as numbers, ``least_keys`` and ``one_bit_sketches``.

    ``parity`` has at least as many places as shingles. Half a bitmap laid over the other half, by exclusive or, is the
    bitmap of half as many places; so bitmaps of any two texts can be compared.
    """

    def sketch(value: str | None) -> dict:
        hashes = np.unique(shingle_hashes(value, size))
        places = 1 << max(6, int(len(hashes)).bit_length())
        least = least_hashes(hashes)
        return {
            "size": len(hashes),
            "parity": _parity(hashes, places).tobytes(),
            "folded": _parity(hashes, PLACES).view("<i8"),
            "keys": least_keys(least),
            "bits": one_bit_sketches(least),
        }

    numbers = pa.list_(pa.int64())
    fields = [("size", pa.int64()), ("parity", pa.binary()), ("folded", numbers), ("keys", numbers), ("bits", numbers)]
    kind = "struct<size: bigint, parity: binary, folded: array<bigint>, keys: array<bigint>, bits: array<bigint>>"
    return _arrow_column(sketch, kind, pa.struct(fields))(text)


def odd_places(one: bytes, other: bytes) -> int:
    """Places in which two bitmaps of parity differ. Sets differ in at least as many elements."""
    a, b = np.frombuffer(one, dtype="<u8"), np.frombuffer(other, dtype="<u8")
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def _odd_places(one: Column | str, other: Column | str) -> Column:
    ready(SparkSession.active())

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for left, right in batches:
            yield pa.array([odd_places(a, b) for a, b in zip(left.to_pylist(), right.to_pylist())], pa.int64())

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return arrow_udf(run, "bigint")(one, other)


# --- keys ----------------------------------------------------------------------------------------------------------


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder by the generator."""
    rest = words.astype(np.int64)
    for bit in range(22, 10, -1):
        rest = np.where(rest >> bit & 1, rest ^ (GENERATOR << (bit - 11)), rest)
    return rest


_ERRORS: list[np.ndarray] = []


def errors() -> np.ndarray:
    """The error of up to three bits that each remainder stands for."""
    if not _ERRORS:
        patterns = [sum(1 << bit for bit in bits) for weight in range(4) for bits in combinations(range(23), weight)]
        found = np.zeros(2048, dtype=np.int64)
        found[syndrome(np.array(patterns))] = patterns
        _ERRORS.append(found)
    return _ERRORS[0]


def decode(words: np.ndarray) -> np.ndarray:
    """Index of the codeword nearest to each word."""
    return (words ^ errors()[syndrome(words)]) >> 11


def segments(fingerprints: np.ndarray) -> dict[str, np.ndarray]:
    bits = fingerprints.view(np.uint64)
    a, b, c = bits & np.uint64(0x7FFFFF), bits >> np.uint64(23) & np.uint64(0x7FFFFF), bits >> np.uint64(46)
    return {"A": a.astype(np.int64), "B": b.astype(np.int64), "C": c.astype(np.int64)}


def near(words: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Codewords of each word and of the words one bit away: a row of indices in order, and which of them are new."""
    flips = np.concatenate([[0], 1 << np.arange(width)])
    found = np.sort(decode(words[:, None] ^ flips[None, :]), axis=1)
    new = np.ones(found.shape, dtype=bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    return found, new


#: The segment by whose codeword nodes are ordered under each kind of key.
LEFT_OUT = ("C", "B", "A", "B", "B", "A")
#: What each kind of key is made of, on the side that is looked up and on the side that looks up. "own": the codeword
#: of a segment, "near": its near codewords, "all": its bits. The first three allow one bit in each of two segments,
#: the fourth none in C and two in A, the others none in one.
KINDS = (
    (("A", "near", "own"), ("B", "own", "near")),
    (("A", "near", "own"), ("C", "own", "near")),
    (("B", "near", "own"), ("C", "own", "near")),
    (("C", "all", "all"), ("A", "near", "near")),
    (("A", "all", "all"),),
    (("B", "all", "all"),),
)


def keys(fingerprints: np.ndarray, side: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, key, codeword left out) of all keys. side: 0 looked up, 1 looking up, 2 own codewords only."""
    parts = segments(fingerprints)
    rows = np.arange(len(fingerprints))
    nears = {} if side == 2 else {name: near(word, WIDTHS[name]) for name, word in parts.items()}
    words = {name: decode(word) for name, word in parts.items()}
    found_rows, found_keys, found_rest = [], [], []
    for kind, terms in enumerate(KINDS):
        row, key = rows, np.full(len(rows), kind, dtype=np.int64)
        for name, *forms in terms:
            form = "own" if side == 2 and forms[0] != "all" else forms[min(side, 1)]
            width = 12 if form != "all" else WIDTHS[name]
            if form == "near":
                index, new = nears[name]
                at, column = np.nonzero(new[row])
                key, row = key[at] << width | index[row[at], column], row[at]
            else:
                value = words[name] if form == "own" else parts[name]
                key = key << width | value[row]
        found_rows.append(row)
        found_keys.append(key | kind << 40)
        found_rest.append(words[LEFT_OUT[kind]][row])
    return np.concatenate(found_rows), np.concatenate(found_keys), np.concatenate(found_rest)


def _with_keys(nodes: DataFrame, side: int) -> DataFrame:
    """(key, node, fp, comp, size, rest) of (node, fp, comp, size, salt); different salts never share a key."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, fp, comp, size, salt = (column.to_numpy(zero_copy_only=False) for column in batch.columns)
            row, key, rest = keys(np.ascontiguousarray(fp, dtype=np.int64), side)
            key = key | salt[row].astype(np.int64) << 48
            found = (key, node[row], fp[row], comp[row], size[row], rest)
            columns = [pa.array(values, pa.int64()) for values in found]
            yield pa.RecordBatch.from_arrays(columns, ["key", "node", "fp", "comp", "size", "rest"])

    schema = "key long, node long, fp long, comp long, size long, rest long"
    return nodes.select("node", "fp", "comp", "size", "salt").mapInArrow(task, schema)


def differing_bits(one: Column, other: Column) -> Column:
    return F.bit_count(one.bitwiseXOR(other))


# --- components ----------------------------------------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node of the edges (a, b): the smallest node that can be reached.

    Alternates the large-star and small-star steps (Kiveris et al. 2014). Edges are written to the shared folder after each
    pair of steps; the walk ends when a pair of steps changes nothing. Minima are combined before their shuffle; the
    joins with the centre of a large star are followed by another shuffle, so adaptive execution may split them.
    """

    def large(edges: DataFrame) -> DataFrame:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        moved = both.where("b > a").join(least, "a")
        return moved.select(F.col("b").alias("a"), F.col("m").alias("b"))

    def small(edges: DataFrame) -> DataFrame:
        least = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
        return moved.union(least.select("a", F.col("m").alias("b"))).distinct()

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b"))).first())

    found = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    found = cut_lineage(found.distinct())
    before = state(found)
    while before[0]:
        found = cut_lineage(small(large(found)))
        after = state(found)
        if after == before:
            break
        before = after
    own = found.select(F.col("b").alias("node"), F.col("b").alias("comp")).distinct()
    return found.select(F.col("a").alias("node"), F.col("b").alias("comp")).union(own)


def _in_components(nodes: DataFrame, found: DataFrame) -> DataFrame:
    joined = nodes.drop("comp").join(found, "node", "left")
    return joined.withColumn("comp", F.coalesce("comp", "node"))


def _neighbour_pairs(nodes: DataFrame, side: int, turn: int) -> DataFrame:
    """Pairs (a, b) of nodes that follow one another under a key, are in different components and close.

    Under a key, nodes are put in order by the codeword of a segment that the key leaves out, in another order in each
    turn; so near copies follow one another however many other nodes share the key. A key gives fewer pairs than nodes.
    """
    order = [F.xxhash64("rest", F.lit(turn)), F.xxhash64("fp", F.lit(turn)) if turn else F.col("fp"), F.col("node")]
    before = F.lag(F.struct("node", "fp", "comp")).over(Window.partitionBy("key").orderBy(*order))
    met = _with_keys(nodes, side).withColumn("before", before).where("comp != before.comp")
    met = met.where(differing_bits(F.col("fp"), F.col("before.fp")) <= MAX_BITS)
    one, other = F.col("node"), F.col("before.node")
    return met.select(F.greatest(one, other).alias("a"), F.least(one, other).alias("b")).distinct()


def _stars(known: DataFrame) -> DataFrame:
    return known.where("node != comp").select(F.col("node").alias("a"), F.col("comp").alias("b"))


def key_pairs(nodes: DataFrame, similarity: float = 0.0) -> DataFrame:
    """Pairs (a, b) of all nodes of different components whose fingerprints of one salt differ in at most ``MAX_BITS`` bits and
    whose smaller ``size`` is at least ``similarity`` times the larger, from (node, fp, comp, size, salt)."""
    one, other = _with_keys(nodes, 0).drop("rest").alias("u"), _with_keys(nodes, 1).drop("rest").alias("v")
    met = one.join(
        other,
        (F.col("u.key") == F.col("v.key"))
        & (F.col("u.comp") != F.col("v.comp"))
        & (F.least("u.size", "v.size") >= similarity * F.greatest("u.size", "v.size"))
        & (differing_bits(F.col("u.fp"), F.col("v.fp")) <= MAX_BITS),
    )
    return met.select(F.greatest("u.node", "v.node").alias("a"), F.least("u.node", "v.node").alias("b")).distinct()


def linked(nodes: DataFrame, turns: int = 3) -> DataFrame:
    """(node, comp) of the nodes that have links, from (node, fp, size, salt): those whose fingerprints differ in at most
    ``MAX_BITS`` bits.

    Neighbours under a key join most of every dense group first, in up to ``turns`` further turns among the nodes that were
    close to a neighbour. The last join then looks at all nodes and keys, but only for links between different
    components, and finds every link that is still needed.
    """
    tried = cut_lineage(_neighbour_pairs(nodes.withColumn("comp", F.col("node")), 2, 0))
    known = cut_lineage(components(tried))
    close = tried.select(F.col("a").alias("node")).union(tried.select("b")).distinct()
    active = cut_lineage(nodes.join(close, "node", "left_semi"))
    for turn in range(1, turns + 1):
        found = cut_lineage(_neighbour_pairs(_in_components(active, known), 0, turn))
        if found.isEmpty():
            break
        known = cut_lineage(components(found.union(_stars(known))))

    last = cut_lineage(key_pairs(cut_lineage(_in_components(nodes, known))))
    return components(last.union(_stars(known)))


def fingerprint_components(prints: DataFrame) -> DataFrame:
    """(fp, component_id) of all fingerprints of (doc_id, fp)."""
    ids = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")))
    found = cut_lineage(linked(ids.select(F.col("fp").alias("node"), "fp", F.lit(0).cast("long").alias("size"), F.lit(0).alias("salt"))))
    named = ids.join(found.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.withColumn("comp", F.coalesce("comp", "fp"))
    smallest = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return named.join(smallest, "comp").select("fp", "component_id")


def simhash_components(documents: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of all documents."""
    prints = cut_lineage(documents.select("doc_id", fingerprint("text").alias("fp")))
    # Written first, so that both sides of the join are plain and a fingerprint that many documents share is split.
    named = cut_lineage(fingerprint_components(prints))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(named, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


# --- the stage -----------------------------------------------------------------------------------------------------

WORDS, SIMILARITY = 5, 0.8
#: Texts of similarity s share none of their keys with a probability of (1 - s ** HASHES) ** KEYS, 3e-6 at 0.8.
KEYS, HASHES = 32, 5
#: Places of the bitmap that goes into the join.
PLACES = 512
#: One-bit sketches that are searched with Golay keys.
SKETCHES = 2


def similar(texts: DataFrame, sketches: DataFrame, words: int = WORDS, similarity: float = SIMILARITY):
    """A filter for pairs (a, b) of nodes whose sets of word shingles have at least that Jaccard similarity.

    ``texts``: (node, text); ``sketches``: (node, size, parity). Sets that differ in d elements and are that similar have
    sizes m, n with m + n - d >= similarity * (m + n + d). The sketch gives a lower bound of d in an eighth of a byte or
    two for each shingle, so that sets are made and compared only for the pairs that the bound leaves.
    """

    def verify(pairs: DataFrame) -> DataFrame:
        one = sketches.select(F.col("node").alias("a"), F.col("size").alias("size_a"), F.col("parity").alias("parity_a"))
        other = sketches.select(F.col("node").alias("b"), F.col("size").alias("size_b"), F.col("parity").alias("parity_b"))
        sized = pairs.join(one, "a").join(other, "b")
        sized = sized.where(F.least("size_a", "size_b") >= similarity * F.greatest("size_a", "size_b"))
        sized = sized.withColumn("apart", _odd_places("parity_a", "parity_b"))
        both = F.col("size_a") + F.col("size_b")
        # A millionth for the rounding of the product; the sets decide.
        bound = both - F.col("apart") >= similarity * (both + F.col("apart")) - 1e-6
        pairs = cut_lineage(sized.where(bound).select("a", "b"))  # used three times
        needed = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        # Equal texts share a node; any of them will do. The salt lets Spark split the join where one text has many rows.
        chosen = texts.join(needed, "node").withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(16)))
        chosen = chosen.groupBy("node", "salt").agg(F.first("text").alias("text"))
        chosen = chosen.groupBy("node").agg(F.first("text").alias("text"))
        sets = cut_lineage(chosen.select("node", shingle_set("text", words).alias("set")))
        one = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
        other = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
        both = pairs.join(one, "a").join(other, "b")
        shared = F.size(F.array_intersect("set_a", "set_b"))
        either = F.size("set_a") + F.size("set_b") - shared
        return both.where((either == 0) | (shared >= similarity * either)).select("a", "b")

    return verify


def sketch_nodes(sketches: DataFrame) -> DataFrame:
    """(node, fp, size, salt): a row for each one-bit sketch of a text."""
    return sketches.select("node", "size", F.posexplode("bits").alias("salt", "fp")).select("node", "fp", "size", "salt")


def _least_neighbours(sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) that follow one another under a key, in the order of the next key."""
    turned = F.concat(F.slice("keys", 2, KEYS - 1), F.slice("keys", 1, 1))
    zipped = F.explode(F.arrays_zip(F.col("keys").alias("key"), turned.alias("rest")))
    met = sketches.select("node", zipped.alias("k")).select("node", "k.key", "k.rest")
    before = F.lag("node").over(Window.partitionBy("key").orderBy("rest", "node"))
    met = met.select("node", before.alias("other")).where("other IS NOT NULL")
    return met.select(F.greatest("node", "other").alias("a"), F.least("node", "other").alias("b"))


def _least_pairs(placed: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of different components that share a key, from (node, comp, size, folded, keys).

    The bounds of ``similar`` are part of the condition, with the bitmap of ``PLACES`` places, so that it makes few rows.
    """
    keyed = placed.select("node", "comp", "size", F.explode("keys").alias("key"))
    mixed = keyed.groupBy("key").agg(F.min("comp").alias("first"), F.max("comp").alias("last")).where("first != last")
    keyed = keyed.join(mixed.select("key"), "key", "left_semi")
    keyed = cut_lineage(keyed.join(placed.select("node", "folded"), "node"))
    one, other = keyed.alias("u"), keyed.alias("v")
    both = F.col("u.size") + F.col("v.size")
    apart = sum(differing_bits(F.col("u.folded")[k], F.col("v.folded")[k]) for k in range(PLACES // 64))
    found = one.join(
        other,
        (F.col("u.key") == F.col("v.key"))
        & (F.col("u.comp") < F.col("v.comp"))
        & (F.least("u.size", "v.size") >= similarity * F.greatest("u.size", "v.size"))
        & (both - apart >= similarity * (both + apart) - 1e-6),
    )
    return found.select(F.greatest("u.node", "v.node").alias("a"), F.least("u.node", "v.node").alias("b"))


def near_texts(sketches: DataFrame, verify, similarity: float = SIMILARITY) -> DataFrame:
    """(node, comp) of the nodes that have links, from (node, size, folded, keys, bits): pairs that ``verify``, which filters
    pairs (a, b), lets through.

    Candidates share a Golay key of a one-bit sketch and differ there in at most ``MAX_BITS`` bits, or share one of
    ``least_keys``. Texts of similarity s differ in about 32 (1 - s) bits of a sketch, so the first finds nearly all pairs
    above 0.9 and a part of those nearer to 0.8; the second misses almost none. Neighbours under a key of either kind join most
    of every group first. All pairs under a key are then looked at, but only between different components.
    """
    nodes = cut_lineage(sketch_nodes(sketches))
    first = _least_neighbours(sketches).union(_neighbour_pairs(nodes.withColumn("comp", F.col("node")), 2, 0)).distinct()
    known = cut_lineage(components(cut_lineage(verify(first))))
    placed = cut_lineage(_in_components(sketches.select("node", "size", "folded", "keys"), known))
    others = key_pairs(_in_components(nodes, known), similarity).union(_least_pairs(placed, similarity)).distinct()
    last = cut_lineage(verify(others))
    return components(last.union(_stars(known)))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Documents link if the Jaccard similarity of their shingles of five words is 0.8 or more. Pairs are found by Golay keys of
    one-bit sketches of the shingles and, for what those do not reach, by ``least_keys``; all are compared whole. A text is known by its 64-bit hash. Nulls are empty texts. Links within groups that other links join
    already are not looked for.
    """
    ready(spark)
    node, comp, rank = fresh(docs, "node", "comp", "rank")
    key = F.xxhash64(F.coalesce("text", F.lit("")))
    texts = docs.select(key.alias("node"), F.coalesce("text", F.lit("")).alias("text"))
    prints = texts.select("node", shingle_sketch("text", WORDS).alias("s"))
    prints = cut_lineage(prints.groupBy("node").agg(F.first("s").alias("s")).select("node", "s.*"))
    found = cut_lineage(near_texts(prints, similar(texts, prints.select("node", "size", "parity"))))

    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"))
    placed = docs.select(key.alias("node"), order.alias("rank")).groupBy("node").agg(F.min("rank").alias("rank"))
    placed = placed.join(found, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    placed = cut_lineage(placed)
    kept = placed.groupBy("comp").agg(F.min(F.struct("rank", "node")).alias("kept")).select("kept.*")
    kept = cut_lineage(kept.select(F.col("node").alias(node), F.col("rank").alias(rank)))
    survivors = docs.join(kept, (key == F.col(node)) & order.eqNullSafe(F.col(rank)), "left_semi")
    # Repeated rows have the same id and text; one of them stays.
    return survivors.withColumn(node, key).dropDuplicates([node]).select(*docs.columns)


@query("op6_simhash")
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_components(table(spark, folder, "documents").select("doc_id", "text"))
