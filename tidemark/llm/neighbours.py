"""Nearest neighbours by inner product, with shifted space-filling curves.

Vectors get one more component that makes them equally long, so that the largest inner product is the nearest point. A
sample fixes a centre and projections; each curve is a Hilbert curve through the cells of one randomly turned and shifted
projection. Rows are numbered along every curve, by a distributed sort, and cut into blocks of equal size; rows of one key may
lie in several blocks. A query is compared with the rows of its own block and of the blocks next to it, on each curve; the
best of all are merged and ranked by the exact product. Queries that look at one block are dealt out in bounded chunks.

How many curves and how many blocks to either side are needed depends on the vectors, so it is measured: for a small set
of queries the true neighbours are found by comparing with every row, and the cheapest setting that finds the wanted
share of them is used. Vectors without structure need most blocks of one curve; no setting can help that.

Equal vectors are one point, kept with as many of its smallest ids as a result can need; so a vector that very many rows
share is compared once. Defined results: vectors that are null, zero, of another length than most, or have components
that are null or not finite take no part, neither do null ids. Repeated rows of one id count once. Ties go to the
smaller id. Empty tables give no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import numbered, query, ready, table
from tidemark.session import cut_lineage

CURVES, DIMENSIONS, CELL_BITS = 8, 8, 6
BLOCK_ROWS, SAMPLE_ROWS, TUNING_QUERIES = 4096, 8192, 128
#: Share of the true neighbours that tuning asks for; above the 0.9 promised, as it is measured on few queries.
WANTED = 0.96
SALTS = 16
#: Queries that are compared with a block at once.
QUERY_ROWS = 8192
#: Products of blocks of vectors may differ in the last digit from those added up one by one.
MARGIN = 8


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of points with whole coordinates below 2 ** bits (Skilling 2004), for all points at
    once. The product of dimensions and bits may be 62 at most."""
    x = cells.astype(np.int64).copy()
    n = x.shape[1]
    level = 1 << (bits - 1)
    while level > 1:
        mask = level - 1
        for k in range(n):
            high = (x[:, k] & level) > 0
            swap = np.where(high, 0, (x[:, 0] ^ x[:, k]) & mask)
            x[:, 0] = np.where(high, x[:, 0] ^ mask, x[:, 0] ^ swap)
            if k:
                x[:, k] ^= swap
        level >>= 1
    for k in range(1, n):
        x[:, k] ^= x[:, k - 1]
    turn = np.zeros(len(x), dtype=np.int64)
    level = 1 << (bits - 1)
    while level > 1:
        turn = np.where(x[:, n - 1] & level, turn ^ (level - 1), turn)
        level >>= 1
    x ^= turn[:, None]
    index = np.zeros(len(x), dtype=np.int64)
    for bit in range(bits - 1, -1, -1):
        for k in range(n):
            index = index << 1 | (x[:, k] >> bit & 1)
    return index


class Curves:
    """Projections of vectors of equal length, and the Hilbert keys of the projected points."""

    def __init__(self, sample: np.ndarray, longest: float, curves: int = CURVES, seed: int = 11):
        self.longest = longest
        full = self.lengthened(sample)
        self.centre = full.mean(axis=0)
        size = min(DIMENSIONS, full.shape[1])
        generator = np.random.default_rng(seed)
        spread = full - self.centre
        main = np.linalg.eigh(spread.T @ spread)[1].T[::-1]
        self.turns, self.lows, self.steps = [], [], []
        for curve in range(curves):
            # Main directions, taken in another order and turned for each curve.
            order = generator.permutation(len(main)) if curve else np.arange(len(main))
            turn = main[order[:size]].T @ np.linalg.qr(generator.normal(size=(size, size)))[0]
            points = (full - self.centre) @ turn
            low, high = np.quantile(points, [0.005, 0.995], axis=0)
            step = np.maximum(high - low, 1e-12) / ((1 << CELL_BITS) - 2)
            self.turns.append(turn)
            self.lows.append(low - generator.random(size) * step * (1 if curve else 0))
            self.steps.append(step)

    def lengthened(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.maximum(0.0, self.longest**2 - (vectors**2).sum(axis=1))
        return np.column_stack([vectors, np.sqrt(rest)])

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        """One column of keys for each curve."""
        full = self.lengthened(vectors) - self.centre
        columns = []
        for turn, low, step in zip(self.turns, self.lows, self.steps):
            cells = np.clip(np.floor((full @ turn - low) / step), 0, (1 << CELL_BITS) - 1)
            columns.append(hilbert_index(cells, CELL_BITS))
        return np.stack(columns, axis=1)


def points(embeddings: DataFrame, k: int) -> DataFrame:
    """(point, vector, ids): the different usable vectors, each with its k + 1 smallest ids."""
    usable = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = usable.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & sound & F.exists("v", lambda x: x != 0))
    usable = usable.where(F.size("v") == F.coalesce(_usual_size(usable), F.lit(0))).withColumn("point", F.xxhash64("v"))
    # Smallest ids first within salts, so that no task holds all rows of a common vector.
    salted = usable.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(SALTS))).dropDuplicates(["vec_id", "point"])
    first = F.row_number().over(Window.partitionBy("point", "salt").orderBy("vec_id"))
    few = salted.withColumn("n", first).where(F.col("n") <= k + 1)
    ids = F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1)
    return few.groupBy("point").agg(F.first("v").alias("v"), ids.alias("ids"))


def _usual_size(usable: DataFrame):
    found = usable.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), "size").limit(1).collect()
    return F.lit(found[0]["size"] if found else None).cast("int")


def _matrix(column) -> np.ndarray:
    return np.stack(column) if len(column) else np.empty((0, 0))


def best(queries: np.ndarray, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices and products of the k best rows of each query."""
    products = queries @ rows.T
    if products.shape[1] > k:
        chosen = np.argpartition(-products, k - 1, axis=1)[:, :k]
    else:
        chosen = np.broadcast_to(np.arange(products.shape[1]), products.shape)
    return chosen, np.take_along_axis(products, chosen, axis=1)


def nearest(embeddings: DataFrame, is_query, k: int = 20, wanted: float = WANTED) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found for every row that ``is_query`` (of vec_id) picks."""
    spark = ready(embeddings.sparkSession)
    rows = cut_lineage(points(embeddings, k))
    n = rows.count()
    nothing = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if n == 0:
        return nothing
    longest = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))).first()[0] ** 0.5
    sample = rows.orderBy("point").limit(SAMPLE_ROWS).select("v").toPandas()
    curves = spark.sparkContext.broadcast(Curves(_matrix(sample["v"]), longest))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = curves.value.keys(_matrix(batch.column(1).to_pandas())) if batch.num_rows else np.empty((0, CURVES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(list(found.astype(np.int64)), pa.list_(pa.int64()))], ["point", "keys"]
            )

    keyed = rows.select("point", "v").mapInArrow(place, "point long, keys array<long>")
    n_blocks = -(-n // BLOCK_ROWS)
    placed = cut_lineage(rows.join(blocks_of(keyed, BLOCK_ROWS), "point"))
    own = embeddings.select(F.col("vec_id").cast("bigint").alias("query_id"), F.col("embedding").cast("array<double>").alias("q"))
    own = own.where(is_query(F.col("query_id"))).withColumn("point", F.xxhash64("q")).select("query_id", "point").distinct()
    own = cut_lineage(own.join(rows.select("point"), "point", "left_semi"))
    asked = cut_lineage(placed.join(own.select("point").distinct(), "point", "left_semi"))

    used, reach = tuned(placed, asked, n_blocks, k, wanted)
    found = candidates(placed, asked, used, reach, n_blocks, k + 1)
    # The best points of all blocks, a few more than needed, ranked again by the product added up in one fixed order;
    # then all their ids in order of product and id, without the query's own.
    hits = found.groupBy("query", "point").agg(F.max("product").alias("product"))
    order = Window.partitionBy("query").orderBy(F.desc("product"), "point")
    hits = hits.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1 + MARGIN).select("query", "point")
    hits = hits.join(rows, "point").join(asked.select(F.col("point").alias("query"), F.col("v").alias("q")), "query")
    product = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0.0), lambda total, x: total + x)
    listed = hits.select("query", product.alias("product"), F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("product"), "vec_id")
    listed = listed.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n")
    answers = own.withColumnRenamed("point", "query").join(cut_lineage(listed), "query").where("vec_id != query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("product"), "vec_id")
    answers = answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return answers.select("query_id", "rank", "vec_id", F.col("product").alias("score"))


def blocks_of(keyed: DataFrame, block_rows: int) -> DataFrame:
    """(point, blocks): the block of each point on each curve, from (point, keys). A block has ``block_rows`` points, the last one
    fewer."""
    lines = keyed.select("point", F.posexplode("keys").alias("curve", "key"))
    block = F.floor(F.col("i") / block_rows).cast("int").alias("block")
    found = numbered(lines, "curve", ["key", "point"]).select("point", "curve", block)
    ordered = F.array_sort(F.collect_list(F.struct("curve", "block")))
    return found.groupBy("point").agg(F.transform(ordered, lambda one: one["block"]).alias("blocks"))


def tuned(placed: DataFrame, asked: DataFrame, n_blocks: int, k: int, wanted: float) -> tuple[int, int]:
    """(number of curves, blocks to either side) that find the wanted share at the least cost."""
    spark = placed.sparkSession
    chosen = asked.orderBy(F.xxhash64("point")).limit(TUNING_QUERIES).select("point", "v", "blocks").collect()
    if not chosen or n_blocks == 1:
        return 1, 0
    queries = spark.sparkContext.broadcast((np.array([row["v"] for row in chosen]), [row["point"] for row in chosen]))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, names = queries.value
        for batch in batches:
            if batch.num_rows:
                index, product = best(vectors, _matrix(batch.column(1).to_pandas()), k + 1)
                found = [[batch.column(2)[int(row)].as_py() for row in line] for line in index]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(names, index.shape[1]), pa.int64()),
                        batch.column(0).take(pa.array(index.ravel())),
                        pa.array(product.ravel()),
                        pa.array([blocks for line in found for blocks in line], pa.list_(pa.int32())),
                    ],
                    ["query", "point", "product", "blocks"],
                )

    seen = placed.select("point", "v", "blocks").mapInArrow(compare, "query long, point long, product double, blocks array<int>")
    order = Window.partitionBy("query").orderBy(F.desc("product"), "point")
    true = seen.where("query != point").withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).collect()
    home = {row["point"]: row["blocks"] for row in chosen}
    distance = np.array([np.abs(np.array(row["blocks"]) - home[row["query"]]) for row in true]).reshape(-1, CURVES)
    if not len(distance):
        return 1, 0
    options = []
    for used in range(1, CURVES + 1):
        needed = np.sort(distance[:, :used].min(axis=1))
        reach = int(needed[min(len(needed) - 1, int(np.ceil(wanted * len(needed))) - 1)])
        options.append((used * min(n_blocks, 2 * reach + 1), used, reach))
    _, used, reach = min(options)
    return used, reach


def candidates(
    placed: DataFrame, asked: DataFrame, used: int, reach: int, n_blocks: int, k: int, query_rows: int = QUERY_ROWS
) -> DataFrame:
    """(query, point, product): the best points for each query in each block it looks at.

    A block that more than ``query_rows`` queries look at is copied to as many chunks of queries, dealt out by hash.
    """
    rows = placed.select("point", "v", F.posexplode(F.slice("blocks", 1, used)).alias("curve", "block"))
    home = asked.select(F.col("point").alias("query"), F.col("v").alias("q"), F.posexplode(F.slice("blocks", 1, used)).alias("curve", "home"))
    near = F.sequence(F.greatest(F.lit(0), F.col("home") - reach), F.least(F.lit(n_blocks - 1), F.col("home") + reach))
    wanted = home.select("query", "q", "curve", F.explode(near).alias("block"))
    counted = wanted.groupBy("curve", "block").agg(F.ceil(F.count("*") / query_rows).cast("int").alias("chunks"))
    counted = cut_lineage(counted)
    chunk = F.pmod(F.xxhash64("query"), F.col("chunks")).cast("int").alias("chunk")
    wanted = wanted.join(counted, ["curve", "block"]).select("curve", "block", chunk, "query", "q")
    every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")
    rows = rows.join(counted, ["curve", "block"]).select("curve", "block", every, "point", "v")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        found = {"query": [], "point": [], "product": []}
        if len(left) and len(right):
            vectors, names = _vectors(right["v"]), right["point"].to_numpy()
            asked_for, asking = _vectors(left["q"]), left["query"].to_numpy()
            for start in range(0, len(left), 1024):
                index, product = best(asked_for[start : start + 1024], vectors, k)
                found["query"].append(np.repeat(asking[start : start + 1024], index.shape[1]))
                found["point"].append(names[index.ravel()])
                found["product"].append(product.ravel())
        kinds = {"query": pa.int64(), "point": pa.int64(), "product": pa.float64()}
        return pa.table({name: pa.array(np.concatenate(parts) if parts else [], kinds[name]) for name, parts in found.items()})

    by = ["curve", "block", "chunk"]
    return wanted.groupBy(*by).cogroup(rows.groupBy(*by)).applyInArrow(compare, "query long, point long, product double")


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows."""
    flat = column.combine_chunks()
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


@query("op5_neighbours")
def op5_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = table(ready(spark), folder, "embeddings").select("vec_id", "embedding")
    return nearest(embeddings, lambda vec_id: vec_id % 20 == 0)
