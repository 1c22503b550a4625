"""Which dataset depends on which. Edges are rows (dataset, depends_on, load_only).

Walks go by frontier: the edges are written once to the shared folder, in parts by a hash of the end that a walk comes from,
and a round opens only the parts that hold nodes of its frontier. Layers are counted down as by Kahn: an edge is
used once, when what it depends on is placed, and raises the count of its dataset, which is placed when the count
is complete. Datasets that nothing depends on, often most of them, stay out of these rounds: their layers follow from
the others by one join. What a round found is written, so plans stay short and a lost executor does not lose the walk.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage, new_table_path

#: Parts of the edges at most; the parts of a frontier are brought to the driver.
MOST_PARTS = 1024


def dependency_edges(references: DataFrame) -> DataFrame:
    """Edges from the references of plan steps (dataset, parameter, depends_on). Every reference is an edge; those made
    only by ``load_dep_ts`` are load-only."""
    return references.groupBy("dataset", "depends_on").agg(
        F.min(F.col("parameter") == "load_dep_ts").alias("load_only")
    )


# --- Edges in parts ----------------------------------------------------------------------------------------------


def _parts(df: DataFrame) -> int:
    return min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_PARTS)


def _part(node: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(node), F.lit(parts)).cast("int")


def _in_parts(edges: DataFrame, start: str) -> DataFrame:
    """The edges as a table in the shared folder, one folder for each part of the nodes ``start``."""
    parts = _parts(edges)
    placed = edges.withColumn("part", _part(start, parts))
    path = new_table_path(edges.sparkSession, "edges")
    # A node that very many edges leave is one part; it is split over tasks, and into files.
    placed.hint("rebalance", "part").write.partitionBy("part").parquet(path)
    return edges.sparkSession.read.schema(placed.schema).parquet(path)


def _frontier(df: DataFrame, parts: int) -> tuple[DataFrame, list[int], int]:
    """A written frontier, its parts and its size, by one job."""
    counted = df.groupBy(_part("dataset", parts).alias("part")).count().collect()
    return df, [row["part"] for row in counted], sum(row["count"] for row in counted)


# --- Walks -------------------------------------------------------------------------------------------------------


def reachable(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """All datasets reached from ``roots`` (dataset) along the edges, roots included."""
    return _walk(_in_parts(edges.select("dataset", "depends_on"), "dataset"), roots)


def _walk(step: DataFrame, roots: DataFrame) -> DataFrame:
    parts = _parts(step)
    reached = None
    found = roots.select("dataset").distinct()
    while True:
        frontier, places, size = _frontier(cut_lineage(found), parts)
        reached = frontier if reached is None else reached.unionByName(frontier)
        if not size:
            return reached
        leaving = step.where(F.col("part").isin(places)).join(frontier, "dataset")
        found = leaving.select(F.col("depends_on").alias("dataset")).distinct().join(reached, "dataset", "left_anti")


def dependency_closure(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Everything the roots need: (dataset, load_only). What a load-only edge leads to is loaded but not followed; being
    needed in full by anything that is followed wins."""
    edges = _in_parts(edges.select("dataset", "depends_on", "load_only"), "dataset")
    full = _walk(edges.where("not load_only"), roots)
    loaded = (
        edges.where("load_only")
        .join(full, "dataset", "left_semi")
        .select(F.col("depends_on").alias("dataset"))
        .distinct()
        .join(full, "dataset", "left_anti")
    )
    return full.withColumn("load_only", F.lit(False)).unionByName(loaded.withColumn("load_only", F.lit(True)))


def failed_with_descendants(edges: DataFrame, failed: DataFrame) -> DataFrame:
    """Datasets that fail because they, or something they depend on, failed."""
    reverse = edges.select(F.col("depends_on").alias("dataset"), F.col("dataset").alias("depends_on"))
    return reachable(reverse, failed)


# --- Layers ------------------------------------------------------------------------------------------------------


def layers(edges: DataFrame, references: DataFrame | None = None) -> DataFrame:
    """(dataset, layer): a dataset's dependencies are all in lower layers. A cycle raises. An edge that is there twice is needed
    and met twice.

    Rounds place the datasets that others depend on. All others are placed at once, one above the highest of what they
    depend on. ``references`` are the rows the edges were made of, which name what is depended on without making the edges.
    """
    parts = _parts(edges)
    named = (edges if references is None else references).select(F.col("depends_on").alias("dataset"))
    needed = cut_lineage(named.distinct())
    # Nodes are hashed, not edges sorted: a node is one row here, its edges may be very many.
    is_needed = needed.where("dataset is not null").withColumn("needed", F.lit(True)).hint("shuffle_hash")
    edges = cut_lineage(edges.select("dataset", "depends_on").join(is_needed, "dataset", "left"))
    unnamed = edges.where("dataset is null or depends_on is null").select("dataset").limit(5).collect()
    if unnamed:
        raise _stuck(unnamed)
    step = _in_parts(edges.where("needed").select("dataset", "depends_on"), "depends_on")
    needs = cut_lineage(step.groupBy("dataset").agg(F.count("*").alias("needs")))
    left = needs.count()
    frontier, places, size = _frontier(cut_lineage(needed.join(needs, "dataset", "left_anti")), parts)
    placed, waiting = [frontier.withColumn("layer", F.lit(0))], None
    while size and left:
        used = step.where(F.col("part").isin(places)).join(frontier.withColumnRenamed("dataset", "depends_on"), "depends_on")
        met = used.groupBy("dataset").agg(F.count("*").alias("met"))
        if waiting is not None:
            met = met.unionByName(waiting).groupBy("dataset").agg(F.sum("met").alias("met"))
        # Few datasets were met and are not complete; only these are written again.
        met = cut_lineage(met.join(needs, "dataset"))
        waiting = met.where("met < needs").select("dataset", "met")
        frontier, places, size = _frontier(met.where("met = needs").select("dataset"), parts)
        left -= size
        placed.append(frontier.withColumn("layer", F.lit(len(placed))))
    inner = reduce(DataFrame.unionByName, placed)
    if left:
        raise _stuck(needs.join(inner, "dataset", "left_anti").limit(5).collect())
    by_need = inner.withColumnRenamed("dataset", "depends_on").hint("shuffle_hash")
    below = edges.where("needed is null").join(by_need, "depends_on")
    return inner.unionByName(below.groupBy("dataset").agg((F.max("layer") + 1).alias("layer")))


def _stuck(rows: list) -> ValueError:
    return ValueError(f"The dependency graph has a cycle, among or below: {[row['dataset'] for row in rows]}")


def plan_order(steps: DataFrame) -> DataFrame:
    """Position of each step in its dataset's plan, from rows (dataset, index, configuration)."""
    by_index = Window.partitionBy("dataset").orderBy("index")
    return steps.withColumn("position", F.row_number().over(by_index))


def duplicate_plan_indices(steps: DataFrame) -> DataFrame:
    """Indices used by more than one step of a plan, which leave the order open."""
    return steps.groupBy("dataset", "index").agg(F.count("*").alias("n")).where("n > 1")


def check_plan_indices(steps: DataFrame) -> None:
    bad = duplicate_plan_indices(steps).limit(1).collect()
    if bad:
        raise ValueError(f"Plan of {bad[0]['dataset']} uses index {bad[0]['index']} more than once")
