"""What the training-data operators share: the registry of their queries, tables, folds and bounded training samples."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import cut_lineage, prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Rows of one Arrow batch. Texts may be long, so batches are kept short.
BATCH_ROWS = 500


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL where SQL can say it."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def ready(spark: SparkSession) -> SparkSession:
    """Prepare a session. On a cluster the library is installed like any other; tasks of a local session find it here."""
    if spark.sparkContext.master.startswith("local["):
        paths = [path for path in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if path]
        if ROOT not in paths:
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, ROOT])
    prepare(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table by Spark's own readers, so that its folder may be in any store Spark knows."""
    return ready(spark).read.parquet(f"{folder}/{name}.parquet")


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(parts))


def in_fold(doc_id: Column | str, parts: int, remainder: int) -> Column:
    """False for a null id."""
    return F.coalesce(fold(doc_id, parts) == remainder, F.lit(False))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names that no column of ``df`` has, in any case, made from ``names``."""
    taken = {column.lower() for column in df.columns}
    made = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        made.append(name)
    return made


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, rows: int, keep: Column | None = None
) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled ids, chosen by hash of the id; written to the shared folder.

    ``keep`` restricts the ids that may be learnt from. An id with several labels has the largest, and one with several rows
    the largest text. Only the ids, whose bound is ``rows``, are broadcast; the texts are found by one scan of the documents.
    """
    ids = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).dropna()
    ready(documents.sparkSession)
    if keep is not None:
        ids = ids.where(keep)
    ids = ids.groupBy("doc_id").agg(F.max("label").alias("label"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.join(F.broadcast(ids), "doc_id").groupBy("doc_id", "label").agg(F.max("text").alias("text"))
    return cut_lineage(found.select("doc_id", "text", "label"))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``i``, their place in their group in order, from 0, and ``n``, the size of the group. The group is not null.

    Rows are dealt out by ranges of (group, order); the place within a task is its running number, and the counts of
    the tasks before, one row for each task and group, are added. So a group that holds most rows is spread over many tasks.
    Rows alike in all of these are dealt out by where they were read, and their order is open.
    """
    given = cut_lineage(rows).withColumn("_source_row", F.monotonically_increasing_id())  # the sort samples it first
    by = [group, *order, "_source_row"]
    dealt = given.repartitionByRange(*by).sortWithinPartitions(*by)
    # The number of the task in the upper bits, that of the row in the lower ones.
    placed = cut_lineage(dealt.select(*rows.columns, F.monotonically_increasing_id().alias("_at")))
    placed = placed.withColumn("_task", F.shiftright("_at", 33))
    counted = placed.groupBy(group, "_task").agg(F.count("*").alias("_held"), F.min("_at").alias("_first"))
    # One row for each task of a group, whatever the number of rows.
    whole = Window.partitionBy(group)
    before = F.sum("_held").over(whole.orderBy("_task")) - F.col("_held")
    offsets = counted.select(group, "_task", "_first", before.alias("_before"), F.sum("_held").over(whole).alias("n"))
    joined = placed.join(offsets, [group, "_task"])
    return joined.select(*rows.columns, (F.col("_at") - F.col("_first") + F.col("_before")).alias("i"), "n")
