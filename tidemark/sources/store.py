"""Series stored as parquet in one folder per day: ``<base>/<key>=.../date=YYYY-MM-DD/``, with an index of these folders."""

from __future__ import annotations

import datetime as dt

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.align import upsert
from tidemark.session import cut_lineage, prepare
from tidemark.sources import dayindex
from tidemark.sources.dayindex import DATE
from tidemark.spec import SeriesSpec

#: Conditions of an error that mean that nothing is stored; an empty folder has no schema.
NOTHING_STORED = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
Day = dt.date | str


def read_days(
    spark: SparkSession,
    base: str,
    start: Day | None = None,
    end: Day | None = None,
    columns: list[str] | None = None,
    merge_schema: bool = True,
    schema: T.StructType | None = None,
    levels: int = 1,
) -> DataFrame:
    """Rows of the days from ``start`` to ``end``, both inclusive. With both given, the folders of those days are found in the
    index and opened by their paths; nothing else is listed, whatever the history. ``levels`` is the number of key folders above a day.

    Files may differ in columns: they are merged by name. Wanted columns that no file has are left out. With ``schema``
    given, nothing stored yet reads as no rows. Keys read as text, whatever they look like.
    """
    if start is not None and end is not None:
        stored = None
        if dayindex.ensure(spark, base, levels):
            entries = dayindex.between(spark, base, _day(start), _day(end))
            stored = _dated(dayindex.open_folders(spark, base, entries, levels, merge_schema))
    else:
        stored = _read(spark, base, merge_schema)
    if stored is None:
        if schema is None:
            return _read(spark, base, False, must_exist=True).where(F.lit(False))
        return spark.createDataFrame([], schema)
    if start is not None:
        stored = stored.where(F.col(DATE) >= F.lit(_day(start)))
    if end is not None:
        stored = stored.where(F.col(DATE) <= F.lit(_day(end)))
    return stored if columns is None else select_existing(stored, columns)


def _day(day: Day) -> dt.date:
    return dt.date.fromisoformat(str(day)[:10])


def _dated(stored: DataFrame | None) -> DataFrame | None:
    if stored is None or DATE not in stored.columns:
        return stored
    return stored.withColumn(DATE, F.col(DATE).cast("date"))


def _read(spark: SparkSession, base: str, merge_schema: bool, must_exist: bool = False) -> DataFrame | None:
    """All stored rows; None if there are none. Any other failure is raised."""
    reader = prepare(spark).read.option("mergeSchema", str(merge_schema).lower()).option("basePath", base)
    try:
        return _dated(reader.parquet(base))
    except AnalysisException as error:
        if must_exist or error.getCondition() not in NOTHING_STORED:
            raise
        return None


def select_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """Select the columns that exist; the others are left out rather than failing."""
    return df.select(*(name for name in columns if name in df.columns))


def within_window(df: DataFrame, time: str, start: Day, end: Day) -> DataFrame:
    """Rows of the days asked for. Reading takes in a day more either side, to complete buckets at the edges."""
    day = F.to_date(time)
    return df.where(day.between(F.lit(str(start)[:10]).cast("date"), F.lit(str(end)[:10]).cast("date")))


def widened(start: dt.date, end: dt.date, days: int = 1) -> tuple[dt.date, dt.date]:
    """The window to read, so that buckets at the edges of the window asked for are complete."""
    return start - dt.timedelta(days=days), end + dt.timedelta(days=days)


def write_days(
    df: DataFrame, base: str, spec: SeriesSpec, partition_by: list[str] | None = None, touched: DataFrame | None = None
) -> None:
    """Write one folder per key and day, replacing those days and no others, and enter them in the index.

    Rows are brought together by key and day, so a folder gets one file. Spark evens out the tasks: small groups share
    one, and a group far larger than the others is split over several, and then gets several files. ``touched``: the
    folders that the rows fall in (folder, date), if known; else the rows are written to the shared folder to find them.
    """
    keys = list(partition_by if partition_by is not None else spec.keys)
    folders = [*keys, DATE]
    if touched is None:
        df = cut_lineage(df)
        touched = dayindex.touched_folders(df, keys, spec.time)
    fields = [field for field in df.schema if field.name not in folders]
    # First, so that the index never lacks a folder.
    dayindex.add(touched, base, T.StructType(fields))
    dated = df.withColumn(DATE, F.to_date(spec.time))
    (
        dated.hint("rebalance", *folders)
        .sortWithinPartitions(*folders, spec.time)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*folders)
        .parquet(base)
    )


def upsert_days(df: DataFrame, base: str, spec: SeriesSpec) -> None:
    """Merge rows into the stored days they touch. New rows win, nulls included; other rows and columns are kept.

    Only the folders of the touched keys and days are opened and written again. Spark swaps the folders in when the job
    commits, so a task may be lost and run again meanwhile. The new rows are written to the shared folder first, so
    their plan runs once and before anything is replaced.
    """
    spark, keys = df.sparkSession, list(spec.keys)
    new = cut_lineage(df)
    touched = cut_lineage(dayindex.touched_folders(new, keys, spec.time))
    stored = None
    if dayindex.ensure(spark, base, len(keys)):
        entries = dayindex.of_folders(spark, base, touched)
        stored = dayindex.open_folders(spark, base, entries, len(keys), True)
    if stored is None:
        write_days(new, base, spec, touched=touched)
        return
    typed = stored.withColumns({key: F.col(key).cast(df.schema[key].dataType) for key in keys}).drop(DATE)
    write_days(upsert(typed, new, spec.id_columns), base, spec, touched=touched)


def counted(df: DataFrame, name: str, values: list[str]) -> tuple[DataFrame, Observation]:
    """``df`` and what the job that reads it will have seen: its ``rows``, and the values of each column of ``values``."""
    seen = Observation(name)
    counts = [F.count_if(F.col(value).isNotNull()).alias(value) for value in values]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *counts), seen


def counts_of(seen: Observation, values: list[str]) -> dict[str, int]:
    """What a job has seen; nothing where Spark knew beforehand that there are no rows, and ran none."""
    try:
        return seen.get
    except Py4JJavaError:
        return dict.fromkeys(["rows", *values], 0)


def run_report(df: DataFrame, spec: SeriesSpec, core_flag: str | None = None, removed_bit: int = 8) -> DataFrame:
    """Per series: rows, values, missing values and removed values."""
    value = F.col(spec.value)
    removed = F.lit(False) if core_flag is None else F.col(core_flag).bitwiseAND(F.lit(removed_bit)) != 0
    return df.groupBy(*spec.keys).agg(
        F.count("*").alias("rows"),
        F.count_if(value.isNotNull()).alias("values"),
        F.count_if(value.isNull()).alias("missing"),
        F.count_if(removed).alias("removed"),
    )


def raw_file_manifest(
    spark: SparkSession, base: str, start: Day, end: Day, pattern: str = "*"
) -> DataFrame:
    """The raw files of the days asked for: path, size, time of change and day. Contents are not read.

    Each day is looked up by its name; days without a folder have no files. What else is stored is not listed.
    """
    first, last = _day(start), _day(end)
    days = [first + dt.timedelta(days=k) for k in range((last - first).days + 1)]
    paths = [f"{base.rstrip('/')}/{DATE}={day.isoformat()}" for day in days]
    paths = [path for path in paths if dayindex.exists(spark, path)]
    if not paths:
        schema = "path string, length long, modificationTime timestamp, date date"
        return spark.createDataFrame([], schema)
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("basePath", base).load(paths)
    return files.select("path", "length", "modificationTime", F.col(DATE).cast("date").alias(DATE))
