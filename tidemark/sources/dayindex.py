"""An index of the day folders of a store, so that a window is opened by exact paths, whatever the length of the history.

Beside the data, ``<base>/_index/month=YYYY-MM/`` holds small Parquet tables: the folder of a key and day, its date, the
columns its rows were saved with and the time of saving. A save appends to the months it touches *before* it replaces data;
so the index may name a folder that never came to be, after a job that died, but never lacks one. The latest entry of a folder
counts. A month of many entries is compacted by the save that finds it so. An index that is missing, or names a folder
that is not there, is rebuilt by one listing of everything. Folders written by other means need ``rebuild``.
"""

from __future__ import annotations

import datetime as dt
import json
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import cut_lineage, prepare

DATE = "date"
FOLDER = "_index"
MONTH = "month"
SCHEMA = "folder string, date date, columns string, saved timestamp"
#: Files of entries of a month beyond which it is compacted.
MOST_FILES = 64

# Characters that Spark writes as % and two digits in names of folders, and its name for null and empty.
ESCAPED = '"#%\'*/:=?\\{[]^\x7f' + "".join(map(chr, range(1, 32)))
NOTHING = "__HIVE_DEFAULT_PARTITION__"


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Spark sees them."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def child_names(spark: SparkSession, path: str) -> list[str] | None:
    """Names in one folder, by one listing; None if there is no such folder."""
    files, found = _files(spark, path)
    if not files.exists(found):
        return None
    return sorted(status.getPath().getName() for status in files.listStatus(found))


def exists(spark: SparkSession, path: str) -> bool:
    files, found = _files(spark, path)
    return files.exists(found)


def escaped(text: Column) -> Column:
    """A value as Spark writes it in the name of a folder."""
    ordered = ["%", *(c for c in ESCAPED if c != "%")]
    found = reduce(lambda done, c: F.replace(done, F.lit(c), F.lit(f"%{ord(c):02X}")), ordered, text)
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(NOTHING)).otherwise(found)


def folder(keys: list[str], date: Column) -> Column:
    """``key=value/.../date=YYYY-MM-DD`` of a row, from its text keys."""
    parts = [F.concat(F.lit(f"{key}="), escaped(F.col(key).cast("string"))) for key in keys]
    return F.concat_ws("/", *parts, F.concat(F.lit(f"{DATE}="), date.cast("string")))


def touched_folders(df: DataFrame, keys: list[str], time: str) -> DataFrame:
    """(folder, date) of the rows of ``df``; rows without a time have no day."""
    days = df.where(F.col(time).isNotNull()).select(*keys, F.to_date(time).alias(DATE)).distinct()
    return days.select(folder(keys, F.col(DATE)).alias("folder"), DATE)


def months(first: dt.date, last: dt.date) -> list[str]:
    return [f"{k // 12:04}-{k % 12 + 1:02}" for k in range(first.year * 12 + first.month - 1, last.year * 12 + last.month)]


def _month_path(base: str, month: str) -> str:
    return f"{base.rstrip('/')}/{FOLDER}/{MONTH}={month}"


def _entries(spark: SparkSession, base: str, wanted: list[str]) -> DataFrame:
    """The entries of some months, the latest of each folder. Only the folders of these months are listed."""
    there = set(child_names(spark, f"{base.rstrip('/')}/{FOLDER}") or [])
    paths = [_month_path(base, month) for month in wanted if f"{MONTH}={month}" in there]
    reader = prepare(spark).read.schema(SCHEMA)
    found = reader.parquet(*paths) if paths else spark.createDataFrame([], SCHEMA)
    return found.groupBy("folder", DATE).agg(F.max_by("columns", "saved").alias("columns"), F.max("saved").alias("saved"))


def ensure(spark: SparkSession, base: str, levels: int) -> bool:
    """Whether anything is stored. An index that is missing is rebuilt first."""
    names = child_names(spark, base)
    if names is not None and FOLDER not in names and any(name[:1] not in "_." for name in names):
        rebuild(spark, base, levels)
        return True
    return bool(names) and FOLDER in names


def between(spark: SparkSession, base: str, first: dt.date, last: dt.date) -> DataFrame:
    """The entries of the days from ``first`` to ``last``."""
    return _entries(spark, base, months(first, last)).where(F.col(DATE).between(F.lit(first), F.lit(last)))


def of_folders(spark: SparkSession, base: str, touched: DataFrame) -> DataFrame:
    """The entries of some folders (folder, date)."""
    wanted = [row[0] for row in touched.select(F.date_format(DATE, "yyyy-MM")).distinct().collect()]
    return _entries(spark, base, sorted(wanted)).join(touched.select("folder"), "folder", "left_semi")


def add(touched: DataFrame, base: str, columns: T.StructType) -> None:
    """Enter folders (folder, date) that are about to be written with these columns. Months between the first and the last of
    them that have many files are compacted."""
    spark = touched.sparkSession
    entries = touched.select(
        "folder", DATE, F.lit(json.dumps(columns.jsonValue())).alias("columns"), F.current_timestamp().alias("saved")
    )
    first, last = touched.agg(F.min(DATE), F.max(DATE)).first()
    if first is None:
        return
    _write(entries, base, "append")
    index = f"{base.rstrip('/')}/{FOLDER}"
    there = set(child_names(spark, index) or [])
    near = [month for month in months(first, last) if f"{MONTH}={month}" in there]
    long = [month for month in near if len(child_names(spark, f"{index}/{MONTH}={month}") or []) > MOST_FILES]
    if long:
        _write(cut_lineage(_entries(spark, base, long)), base, "overwrite")


def _write(entries: DataFrame, base: str, mode: str) -> None:
    monthly = entries.select("folder", DATE, "columns", "saved", F.date_format(DATE, "yyyy-MM").alias(MONTH))
    writer = monthly.repartition(MONTH).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(MONTH)
    writer.parquet(f"{base.rstrip('/')}/{FOLDER}")


def rebuild(spark: SparkSession, base: str, levels: int) -> None:
    """Make the index anew from all that is stored, by one listing of everything. Columns are then found when files are read."""
    everything = prepare(spark).read.option("basePath", base).parquet(base)
    names = everything.columns[len(everything.columns) - levels - 1 :]
    stored = everything.select(*names).distinct().where(F.col(names[-1]).isNotNull())
    date = F.col(names[-1]).cast("date")
    entries = stored.select(folder(names[:-1], date).alias("folder"), date.alias(DATE))
    entries = cut_lineage(entries.select("*", F.lit(None).cast("string").alias("columns"), F.current_timestamp().alias("saved")))
    files, found = _files(spark, f"{base.rstrip('/')}/{FOLDER}")
    files.delete(found, True)
    _write(entries, base, "overwrite")


def merged_schema(found: list[str | None]) -> T.StructType | None:
    """All columns that rows were saved with, by name; None if that is not known or they disagree."""
    fields: dict[str, T.StructField] = {}
    for text in found:
        if text is None:
            return None
        for field in T.StructType.fromJson(json.loads(text)):
            if fields.setdefault(field.name, field).dataType != field.dataType:
                return None
    return T.StructType([T.StructField(name, field.dataType) for name, field in fields.items()]) if fields else None


def open_folders(spark: SparkSession, base: str, entries: DataFrame, levels: int, merge_schema: bool) -> DataFrame | None:
    """The rows of the folders of some entries, opened by exact paths; None if there are none.

    With the columns known from the index no file is opened to find them. Where a folder is not there, the index is made
    anew and the folders that are there are opened.
    """
    # One row for each folder to open; the columns of a store rarely change, so they are fetched once each.
    folders = sorted(row["folder"] for row in entries.select("folder").collect())
    if not folders:
        return None
    saved = entries.groupBy("columns").agg(F.min("saved").alias("saved")).orderBy("saved").collect() if merge_schema else []
    try:
        return _paths(spark, base, folders, merged_schema([row["columns"] for row in saved]), merge_schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    rebuild(spark, base, levels)
    there = [name for name in folders if exists(spark, f"{base.rstrip('/')}/{name}")]
    return _paths(spark, base, there, None, merge_schema) if there else None


def _paths(spark: SparkSession, base: str, folders: list[str], schema: T.StructType | None, merge_schema: bool) -> DataFrame:
    reader = prepare(spark).read.option("basePath", base)
    reader = reader.option("mergeSchema", str(merge_schema).lower()) if schema is None else reader.schema(schema)
    return reader.parquet(*(f"{base.rstrip('/')}/{name}" for name in folders))
