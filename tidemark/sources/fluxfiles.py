"""Delimited flux output: a row of column names, a row of units, then data; perhaps a row of group names first.

Files differ in their columns. Lines are parsed by Spark's CSV parser, with as many columns as the widest header has, joined
to the column names of their own file, and become a map from name to cell; columns are then picked by name. Headers are looked for
at the start of files only. Files may lie in key folders such as ``site=A``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.align import keep_first

# Cells that mean no value, and the format of date and time together.
NULL_CELLS = ("NA", "NAN", "NaN", "-9999", "")
TIME_FORMAT = "yyyy-MM-dd HH:mm"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"


#: Quoted cells may hold commas, and quotes that are doubled.
CSV = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true", "mode": "PERMISSIVE"}


def _cells(line: Column, width: int) -> Column:
    """The first ``width`` cells of a line; those it does not have are null."""
    parsed = F.from_csv(line, ", ".join(f"c{k} string" for k in range(width)), CSV)
    return F.array(*(F.trim(parsed[f"c{k}"]) for k in range(width)))


def _unique_names(names: Column) -> Column:
    """Second and later uses of a name get ``_1``, ``_2`` and so on."""

    def numbered(name: Column, position: Column) -> Column:
        earlier = F.size(F.filter(F.slice(names, 1, position), lambda other: other == name))
        return F.when(earlier == 0, name).otherwise(F.concat(name, F.lit("_"), earlier.cast("string")))

    return F.transform(names, numbered)


def read_lines(spark: SparkSession, base: str, pattern: str = "*") -> DataFrame:
    """Lines of all matching files as cells, with their file and their order in it."""
    lines = spark.read.option("pathGlobFilter", pattern).text(base)
    lines = lines.select(
        *(name for name in lines.columns if name != "value"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_offset"),
        F.monotonically_increasing_id().alias("_line"),
        "value",
    )
    # A header names date and time, and has no more cells than commas and one.
    heads = lines.where((F.col("_offset") == 0) & F.col("value").contains("date") & F.col("value").contains("time"))
    width = heads.agg(F.max(F.size(F.split("value", ",")))).first()[0] or 1
    return lines.withColumn("_cells", _cells(F.col("value"), width)).drop("value")


def column_names(lines: DataFrame) -> DataFrame:
    """The column names of each file: the first line that names both a date and a time column."""
    named = lines.where((F.col("_offset") == 0) & F.array_contains("_cells", "date") & F.array_contains("_cells", "time"))
    # Cells beyond the end of a shorter header.
    named = named.withColumn("_cells", F.filter("_cells", lambda cell: cell.isNotNull()))
    first = named.groupBy("_file").agg(F.min_by("_cells", F.struct("_offset", "_line")).alias("_names"))
    return first.select("_file", _unique_names(F.col("_names")).alias("_names"))


def all_names(names: DataFrame) -> list[str]:
    """Every column name in any file. This is the schema, not data, so it may come to the driver."""
    found = names.select(F.explode("_names").alias("name")).distinct().where("name not in ('date', 'time')")
    return sorted(row["name"] for row in found.collect())


def read_flux_files(
    spark: SparkSession,
    base: str,
    pattern: str = "*",
    numbers: list[str] | None = None,
    texts: tuple[str, ...] = ("filename",),
) -> DataFrame:
    """Rows with their DateTime and columns. Cells that are no number read as null, as do the null marks.

    ``numbers`` limits which columns are read; by default all that occur are, and a file without one gives null.
    """
    lines = read_lines(spark, base, pattern)
    names = column_names(lines)
    keys = [name for name in lines.columns if not name.startswith("_")]
    wanted = numbers if numbers is not None else [name for name in all_names(names) if name not in texts]
    # Rows shorter or longer than the header are cut or filled, so that the map can be built.
    width = F.size("_names")
    sized = F.transform(F.sequence(F.lit(0), width - 1), lambda i: F.get("_cells", i))
    cells = F.map_from_arrays("_names", sized)
    rows = lines.join(names, "_file").withColumn("_map", cells)
    rows = rows.where(F.col("_map")["date"].rlike(DATE_PATTERN))

    def cell(name: str) -> Column:
        text = F.element_at("_map", F.lit(name))
        return F.when(~text.isin(*NULL_CELLS), text)

    written = F.concat_ws(" ", F.col("_map")["date"], F.col("_map")["time"])
    return rows.select(
        *keys,
        F.try_to_timestamp(written, F.lit(TIME_FORMAT)).cast("timestamp_ntz").alias("DateTime"),
        *(cell(name).alias(name) for name in texts if numbers is None),
        *(cell(name).try_cast("double").alias(name) for name in wanted),
        "_file",
        "_offset",
        "_line",
    )


def flux_bundle(
    full: DataFrame, quality: DataFrame | None, biomet: DataFrame | None, keys: list[str]
) -> DataFrame:
    """One row per key and time from the three kinds of file.

    The first row of a time is kept. Quality columns (``qc_*``) and those meteorological columns the full output does not
    have are joined on. Fluxes are labelled at the end of their half hour, so times move back to its start.
    """
    ids = [*keys, "DateTime"]
    order = ["_file", "_offset", "_line"]
    bundle = keep_first(full, ids, order).drop(*order)
    if quality is not None:
        flags = [name for name in quality.columns if name.startswith("qc_")]
        # A quality column also in the full output keeps both: the joined one is marked.
        renamed = [F.col(name).alias(f"{name}_right" if name in bundle.columns else name) for name in flags]
        bundle = bundle.join(keep_first(quality, ids, order).select(*ids, *renamed), ids, "left")
    if biomet is not None:
        more = [name for name in biomet.columns if name not in bundle.columns and name not in order]
        bundle = bundle.join(keep_first(biomet, ids, order).select(*ids, *more), ids, "left")
    earlier = F.col("DateTime") - F.expr("INTERVAL 30 MINUTES")
    return bundle.withColumn("time", earlier.cast("timestamp_ntz")).drop("DateTime")
