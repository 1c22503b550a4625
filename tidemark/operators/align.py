"""Padding, joins on time, interval joins and merging."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import TimeLike, at, floor_div, from_micros, micros, slot, slot_start
from tidemark.operators.chunks import CHUNK_SLOTS
from tidemark.session import cut_lineage
from tidemark.spec import SeriesSpec, check_same_cadence


# --- Padding -----------------------------------------------------------------------------------------------------


def time_grid(bounds: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Every time from ``first_time`` to ``last_time`` of each row of ``bounds``, one period apart.

    The grid is made in two steps, blocks of slots and then the slots of each block, with the blocks spread over the
    cluster in between. So neither one long series nor a few series end up in one task. The number of partitions is
    given because the blocks are tiny when shuffled and large afterwards.
    """
    period = spec.period
    # Grids need not start on a whole period since 1970: keep the offset of the first time.
    offset = F.lit(0) if period.is_calendar else F.pmod(micros("first_time"), F.lit(period.micros))
    spark = bounds.sparkSession
    partitions = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    low, high, block = F.col("_low"), F.col("_high"), F.col("_block")
    blocks = (
        bounds.where("first_time <= last_time")
        .select(
            *spec.keys,
            offset.alias("_offset"),
            slot("first_time", period).alias("_low"),
            slot("last_time", period).alias("_high"),
        )
        .withColumn("_block", F.explode(F.sequence(floor_div(low, CHUNK_SLOTS), floor_div(high, CHUNK_SLOTS))))
        .repartition(partitions, *spec.keys, "_block")
    )
    slots = F.sequence(F.greatest(low, block * CHUNK_SLOTS), F.least(high, (block + 1) * CHUNK_SLOTS - 1))
    start = slot_start(F.col("_at"), period)
    time = start if period.is_calendar else from_micros(micros(start) + F.col("_offset"))
    return blocks.withColumn("_at", F.explode(slots)).select(*spec.keys, time.alias(spec.time))


def _off_grid(spec: SeriesSpec, where: Column | None = None) -> Column:
    """An aggregate over the rows of a series: does any, of those that count, not lie on the grid that its first time starts?"""
    if spec.period.is_calendar:
        off = slot_start(slot(spec.time, spec.period), spec.period) != F.col(spec.time)
        return F.coalesce(F.bool_or(off if where is None else off & where), F.lit(False))
    place = F.pmod(micros(spec.time), F.lit(spec.period.micros))
    counted = place if where is None else F.when(where, place)
    start = F.pmod(F.min(micros(spec.time)), F.lit(spec.period.micros))
    return F.coalesce((F.min(counted) != start) | (F.max(counted) != start), F.lit(False))


def pad(df: DataFrame, spec: SeriesSpec, bounds: DataFrame | None = None) -> DataFrame:
    """Put each series on its regular grid from its first to its last time; new rows hold nulls.

    ``bounds`` (keys, first_time, last_time) can be given where it is cheaper to get than from ``df``. The join is on
    keys and time, so a long series is spread over all tasks. Rows off the grid would be lost: the job then fails, unless
    bounds were given.
    """
    if bounds is None:
        lost = F.raise_error(F.concat(F.lit("Rows off the grid of series "), F.to_json(F.struct(*spec.keys))))
        first = F.when(F.col("_off"), lost.cast("timestamp_ntz")).otherwise(F.col("first_time"))
        bounds = df.groupBy(*spec.keys).agg(
            F.min(spec.time).alias("first_time"), F.max(spec.time).alias("last_time"), _off_grid(spec).alias("_off")
        )
        bounds = bounds.select(*spec.keys, first.alias("first_time"), "last_time")
    return time_grid(bounds, spec).join(df, spec.id_columns, "left").select(*df.columns)


def pad_together(df: DataFrame, spec: SeriesSpec, values: list[str]) -> tuple[DataFrame, list[str]]:
    """Several value columns of the same rows on one grid, and those of ``values`` that have values off it.

    One aggregate, written to the shared folder, gives the ends of all series and looks at the values of all columns; rows off
    the grid without a value lose nothing. The grid and the join are made once for all columns.
    """
    off = [_off_grid(spec, F.col(name).isNotNull()).alias(f"_off_{k}") for k, name in enumerate(values)]
    ends = df.groupBy(*spec.keys).agg(F.min(spec.time).alias("first_time"), F.max(spec.time).alias("last_time"), *off)
    ends = cut_lineage(ends)
    seen = ends.agg(*(F.max(f"_off_{k}").alias(f"_off_{k}") for k in range(len(values)))).first()
    lost = [name for k, name in enumerate(values) if seen[f"_off_{k}"]]
    return pad(df, spec, ends.select(*spec.keys, "first_time", "last_time")), lost


def pad_range(df: DataFrame, spec: SeriesSpec, start: TimeLike, end: TimeLike) -> DataFrame:
    """Put each series on the regular grid from ``start`` to ``end``, both inclusive."""
    bounds = df.select(*spec.keys).distinct().withColumn("first_time", at(start)).withColumn("last_time", at(end))
    return pad(df, spec, bounds)


# --- Joins on time -----------------------------------------------------------------------------------------------


def left_on_time(df: DataFrame, spec: SeriesSpec, **others: tuple[DataFrame, SeriesSpec]) -> DataFrame:
    """Add the value of other series as columns, by key and time; ``df`` decides which rows there are.

    Each other series is renamed to its argument name, so equal column names cannot collide. A series that is a column
    of ``df`` itself is taken from there, without a join.
    """
    joined = df
    for name, (other, other_spec) in others.items():
        check_same_cadence(spec, other_spec)
        if other is df and other_spec.keys == spec.keys:
            joined = joined.withColumn(name, F.col(other_spec.value))
            continue
        ids = [F.col(old).alias(new) for old, new in zip(other_spec.id_columns, spec.id_columns)]
        joined = joined.join(other.select(*ids, F.col(other_spec.value).alias(name)), spec.id_columns, "left")
    return joined


def merge_series(frames: list[tuple[DataFrame, SeriesSpec]]) -> DataFrame:
    """Full outer join of many series on key and time, all columns kept.

    Written as a union and one aggregate: one shuffle, however many series there are. Every frame holds a key and time
    at most once and the frames share no other columns, so each group has at most one value per column.
    """
    specs = [spec for _, spec in frames]
    check_same_cadence(*specs)
    ids = specs[0].id_columns
    columns = [name for df, _ in frames for name in df.columns if name not in ids]
    if len(set(columns)) != len(columns):
        raise ValueError(f"Frames to merge share column names: {sorted(columns)}")
    stacked = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), (df for df, _ in frames))
    return stacked.groupBy(*ids).agg(*(F.first(name, ignorenulls=True).alias(name) for name in columns))


def stack_series(frames: list[DataFrame]) -> DataFrame:
    """Union by name; columns a frame does not have are null."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def melt(df: DataFrame, spec: SeriesSpec, columns: list[str]) -> DataFrame:
    """One row per value column: keys, time, variable, value. One scan serves all columns."""
    return df.unpivot(spec.id_columns, columns, "variable", "value")


def keep_first(df: DataFrame, ids: list[str], order: list[Column | str]) -> DataFrame:
    """Keep the first row for each id, in the given order."""
    first = Window.partitionBy(*ids).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def upsert(stored: DataFrame, new: DataFrame, ids: list[str]) -> DataFrame:
    """Merge new rows into stored ones. A new row decides all columns it has, nulls included; rows and columns that
    only the stored data has are kept."""
    shared = [name for name in new.columns if name in stored.columns and name not in ids]
    only_stored = [name for name in stored.columns if name not in new.columns]
    only_new = [name for name in new.columns if name not in stored.columns]
    old = stored.select(*ids, *(F.col(name).alias(f"_old_{name}") for name in shared), *only_stored)
    both = new.withColumn("_is_new", F.lit(True)).join(old, ids, "full")
    decided = [F.when(F.col("_is_new"), F.col(name)).otherwise(F.col(f"_old_{name}")).alias(name) for name in shared]
    return both.select(*ids, *decided, *only_stored, *only_new)


def daily_onto_hourly(
    hourly: DataFrame, hourly_spec: SeriesSpec, daily: DataFrame, daily_spec: SeriesSpec, name: str
) -> DataFrame:
    """Add a daily series to an hourly one by calendar date."""
    if hourly_spec.period.micros != 3_600_000_000 or daily_spec.period.micros != 86_400_000_000:
        raise ValueError("Needs an hourly and a daily series")
    days = daily.select(*daily_spec.keys, F.to_date(daily_spec.time).alias("_day"), F.col(daily_spec.value).alias(name))
    dated = hourly.withColumn("_day", F.to_date(hourly_spec.time))
    return dated.join(days, [*hourly_spec.keys, "_day"], "left").drop("_day")


# --- Attributes of deployments ----------------------------------------------------------------------------------------


def deployment_intervals(deployments: DataFrame, platform: str, attribute: str, keys: list[str]) -> DataFrame:
    """Intervals of one attribute of the deployments whose id contains the platform name. None found is an error."""
    found = deployments.where(F.col("deployment_id").contains(platform)).select(
        *keys, "start", "end", F.col(attribute).cast("double").alias(attribute)
    )
    if found.isEmpty():
        raise ValueError(f"No deployment of {platform} has {attribute}")
    return found
