"""Intervals and periods: checks, joins of rows to the interval that holds their time, membership in overlapping periods.

Rows meet intervals by equality on the series and on a *cell* of time, then by a range check. Cells are powers of two of
microseconds wide; the width follows from the mean length of the intervals at hand, so that all of them together have about
``COPIES`` cells each, and is at most ``2 ** WIDEST``. A row lies in one cell, so rows are never copied, and a series with
most rows is spread over its cells. Intervals with an open end, or far longer than the widest cell, would have very many
cells: they are few in a series, and are joined by the series alone, copied ``SPREAD`` times against rows dealt out by time.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import at, floor_div, from_micros, micros
from tidemark.operators.chunks import running_max
from tidemark.spec import SeriesSpec

#: Exponents of the narrowest cell (71 minutes), the widest (407 days) and of the blocks of time that rows are dealt out by.
NARROWEST, WIDEST, BLOCK = 32, 45, 41
COPIES = 16
SPREAD = 16
#: Intervals of more than so many of the widest cells (71 years) count as far.
FAR_CELLS = 64


# --- Cells -------------------------------------------------------------------------------------------------------


def _cell(time: Column | str, exponent: int) -> Column:
    return floor_div(micros(time), 1 << exponent)


def _is_far() -> Column:
    length = micros("end") - micros("start")
    return F.coalesce(length > FAR_CELLS << WIDEST, F.lit(True))


def _survey(intervals: DataFrame) -> tuple[int | None, bool]:
    """The exponent of the cells for the intervals that are not far, None if there are none, and whether there are far ones.
    Looks at the intervals only."""
    length = F.when(~_is_far(), (micros("end") - micros("start")).cast("double"))
    seen = intervals.agg(F.avg(length).alias("mean"), F.max(_is_far()).alias("far")).first()
    if seen["mean"] is None:
        return None, bool(seen["far"])
    exponent = math.ceil(math.log2(max(seen["mean"], 1.0) / COPIES))
    return min(max(exponent, NARROWEST), WIDEST), bool(seen["far"])


def _in_place(df: DataFrame, spec: SeriesSpec, intervals: DataFrame, place: Column, prefix: str, end_inclusive: bool) -> DataFrame:
    """Left join rows to intervals (keys, _place, start, end, others) of their series and place that hold their time. The
    others are added under prefixed names."""
    renamed = {"start": "_start", "end": "_end"} | {key: f"_key_{key}" for key in spec.keys}
    others = [name for name in intervals.columns if name not in (*spec.keys, "start", "end", "_place")]
    intervals = intervals.withColumnsRenamed(renamed | {name: f"{prefix}{name}" for name in others})
    time = F.col(spec.time)
    before_end = time <= F.col("_end") if end_inclusive else time < F.col("_end")
    same = reduce(lambda a, b: a & b, (F.col(key) == F.col(f"_key_{key}") for key in spec.keys))
    inside = (F.col("_start").isNull() | (time >= F.col("_start"))) & (F.col("_end").isNull() | before_end)
    joined = df.withColumn("_row_place", place).join(intervals, same & (F.col("_row_place") == F.col("_place")) & inside, "left")
    return joined.drop("_row_place", "_place", "_start", "_end", *(f"_key_{key}" for key in spec.keys))


def _near_place(intervals: DataFrame, exponent: int) -> DataFrame:
    return intervals.withColumn("_place", F.explode(F.sequence(_cell("start", exponent), _cell("end", exponent))))


def _far_place(intervals: DataFrame) -> DataFrame:
    return intervals.withColumn("_place", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SPREAD - 1).cast("bigint"))))


def _spread(time: str) -> Column:
    return F.pmod(_cell(time, BLOCK), F.lit(SPREAD))


# --- Checks ------------------------------------------------------------------------------------------------------


def _start_cell() -> Column:
    """Follows the order of the starts; an open start comes first."""
    return F.coalesce(_cell("start", WIDEST), F.lit(-(1 << 40)))


def invalid_intervals(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Intervals that break a rule, with the reason. Start may be null (open), end may be null (open).

    Rules, per key: end after start; no two intervals overlap or start together; at most one open end, on the last.

    Intervals are ordered within the cell they start in; what follows a cell is carried over from the next one, so a key
    with very many intervals is spread over tasks.
    """
    in_cells = intervals.withColumn("_start_cell", _start_cell())
    in_order = Window.partitionBy(*keys).orderBy("_start_cell")
    following = (
        in_cells.groupBy(*keys, "_start_cell")
        .agg(F.min("start").alias("_first"), F.count_if(F.col("end").isNull()).alias("_open"))
        .select(
            *keys,
            "_start_cell",
            F.lead("_first").over(in_order).alias("_first_after"),
            F.sum("_open").over(Window.partitionBy(*keys)).alias("_open_ends"),
        )
    )
    within_cell = Window.partitionBy(*keys, "_start_cell").orderBy(
        F.col("start").asc_nulls_first(), F.col("end").asc_nulls_last()
    )
    # Only the first interval of all can have no start, so a next interval with a null start starts together with it.
    has_next = F.lead(F.lit(True)).over(within_cell).isNotNull()
    open_end, next_start = F.col("end").isNull(), F.col("_next_start")
    more = F.col("_next_here") | next_start.isNotNull()
    reason = (
        F.when(F.col("end") <= F.col("start"), "end not after start")
        .when(open_end & (F.col("_open_ends") > 1), "more than one open end")
        .when(open_end & more, "open end is not last")
        .when(more & (next_start.isNull() | (next_start < F.col("end"))), "overlap")
    )
    return (
        in_cells.join(following, [*keys, "_start_cell"])
        .withColumn("_next_here", has_next)
        .withColumn(
            "_next_start", F.when(F.col("_next_here"), F.lead("start").over(within_cell)).otherwise(F.col("_first_after"))
        )
        .withColumn("reason", reason)
        .where("reason is not null")
        .drop("_start_cell", "_first_after", "_open_ends", "_next_here", "_next_start")
    )


def check_intervals(intervals: DataFrame, keys: list[str]) -> None:
    """Raise if any interval breaks a rule. Looks at the intervals only, and brings one row back."""
    bad = invalid_intervals(intervals, keys).limit(1).collect()
    if bad:
        raise ValueError(f"Invalid interval ({bad[0]['reason']}): {bad[0].asDict()}")


# --- Joins -------------------------------------------------------------------------------------------------------


def _match_intervals(df: DataFrame, spec: SeriesSpec, intervals: DataFrame, end_inclusive: bool) -> DataFrame:
    """Left join rows to the interval that holds their time; no two intervals of a series may overlap."""
    names = [name for name in intervals.columns if name not in (*spec.keys, "start", "end")]
    exponent, far = _survey(intervals)
    joined, prefixes = df, []
    if exponent is not None:
        near = _near_place(intervals.where(~_is_far()), exponent)
        joined = _in_place(joined, spec, near, _cell(spec.time, exponent), "_near_", end_inclusive)
        prefixes.append("_near_")
    if far:
        joined = _in_place(joined, spec, _far_place(intervals.where(_is_far())), _spread(spec.time), "_far_", end_inclusive)
        prefixes.append("_far_")
    # At most one of the two was found.
    found = {
        name: F.coalesce(*(F.col(f"{prefix}{name}") for prefix in prefixes)) if prefixes else F.lit(None).cast(intervals.schema[name].dataType)
        for name in names
    }
    return joined.select(*df.columns, *(column.alias(name) for name, column in found.items()))


def join_intervals(
    df: DataFrame, spec: SeriesSpec, intervals: DataFrame, *names: str, check: bool = True
) -> DataFrame:
    """Add the time-varying attributes ``names`` from intervals (keys, start, end, names).

    Start is inclusive, end exclusive; a null end is open. Rows outside all intervals get null.
    """
    intervals = intervals.select(*spec.keys, "start", "end", *names)
    if check:
        check_intervals(intervals, list(spec.keys))
    return _match_intervals(df, spec, intervals, end_inclusive=False)


def join_site_parameters(
    df: DataFrame, spec: SeriesSpec, table: DataFrame, prefix: str, found: str
) -> tuple[DataFrame, list[str]]:
    """Add the parameters that hold for each row from a table (keys, start, end, parameters), under prefixed names, and
    boolean ``found``. Start and end are inclusive, null is open. Periods of one series must not overlap."""
    keys = list(spec.keys)
    names = [name for name in table.columns if name not in (*keys, "start", "end")]
    check_intervals(table.select(*keys, "start", (F.col("end") + F.expr("INTERVAL 1 MICROSECOND")).alias("end")), keys)
    renamed = table.withColumnsRenamed({name: f"{prefix}{name}" for name in names}).withColumn(found, F.lit(True))
    joined = _match_intervals(df, spec, renamed, end_inclusive=True)
    return joined.withColumn(found, F.coalesce(found, F.lit(False))), names


# --- Periods that may overlap ------------------------------------------------------------------------------------


def merge_periods(periods: DataFrame, keys: list[str]) -> DataFrame:
    """Merge overlapping closed periods per key, so that no time lies in two of them.

    A period that starts after everything before it has ended starts a group; the others belong to the latest such start.
    """
    closed = _closed(periods, keys)
    in_cells = closed.withColumn("_start_cell", _start_cell())
    order = [F.col("start"), F.col("end")]
    reached = running_max(in_cells, keys, "_start_cell", order, F.col("end"), "_reached", upto=-1)
    begins = F.when(F.col("_reached").isNull() | (F.col("start") > F.col("_reached")), F.col("start"))
    # Of equal periods the one that starts the group comes first.
    order.append(F.col("_reached").asc_nulls_first())
    grouped = running_max(reached, keys, "_start_cell", order, begins, "_group")
    return grouped.groupBy(*keys, "_group").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_group")


def _closed(periods: DataFrame, keys: list[str]) -> DataFrame:
    far_past, far_future = at("0001-01-01 00:00:00"), at("9999-12-31 23:59:59.999999")
    start, end = F.coalesce("start", far_past).alias("start"), F.coalesce("end", far_future).alias("end")
    return periods.select(*keys, start, end).where("start <= end")


def _apart(periods: DataFrame, by: list[str]) -> DataFrame:
    """Periods (by, start, end) merged within their group, so that no time lies in two of one group."""
    in_order = Window.partitionBy(*by).orderBy("start", "end")
    reached = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.col("_reached").isNull() | (F.col("start") > F.col("_reached"))
    numbered = periods.withColumn("_reached", reached).withColumn("_group", F.count_if(begins).over(in_order))
    merged = numbered.groupBy(*by, "_group").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return merged.drop("_group").withColumn("hit", F.lit(True))


def mark_in_periods(df: DataFrame, spec: SeriesSpec, periods: DataFrame, name: str) -> DataFrame:
    """Add boolean ``name``: does the row's time lie in any period (keys, start, end) of its series, ends inclusive.

    Periods are clipped to each cell they touch and merged there, so a row finds at most one and rows are never multiplied. The
    groups that are put in order are those of one series and cell; far periods are merged by series.
    """
    keys = list(spec.keys)
    exponent, far = _survey(periods)
    marked, hits = df, [F.lit(False)]
    if exponent is not None:
        width = 1 << exponent
        near = _near_place(_closed(periods.where(~_is_far()), keys).distinct(), exponent)
        start = F.greatest(micros("start"), F.col("_place") * width)
        end = F.least(micros("end"), (F.col("_place") + 1) * width - 1)
        near = near.select(*keys, "_place", from_micros(start).alias("start"), from_micros(end).alias("end"))
        marked = _in_place(marked, spec, _apart(near, [*keys, "_place"]), _cell(spec.time, exponent), "_near_", True)
        hits.append(F.col("_near_hit"))
    if far:
        long = _far_place(_apart(_closed(periods.where(_is_far()), keys), keys))
        marked = _in_place(marked, spec, long, _spread(spec.time), "_far_", True)
        hits.append(F.col("_far_hit"))
    return marked.select(*df.columns, F.coalesce(F.greatest(*hits, F.lit(False)), F.lit(False)).alias(name))
