"""Aggregation to a coarser period, and rolling means."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.flagbits import CORE_FLAGS, set_bit
from tidemark.functions.times import bucket_slot, grid_times_before, micros, slot_start, within_day_window
from tidemark.functions.values import nan_to_null
from tidemark.operators.chunks import CHUNK, SLOT, chunk_window, moving_sums, own_rows, with_halo, with_slot
from tidemark.plans.methods import Frame, Settings, method
from tidemark.spec import Period, SeriesSpec

BUCKET = "_bucket"


@dataclass(frozen=True)
class Target:
    """What to aggregate to: the period, where its label sits, and how many values a bucket must have."""

    period: Period
    anchor: str = "start"
    threshold: int | None = None
    window: tuple[str, str] | None = None

    @staticmethod
    def of(settings: Settings) -> Target:
        params = settings.params
        start, end = params.get("start_time"), params.get("end_time")
        return Target(
            Period.parse(settings.param("aggregation_period")),
            params.get("aggregation_time_anchor", "start"),
            params.get("threshold"),
            (start, end) if start and end else None,
        )


def expected_count(spec: SeriesSpec, target: Target) -> Column:
    """How many rows a complete bucket has."""
    period, source = target.period, spec.period
    if target.window is None and (fixed := source.count(period)) is not None:
        return F.lit(fixed).cast("long")
    if source.is_calendar:
        raise ValueError("Cannot count calendar periods in a fixed period")
    bucket = F.col(BUCKET)
    first, last = micros(slot_start(bucket, period)), micros(slot_start(bucket + 1, period))
    if target.window is None:
        return ((last - first) / source.micros).cast("long")
    if spec.anchor == "end":
        # Such a bucket holds its end and not its start.
        first, last = first + 1, last + 1
    return grid_times_before(last, source, *target.window) - grid_times_before(first, source, *target.window)


def in_buckets(frame: Frame, target: Target) -> DataFrame:
    """Rows with their bucket and cleaned value, limited to the time-of-day window if there is one."""
    spec = frame.spec
    rows = frame.df if target.window is None else frame.df.where(within_day_window(spec.time, *target.window))
    return rows.withColumn(BUCKET, bucket_slot(spec, target.period)).withColumn(
        "_v", nan_to_null(frame.df, spec.value)
    )


def finish(grouped: DataFrame, spec: SeriesSpec, target: Target, *extra: str) -> DataFrame:
    """Label the buckets and add the counts that say how complete they are."""
    label = F.col(BUCKET) + (1 if target.anchor == "end" else 0)
    valid = F.lit(True) if target.threshold is None else F.col("_count") >= target.threshold
    return grouped.select(
        *spec.keys,
        slot_start(label, target.period).alias(spec.time),
        F.col("_value").alias(spec.value),
        F.col("_count").alias(f"count_{spec.value}"),
        expected_count(spec, target).alias(f"expected_count_{spec.time}"),
        valid.alias(f"valid_{spec.value}"),
        *extra,
    )


def aggregate(frame: Frame, settings: Settings, value: Column) -> DataFrame:
    """Group each series into buckets. Spark combines partial aggregates before the shuffle, which is on keys and
    bucket, so a long series is spread over its buckets."""
    target = Target.of(settings)
    grouped = in_buckets(frame, target).groupBy(*frame.spec.keys, BUCKET)
    return finish(grouped.agg(value.alias("_value"), F.count("_v").alias("_count")), frame.spec, target)


def _simple(name: str, value) -> None:
    def run(frame: Frame, settings: Settings) -> DataFrame:
        return aggregate(frame, settings, value())

    run.__doc__ = f"The {name} of each bucket."
    method("aggregation", name)(run)


_simple("sum", lambda: F.sum("_v"))
_simple("mean", lambda: F.avg("_v"))
_simple("max", lambda: F.max("_v"))
_simple("min", lambda: F.min("_v"))
_simple("stdev", lambda: F.stddev_samp("_v"))


@method("aggregation", "mean_sum")
def mean_sum(frame: Frame, settings: Settings) -> DataFrame:
    """Sum scaled up for missing rows: the mean times the number of rows a complete bucket has."""
    totals = aggregate(frame, settings, F.avg("_v"))
    value = frame.spec.value
    return totals.withColumn(value, F.col(value) * F.col(f"expected_count_{frame.spec.time}"))


@method("aggregation", "angular_mean")
def angular_mean(frame: Frame, settings: Settings) -> DataFrame:
    """Mean direction in degrees, in [0, 360)."""
    radians = F.radians("_v")
    degrees = F.degrees(F.atan2(F.avg(F.sin(radians)), F.avg(F.cos(radians))))
    return aggregate(frame, settings, F.pmod(degrees + 360.0, F.lit(360.0)))


@method("aggregation", "mean_rad")
def mean_radiation(frame: Frame, settings: Settings) -> DataFrame:
    """Mean flux in W m-2 as energy per period in MJ m-2."""
    seconds = Period.parse(settings.param("aggregation_period")).seconds
    return aggregate(frame, settings, F.avg("_v") * seconds / 1e6)


@method("aggregation", "point_estimate")
def point_estimate(frame: Frame, settings: Settings) -> DataFrame:
    """The value of row ``n`` (from 0) of each bucket, and its time. Null if the bucket is shorter."""
    spec, target = frame.spec, Target.of(settings)
    in_order = Window.partitionBy(*spec.keys, BUCKET).orderBy(spec.time)
    chosen = F.row_number().over(in_order) == settings.param("n") + 1
    grouped = in_buckets(frame, target).withColumn("_chosen", chosen).groupBy(*spec.keys, BUCKET)
    picked = grouped.agg(
        F.max(F.when(F.col("_chosen"), F.col("_v"))).alias("_value"),
        F.max(F.when(F.col("_chosen"), F.col(spec.time))).alias("time_of_nth_value"),
        F.count("_v").alias("_count"),
    )
    return finish(picked, spec, target, "time_of_nth_value")


@method("aggregation", "rolling_mean_for_counts")
def rolling_mean(frame: Frame, settings: Settings, chunk_size: int | None = None) -> DataFrame:
    """Mean over a moving window of a padded series; null where the window has fewer than ``threshold`` values, or
    reaches over the end of the series.

    On a regular grid the window is a number of rows. Chunks carry that many extra rows, and a row that has fewer rows
    before or after it in its chunk than the window reaches is near the end of the series. The work for a row does not
    depend on the length of the window.
    """
    spec = frame.spec
    size = None if spec.period.is_calendar else spec.period.count(Period.parse(settings.param("window_size")))
    if not size:
        raise ValueError(f"Window must be a fixed number of rows: {settings.param('window_size')}")
    alignment = settings.params.get("alignment", "center")
    reach = {"center": (size // 2, size - 1 - size // 2), "trailing": (size - 1, 0), "leading": (0, size - 1)}
    masked = {"center": (size // 2, size // 2), "trailing": (size - 1, 0), "leading": (0, size - 1)}
    before, after = reach[alignment]
    needed_before, needed_after = masked[alignment]

    extra = {} if chunk_size is None else {"chunk_size": chunk_size}
    values = with_slot(frame.df.withColumn("_v", nan_to_null(frame.df, spec.value)), spec)
    # A window is what ends with its last row, which lies ``after`` rows ahead.
    rows = with_halo(values, SLOT, max(before, needed_before), max(after, needed_after), **extra)
    order = chunk_window(spec, SLOT)
    start, end = settings.params.get("start_time"), settings.params.get("end_time")
    if start and end:
        rows = rows.withColumn("_v", F.when(within_day_window(spec.time, start, end), F.col("_v")))
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    in_chunk = Window.partitionBy(*spec.keys, CHUNK)
    rows = rows.withColumns(
        {
            "_place": F.row_number().over(order),
            "_seen": F.count("_v").over(upto),
            "_rows": F.count("*").over(in_chunk),
            "_all_seen": F.count("_v").over(in_chunk),
        }
    )
    # Counts are whole numbers, so their differences are exact; beyond the ends of the series there is nothing.
    seen_after = F.coalesce(F.lead("_seen", after).over(order), F.col("_all_seen"))
    seen_before = F.coalesce(F.lag("_seen", before + 1).over(order), F.lit(0))
    enough = F.col("_n") >= max(int(settings.params.get("threshold") or 0), 1)
    summed = moving_sums(rows, spec, {"sum": F.col("_v")}, size)
    rolled = (
        summed.withColumns({"_n": seen_after - seen_before, "_sum": F.lead("sum_back", after).over(order)})
        .withColumn("_complete", (F.col("_place") > needed_before) & (F.col("_rows") - F.col("_place") >= needed_after))
        .withColumn(spec.value, F.when(F.col("_complete") & enough, F.col("_sum") / F.col("_n")))
        .withColumn(f"count_{spec.value}", F.col("_n"))
        .withColumn(f"expected_count_{spec.time}", F.lit(size).cast("long"))
        .withColumn(f"valid_{spec.value}", F.col("_n") >= int(settings.params.get("threshold") or 0))
    )
    counts = [f"count_{spec.value}", f"expected_count_{spec.time}", f"valid_{spec.value}"]
    return own_rows(rolled).select(*spec.id_columns, spec.value, *counts)


def set_core_after_aggregation(df: DataFrame, spec: SeriesSpec, core: str) -> DataFrame:
    """Incomplete but enough: estimated. Incomplete and not enough: removed. Nothing at all: missing."""
    count, valid = F.col(f"count_{spec.value}"), F.col(f"valid_{spec.value}")
    incomplete = count != F.col(f"expected_count_{spec.time}")
    flagged = set_bit(core, CORE_FLAGS["estimated"], incomplete & valid)
    flagged = set_bit(flagged, CORE_FLAGS["removed"], incomplete & ~valid & (count > 0))
    return df.withColumn(core, set_bit(flagged, CORE_FLAGS["missing"], count == 0))


def null_below_threshold(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Take out the values of buckets with too few rows."""
    return df.withColumn(spec.value, F.when(F.col(f"valid_{spec.value}"), F.col(spec.value)))
