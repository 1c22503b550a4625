"""Infilling: give missing values an estimate. Series must be padded.

A method takes a Frame and Settings and returns a DataFrame with the same columns. Dates in the settings limit which
rows are written; without a start date all rows may be.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import within_dates
from tidemark.functions.values import nan_to_null
from tidemark.operators.align import left_on_time
from tidemark.operators.chunks import (
    CHUNK,
    CHUNK_SLOTS,
    SLOT,
    chunk_window,
    moving_sums,
    nearest_known,
    own_rows,
    with_halo,
    with_slot,
)
from tidemark.plans.methods import Frame, Settings, method
from tidemark.spec import Period


def _may_write(frame: Frame, settings: Settings) -> Column:
    if settings.start is None:
        return F.lit(True)
    return within_dates(frame.spec.time, settings.start, settings.end)


def _clean(frame: Frame) -> DataFrame:
    return frame.df.withColumn("_v", nan_to_null(frame.df, frame.spec.value))


def _nearest_values(rows: DataFrame, frame: Frame, payload: list[str], chunk_size: int = CHUNK_SLOTS) -> DataFrame:
    """Nearest rows with a value, back and ahead, as structs of slot and payload."""
    return nearest_known(rows, frame.spec, F.col("_v").isNotNull(), payload, chunk_size)


def _gap_fits(max_gap: int | None) -> Column:
    """Is the gap a row lies in at most ``max_gap`` rows long? A gap at the end of a series has no known length."""
    if max_gap is None:
        return F.lit(True)
    return F.coalesce(F.col("_next")[SLOT] - F.col("_prev")[SLOT] - 1 <= max_gap, F.lit(False))


@method("infill", "linear_interp")
def linear(frame: Frame, settings: Settings, chunk_size: int = CHUNK_SLOTS) -> DataFrame:
    """Linear in time between the nearest values either side; ``max_gap_size`` limits the rows of a gap."""
    max_gap = settings.params.get("max_gap_size")
    rows = _nearest_values(with_slot(_clean(frame), frame.spec), frame, ["_v"], chunk_size)
    before, after = F.col("_prev"), F.col("_next")
    share = (F.col(SLOT) - before[SLOT]) / (after[SLOT] - before[SLOT])
    estimate = before["_v"] + (after["_v"] - before["_v"]) * share
    fill = F.col("_v").isNull() & _may_write(frame, settings) & _gap_fits(max_gap)
    value = F.when(fill, estimate).otherwise(F.col(frame.spec.value))
    return rows.withColumn(frame.spec.value, value).select(*frame.df.columns)


@method("infill", "alt_data")
def alternative(frame: Frame, settings: Settings) -> DataFrame:
    """Take missing values from another series, times ``correction_factor`` (default 1)."""
    max_gap = settings.params.get("max_gap_size")
    rows = _clean(frame)
    if max_gap is not None:
        rows = _nearest_values(with_slot(rows, frame.spec), frame, [])
    rows = left_on_time(rows, frame.spec, _alt=settings.input("alt_data_source").pair())
    estimate = nan_to_null(rows, "_alt") * settings.params.get("correction_factor", 1)
    fill = F.col("_v").isNull() & _may_write(frame, settings) & _gap_fits(max_gap)
    value = F.when(fill, estimate).otherwise(F.col(frame.spec.value))
    return rows.withColumn(frame.spec.value, value).select(*frame.df.columns)


@method("infill", "alt_data_dynamic")
def alternative_scaled(frame: Frame, settings: Settings, chunk_size: int = CHUNK_SLOTS) -> DataFrame:
    """Take missing values from another series, scaled to fit the rows around each gap.

    The factor of a gap is the sum of this series over the sum of the other, over the rows within ``window`` before and
    after the gap where both have a value. A gap with fewer than ``min_threshold`` such rows is left alone. With
    ``max_threshold`` only that many of the nearest such rows are used; of two equally near, the earlier counts.
    """
    max_gap, most = settings.params.get("max_gap_size"), settings.params.get("max_threshold")
    window_rows = frame.spec.period.count(Period.parse(settings.param("window")))
    if not window_rows:
        raise ValueError(f"Window must be a whole number of periods: {settings.param('window')}")

    rows = left_on_time(_clean(frame), frame.spec, _alt=settings.input("alt_data_source").pair())
    rows = with_slot(rows.withColumn("_alt", nan_to_null(rows, "_alt")), frame.spec)
    haloed = with_halo(rows, SLOT, window_rows, window_rows, chunk_size)
    paired = F.col("_v").isNotNull() & F.col("_alt").isNotNull()
    if most is None:
        # Rows with a value summarise the window that ends, and the one that starts, with them. A gap then takes the first
        # from the value before it and the second from the value after it.
        parts = {"own": F.when(paired, F.col("_v")), "other": F.when(paired, F.col("_alt")), "n": F.when(paired, 1)}
        summed = own_rows(moving_sums(haloed, frame.spec, parts, window_rows))
        payload = [f"{name}_{side}" for name in parts for side in ("back", "ahead")]
        rows = _nearest_values(summed, frame, payload, chunk_size)

        def total(name: str) -> Column:
            before = F.col("_prev")[f"{name}_back"]
            after = F.col("_next")[f"{name}_ahead"]
            return F.coalesce(before, F.lit(0)) + F.coalesce(after, F.lit(0))

        own, other, pairs = total("own"), total("other"), total("n")
    else:
        rows = _nearest_pairs(haloed, frame, int(most), window_rows, chunk_size)
        own = F.aggregate("_pairs", F.lit(0.0), lambda acc, pair: acc + pair["own"])
        other = F.aggregate("_pairs", F.lit(0.0), lambda acc, pair: acc + pair["other"])
        pairs = F.size("_pairs")

    enough = pairs >= F.greatest(F.lit(int(settings.params.get("min_threshold", 0))), F.lit(1))
    estimate = F.when(enough, F.col("_alt") * F.try_divide(own, other))
    fill = F.col("_v").isNull() & _may_write(frame, settings) & _gap_fits(max_gap)
    value = F.when(fill, estimate).otherwise(F.col(frame.spec.value))
    return rows.withColumn(frame.spec.value, value).select(*frame.df.columns)


def _nearest_pairs(
    haloed: DataFrame,
    frame: Frame,
    most: int,
    window_rows: int,
    chunk_size: int,
) -> DataFrame:
    """Add ``_pairs`` to every row: the ``most`` nearest rows around its gap where both series have a value.

    The paired rows of a chunk are numbered once. A value next to a gap wants the ``most`` numbers up to its own, or from its
    own on, and finds them by an equality join; so lists are made for the edges of gaps alone. The lists are joined to the
    rows of the gap by the slot of the value before and after it.
    """
    spec = frame.spec
    order = chunk_window(spec, SLOT)
    paired = F.col("_v").isNotNull() & F.col("_alt").isNotNull()
    numbered = haloed.withColumns(
        {
            "_paired": paired,
            "_number": F.count_if(paired).over(order.rowsBetween(Window.unboundedPreceding, 0)),
            "_gap_after": F.lead("_v").over(order).isNull(),
            "_gap_before": F.lag("_v").over(order).isNull(),
        }
    )
    pairs = numbered.where("_paired").select(
        *spec.keys, CHUNK, "_number", F.struct(F.col(SLOT).alias("slot"), F.col("_v").alias("own"), F.col("_alt").alias("other")).alias("pair")
    )
    edges = own_rows(numbered.withColumn("_edge_chunk", F.col(CHUNK))).where(F.col("_v").isNotNull())
    edges = edges.withColumnRenamed("_edge_chunk", CHUNK)

    def listed(side: str, is_edge: str, numbers: Column) -> DataFrame:
        """(keys, slot of the edge, its pairs with their distance, nearest first)."""
        wanted = edges.where(is_edge).select(*spec.keys, CHUNK, F.col(SLOT).alias(f"_{side}_slot"), F.explode(numbers).alias("_number"))
        distance = F.abs(F.col("pair.slot") - F.col(f"_{side}_slot"))
        met = wanted.join(pairs, [*spec.keys, CHUNK, "_number"]).where(distance < window_rows)
        return met.groupBy(*spec.keys, f"_{side}_slot").agg(
            F.sort_array(F.collect_list(F.struct(distance.alias("distance"), "pair.slot", "pair.own", "pair.other"))).alias(f"_{side}_pairs")
        )

    number = F.col("_number")
    first_on = F.when(F.col("_paired"), number).otherwise(number + 1)
    before = listed("before", "_gap_after", F.sequence(number - (most - 1), number))
    after = listed("after", "_gap_before", F.sequence(first_on, first_on + (most - 1)))
    rows = (
        _nearest_values(own_rows(haloed), frame, [], chunk_size)
        .withColumn("_gap", F.col("_v").isNull())
        .withColumn("_before_slot", F.when(F.col("_gap"), F.col("_prev")[SLOT]))
        .withColumn("_after_slot", F.when(F.col("_gap"), F.col("_next")[SLOT]))
        .join(before, [*spec.keys, "_before_slot"], "left")
        .join(after, [*spec.keys, "_after_slot"], "left")
    )
    empty = F.array().cast("array<struct<distance:bigint,slot:bigint,own:double,other:double>>")
    both = F.concat(F.coalesce("_before_pairs", empty), F.coalesce("_after_pairs", empty))
    return rows.withColumn("_pairs", F.slice(F.sort_array(both), 1, most))
