"""Spike removal in flux series by median absolute deviation (MAD)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import TimeLike, at
from tidemark.functions.values import nan_to_null
from tidemark.operators.chunks import CHUNK, number_rows, own_rows, with_halo, with_slot
from tidemark.spec import Period, SeriesSpec

# Day and night limit (W m-2), MAD to standard deviation, and the range of sensible heat (W m-2).
DAYLIGHT = 20.0
MAD_SCALE = 0.6745
HEAT_MIN, HEAT_MAX = -200.0, 600.0
LOOKBACK_DAYS = 13


def _outside(diff: Column, part: Column, block: Window, sensitivity: float) -> Column:
    """Is a difference further from the block's median than the limit allows, among the rows of one part (day or night)?

    A block holds a fixed number of rows, so its exact median is cheap.
    """
    of_part = F.when(part & F.col("_own"), diff)
    middle = F.median(of_part).over(block)
    spread = F.median(F.abs(of_part - middle)).over(block) * (sensitivity / MAD_SCALE)
    return part & ((diff < middle - spread) | (diff > middle + spread))


def remove_spikes(
    df: DataFrame,
    spec: SeriesSpec,
    columns: list[str],
    radiation: str,
    window_days: int = LOOKBACK_DAYS,
    sensitivity: float = 5.5,
    iterations: int = 1,
) -> DataFrame:
    """Null the spikes in ``columns``.

    The difference to the row before minus the difference to the row after is compared with its median, for day and
    night rows apart, in blocks of ``window_days`` that are counted back from the newest row. Rows older than the last
    whole block are left alone, and rows without radiation count as both day and night. The oldest evaluated row stands
    in for its own predecessor; the newest row's difference is zero.

    Rows are spread over tasks by block; each block carries one extra row either side.
    """
    per_day = spec.period.count(Period.parse("P1D"))
    block_rows = window_days * per_day
    kept = [name for name in df.columns]
    clean = df.withColumns({name: nan_to_null(df, name) for name in [*columns, radiation]})
    rows = number_rows(with_slot(clean, spec), spec, newest_first=True)
    rows = rows.withColumn("_blocks", F.floor(F.col("_rows") / block_rows))

    for _ in range(iterations):
        newest_first = Window.partitionBy(*spec.keys, CHUNK).orderBy("_row")
        block = Window.partitionBy(*spec.keys, CHUNK)
        light = F.col(radiation)
        day = light.isNull() | (light >= DAYLIGHT)
        night = light.isNull() | (light < DAYLIGHT)
        evaluated = F.col("_row") < F.col("_blocks") * block_rows
        oldest = F.col("_row") == F.col("_blocks") * block_rows - 1
        haloed = with_halo(rows, "_row", 1, 1, block_rows)
        for name in columns:
            value = F.col(name)
            before = F.when(oldest, value).otherwise(F.lead(name).over(newest_first))
            after = F.lag(name).over(newest_first)
            double_diff = (value - before) - (after - value)
            haloed = haloed.withColumn(
                f"_diff_{name}", F.when(F.col("_row") == 0, value - value).otherwise(double_diff)
            )
        despiked = {}
        for name in columns:
            diff = F.col(f"_diff_{name}")
            spike = _outside(diff, day, block, sensitivity) | _outside(diff, night, block, sensitivity)
            spiky = evaluated & F.coalesce(spike, F.lit(False))
            despiked[name] = F.when(~spiky, F.col(name))
        haloed = haloed.withColumns({f"_new_{name}": column for name, column in despiked.items()})
        rows = own_rows(haloed).withColumns({name: F.col(f"_new_{name}") for name in columns})
    return rows.select(*kept)


def despike_current(
    current: DataFrame,
    history: DataFrame,
    spec: SeriesSpec,
    columns: list[str],
    radiation: str,
    output_names: dict[str, str] | None = None,
    heat: str = "H",
    **settings,
) -> DataFrame:
    """Despike the current rows with the rows before them as context, into new columns.

    Series without history are not despiked: their new columns are null. If ``heat`` is among the columns,
    ``<heat>_L2`` holds the despiked values that lie in the range of sensible heat.
    """
    names = output_names or {name: f"{name}_L2" for name in columns}
    originals = {name: f"_original_{name}" for name in columns}
    marked = current.withColumns({copy: F.col(name) for name, copy in originals.items()}).withColumn(
        "_current", F.lit(True)
    )
    context = history.select(*spec.id_columns, *columns, radiation)
    known = context.groupBy(*spec.keys).agg(F.lit(True).alias("_has_history"))
    together = marked.unionByName(context, allowMissingColumns=True)
    despiked = remove_spikes(together, spec, columns, radiation, **settings)
    rows = despiked.where("_current").join(known, [*spec.keys], "left")
    result = {names[name]: F.when(F.col("_has_history"), F.col(name)) for name in columns}
    if heat in columns:
        in_range = F.col(heat).between(HEAT_MIN, HEAT_MAX) & F.col("_has_history")
        result[f"{heat}_L2"] = F.when(in_range, F.col(heat))
    extra = [name for name in result if name not in current.columns]
    return rows.select(
        *(F.col(originals[name]).alias(name) if name in originals else F.col(name) for name in current.columns),
        *(result[name].alias(name) for name in extra),
    )


def despike_with_lookback(
    stored: DataFrame,
    spec: SeriesSpec,
    start: TimeLike,
    end: TimeLike,
    columns: list[str],
    radiation: str,
    lookback_days: int = LOOKBACK_DAYS,
    **settings,
) -> DataFrame:
    """Despike the days from ``start`` to ``end``, with the days before as history."""
    first, last = F.to_date(at(start)), F.to_date(at(end))
    day = F.to_date(spec.time)
    current = stored.where(day.between(first, last))
    history = stored.where((day >= F.date_sub(first, lookback_days)) & (day < first))
    return despike_current(current, history, spec, columns, radiation, **settings)
