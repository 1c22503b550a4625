"""Ordered work on one series, spread over many tasks.

``Window.partitionBy(site)`` would put a whole series in one task, and one site may hold a third of all rows. So every
ordered operator here works on chunks: a fixed number of consecutive slots (or rows) of one series. Two ways to look
over the edge of a chunk:

* ``with_halo`` copies the rows near an edge into the neighbouring chunk. Enough when the reach is bounded.
* ``nearest_known`` and ``number_rows`` first reduce each chunk to one row, run the window over those few rows, and join
  the result back. Needed when the reach is not bounded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.times import floor_div, slot
from tidemark.spec import SeriesSpec

CHUNK = "_chunk"
SLOT = "_slot"
CHUNK_SLOTS = 16_384


def with_slot(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    return df.withColumn(SLOT, slot(spec.time, spec.period))


def with_halo(
    df: DataFrame, position: Column | str, before: int, after: int, chunk_size: int = CHUNK_SLOTS
) -> DataFrame:
    """Give each row its chunk, and copy it to every chunk that looks ``before`` rows back or ``after`` rows ahead.

    Filter on ``is_own`` after the window to drop the copies. A row is copied only if it lies within reach of a chunk
    edge, so with chunks much longer than the reach hardly any rows are copied.
    """
    position = F.col(position) if isinstance(position, str) else position
    chunk_size = max(chunk_size, before + after + 1)
    first, last = floor_div(position - after, chunk_size), floor_div(position + before, chunk_size)
    return df.withColumn(CHUNK, F.explode(F.sequence(first, last))).withColumn(
        "_own", floor_div(position, chunk_size) == F.col(CHUNK)
    )


def own_rows(df: DataFrame) -> DataFrame:
    """Drop the copies made by ``with_halo``, and its helper columns."""
    return df.where("_own").drop("_own", CHUNK)


def chunk_window(spec: SeriesSpec, order: str | Column, *extra: str) -> WindowSpec:
    return Window.partitionBy(*spec.keys, CHUNK, *extra).orderBy(order)


def moving_sums(rows: DataFrame, spec: SeriesSpec, values: dict[str, Column], size: int) -> DataFrame:
    """For each name the sums of its value over the ``size`` rows that end with a row, ``<name>_back``, and over those that
    start with it, ``<name>_ahead``. Near the end of a series the rows there are; nulls add nothing, and only nulls give 0.

    ``rows`` are on a padded grid, with slots, and in chunks that reach ``size`` - 1 rows over their edges. A window of
    ``size`` slots is the end of one block of ``size`` slots and the start of the next. So running sums within blocks, in
    either direction, do: the work for a row does not depend on ``size``, and no sum is a difference, in which digits
    would be lost.
    """
    forth, back = chunk_window(spec, SLOT), chunk_window(spec, F.desc(SLOT))
    forth_block, back_block = chunk_window(spec, SLOT, "_block"), chunk_window(spec, F.desc(SLOT), "_block")
    earlier = forth.rowsBetween(Window.unboundedPreceding, -1)
    later = back.rowsBetween(Window.unboundedPreceding, -1)
    place, zero = F.pmod(F.col(SLOT), F.lit(size)), F.lit(0)
    # Numbering by chunk first: blocks then need no other exchange.
    found = rows.withColumn("_block", floor_div(F.col(SLOT), size))
    found = found.withColumns({f"_sum_{name}": F.coalesce(value, zero) for name, value in values.items()})
    running = {f"_sum_{name}_upto": F.sum(f"_sum_{name}").over(forth_block.rowsBetween(Window.unboundedPreceding, 0)) for name in values}
    running |= {f"_sum_{name}_from": F.sum(f"_sum_{name}").over(back_block.rowsBetween(Window.unboundedPreceding, 0)) for name in values}
    found = found.withColumns(running)
    # The whole of the block before or after, for where a series starts or ends within the window.
    whole = {}
    for name in values:
        last_of_block, first_of_block = F.when(place == size - 1, F.col(f"_sum_{name}_upto")), F.when(place == 0, F.col(f"_sum_{name}_from"))
        rest_back = F.coalesce(F.lag(f"_sum_{name}_from", size - 1).over(forth), F.last(last_of_block, True).over(earlier), zero)
        rest_ahead = F.coalesce(F.lag(f"_sum_{name}_upto", size - 1).over(back), F.last(first_of_block, True).over(later), zero)
        whole[f"{name}_back"] = F.col(f"_sum_{name}_upto") + F.when(place == size - 1, zero).otherwise(rest_back)
        whole[f"{name}_ahead"] = F.col(f"_sum_{name}_from") + F.when(place == 0, zero).otherwise(rest_ahead)
    helpers = [f"_sum_{name}{suffix}" for name in values for suffix in ("", "_upto", "_from")]
    return found.withColumns(whole).drop("_block", *helpers)


def nearest_known(
    df: DataFrame, spec: SeriesSpec, known: Column, payload: list[str], chunk_size: int = CHUNK_SLOTS
) -> DataFrame:
    """Add structs ``_prev`` and ``_next``: the slot and payload of the nearest row with ``known`` true, looking back
    and ahead and including the row itself. ``df`` needs the slot column. Payload columns must be numbers.
    """
    chunked = df.withColumn(CHUNK, floor_div(F.col(SLOT), chunk_size)).withColumn("_known", known)
    known_slot = F.when(F.col("_known"), F.col(SLOT))
    fields = [SLOT, *payload]

    # One row per chunk: the first and last known row in it. Plain numbers, so this is a hash aggregate with map-side
    # combine.
    edges = chunked.groupBy(*spec.keys, CHUNK).agg(
        *(F.min_by(name, known_slot).alias(f"_first_{name}") for name in fields),
        *(F.max_by(name, known_slot).alias(f"_last_{name}") for name in fields),
    )

    def edge(side: str) -> Column:
        struct = F.struct(*(F.col(f"_{side}_{name}").alias(name) for name in fields))
        return F.when(F.col(f"_{side}_{SLOT}").isNotNull(), struct)

    by_chunk = Window.partitionBy(*spec.keys)
    earlier = by_chunk.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    later = by_chunk.orderBy(F.desc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.select(
        *spec.keys,
        CHUNK,
        F.last(edge("last"), ignorenulls=True).over(earlier).alias("_carry_prev"),
        F.last(edge("first"), ignorenulls=True).over(later).alias("_carry_next"),
    )

    back = chunk_window(spec, SLOT).rowsBetween(Window.unboundedPreceding, 0)
    ahead = chunk_window(spec, F.desc(SLOT)).rowsBetween(Window.unboundedPreceding, 0)
    here = F.when(F.col("_known"), F.struct(*fields))
    return (
        chunked.join(carried, [*spec.keys, CHUNK])
        .withColumn("_prev", F.coalesce(F.last(here, ignorenulls=True).over(back), "_carry_prev"))
        .withColumn("_next", F.coalesce(F.last(here, ignorenulls=True).over(ahead), "_carry_next"))
        .drop("_carry_prev", "_carry_next", "_known", CHUNK)
    )


def number_rows(df: DataFrame, spec: SeriesSpec, newest_first: bool = False) -> DataFrame:
    """Add ``_row`` (from 0, in time order) and ``_rows`` (rows in the series). Needs the slot column."""
    order = F.col(spec.time).desc() if newest_first else F.col(spec.time).asc()
    chunked = df.withColumn(CHUNK, floor_div(F.col(SLOT), CHUNK_SLOTS))
    counts = chunked.groupBy(*spec.keys, CHUNK).agg(F.count("*").alias("_in_chunk"))
    series = Window.partitionBy(*spec.keys)
    passed = series.orderBy(F.desc(CHUNK) if newest_first else F.asc(CHUNK)).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *spec.keys,
        CHUNK,
        F.coalesce(F.sum("_in_chunk").over(passed), F.lit(0)).alias("_before"),
        F.sum("_in_chunk").over(series).alias("_rows"),
    )
    rank = F.row_number().over(Window.partitionBy(*spec.keys, CHUNK).orderBy(order))
    return (
        chunked.join(offsets, [*spec.keys, CHUNK])
        .withColumn("_row", F.col("_before") + rank - 1)
        .drop(CHUNK, "_before")
    )


def running_max_since(
    df: DataFrame, spec: SeriesSpec, restart: Column, number: Column, chunk_size: int = CHUNK_SLOTS
) -> DataFrame:
    """Add ``_running_max``: the largest ``number`` since the latest row with ``restart`` true, that row included.

    Null before the first restart. Needs the slot column. Each chunk is scanned by itself; what its last row reached is
    then carried into the following chunks until one of them restarts.
    """
    in_chunk = chunk_window(spec, SLOT).rowsBetween(Window.unboundedPreceding, 0)
    in_segment = chunk_window(spec, SLOT, "_segment").rowsBetween(Window.unboundedPreceding, 0)
    scanned = (
        df.withColumn(CHUNK, floor_div(F.col(SLOT), chunk_size))
        .withColumn("_segment", F.count(F.when(restart, F.lit(1))).over(in_chunk))
        .withColumn("_since", F.max(number).over(in_segment))
    )
    in_order = Window.partitionBy(*spec.keys).orderBy(CHUNK)
    carried = (
        scanned.groupBy(*spec.keys, CHUNK)
        .agg(F.max_by("_since", SLOT).alias("_tail"), F.max("_segment").alias("_restarts"))
        .withColumn("_run", F.sum(F.when(F.col("_restarts") > 0, 1).otherwise(0)).over(in_order))
        .withColumn("_reached", F.max("_tail").over(Window.partitionBy(*spec.keys, "_run").orderBy(CHUNK)))
        .select(
            *spec.keys,
            CHUNK,
            F.when(F.lag("_run").over(in_order) > 0, F.lag("_reached").over(in_order)).alias("_carry"),
            F.coalesce(F.lag("_run").over(in_order) > 0, F.lit(False)).alias("_carries"),
        )
    )
    return (
        scanned.join(carried, [*spec.keys, CHUNK])
        .withColumn(
            "_running_max",
            F.when(F.col("_segment") > 0, F.col("_since")).when(F.col("_carries"), F.greatest("_since", "_carry")),
        )
        .drop(CHUNK, "_segment", "_since", "_carry", "_carries")
    )


def running_max(
    df: DataFrame, keys: list[str], chunk: str, order: list[Column], number: Column, name: str, upto: int = 0
) -> DataFrame:
    """Add the running maximum of ``number`` per key: up to the row itself, or up to the row before with ``upto`` -1.

    ``chunk`` must follow the order. The largest number of each chunk is carried into the chunks after it.
    """
    held = df.withColumn("_held", number)
    by_chunk = Window.partitionBy(*keys).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        held.groupBy(*keys, chunk)
        .agg(F.max("_held").alias("_largest"))
        .select(*keys, chunk, F.max("_largest").over(by_chunk).alias("_carried"))
    )
    here = Window.partitionBy(*keys, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, upto)
    return (
        held.join(carried, [*keys, chunk])
        .withColumn(name, F.greatest("_carried", F.max("_held").over(here)))
        .drop("_held", "_carried")
    )
