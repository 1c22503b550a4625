"""Tables of meteorological and instrument series that go into a flux run: fixed columns in fixed order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import round_even
from tidemark.operators.align import keep_first, merge_series
from tidemark.spec import SeriesSpec

# The recognised columns, in the order they are written.
BIOMET_COLUMNS = [
    "AirTemp_C",
    "RH",
    "Pressure_Avg",
    "R_SW_in_Avg",
    "T_nr_Avg",
    "G_PLATE_1_1_1",
    "G_PLATE_1_1_2",
]
INSTRUMENT_COLUMNS = ["sonic_azimuth", "height_measurement", "height_canopy"]


def _joined(frames: list[tuple[DataFrame, SeriesSpec]], recognised: list[str]) -> tuple[DataFrame | None, list[str]]:
    """The recognised series next to each other on key and time; of two for one column the first counts."""
    chosen = {}
    for df, spec in frames:
        if spec.value in recognised and spec.value not in chosen:
            rows = df.where(F.col(spec.time).isNotNull()).select(
                *spec.id_columns, F.col(spec.value).cast("double").alias(spec.value)
            )
            chosen[spec.value] = (keep_first(rows, spec.id_columns, [F.col(spec.value).asc_nulls_last()]), spec)
    if not chosen:
        return None, []
    columns = [name for name in recognised if name in chosen]
    return merge_series(list(chosen.values())), columns


def biomet_table(frames: list[tuple[DataFrame, SeriesSpec]]) -> DataFrame:
    """Times at which all recognised series have a value, rounded to 2 decimals. No recognised series is an error."""
    joined, columns = _joined(frames, BIOMET_COLUMNS)
    if joined is None:
        raise ValueError("No usable meteorological series")
    spec = frames[0][1]
    complete = joined.dropna("any", subset=columns)
    return complete.select(*spec.id_columns, *(round_even(name, 2).alias(name) for name in columns))


def instrument_table(frames: list[tuple[DataFrame, SeriesSpec]]) -> DataFrame | None:
    """Times at which any recognised series has a value. None if no series is recognised."""
    joined, columns = _joined(frames, INSTRUMENT_COLUMNS)
    if joined is None:
        return None
    spec = frames[0][1]
    return joined.dropna("all", subset=columns).select(*spec.id_columns, *columns)
