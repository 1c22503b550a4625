"""Corrections: give a series new values, within dates.

A method takes a Frame and Settings and returns a DataFrame with the same columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.physics import KELVIN_OFFSET, pressure_ratio
from tidemark.functions.times import within_dates
from tidemark.functions.values import as_column, clip, round_even
from tidemark.operators.align import left_on_time
from tidemark.plans.methods import Frame, Settings, method

# Stefan-Boltzmann constant, and the clear-sky limits of the slope correction.
STEFAN_BOLTZMANN = 5.67e-8
CLEAR_SKY_MAX = 1200.0
CLEAR_SKY_MIN_FRACTION = 0.333333
KELVIN_UNITS = ("kel", "K")
CELSIUS_UNITS = ("degc", "degC")


def replace_within_dates(df: DataFrame, frame: Frame, settings: Settings, new: Column) -> DataFrame:
    """Write ``new`` to the value column inside the dates of the settings; other rows keep their value."""
    spec = frame.spec
    if settings.start is None and settings.end is None:
        value = new
    else:
        inside = within_dates(spec.time, settings.start, settings.end)
        value = F.when(inside, new).otherwise(F.col(spec.value))
    return df.withColumn(spec.value, value).select(*frame.df.columns)


def _with_inputs(frame: Frame, settings: Settings, *names: str) -> DataFrame:
    """The series with its inputs next to it, each under ``_in_<name>``."""
    return left_on_time(frame.df, frame.spec, **{f"_in_{name}": settings.input(name).pair() for name in names})


@method("correction", "add")
def add(frame: Frame, settings: Settings) -> DataFrame:
    return replace_within_dates(
        frame.df, frame, settings, F.col(frame.spec.value) + settings.param("correction_factor")
    )


@method("correction", "scalar")
def scalar(frame: Frame, settings: Settings) -> DataFrame:
    return replace_within_dates(
        frame.df, frame, settings, F.col(frame.spec.value) * settings.param("correction_factor")
    )


@method("correction", "power")
def power(frame: Frame, settings: Settings) -> DataFrame:
    raised = F.pow(F.col(frame.spec.value), as_column(settings.param("correction_factor")))
    return replace_within_dates(frame.df, frame, settings, raised)


@method("correction", "absolute")
def absolute(frame: Frame, settings: Settings) -> DataFrame:
    return replace_within_dates(frame.df, frame, settings, F.abs(frame.spec.value))


@method("correction", "clip")
def clip_values(frame: Frame, settings: Settings) -> DataFrame:
    limited = clip(F.col(frame.spec.value), settings.params.get("min"), settings.params.get("max"))
    return replace_within_dates(frame.df, frame, settings, limited)


@method("correction", "lw_corr")
def longwave(frame: Frame, settings: Settings) -> DataFrame:
    """Recalibrate longwave radiation: uncalibrated reading times the factor, plus what the sensor itself emits."""
    unit = (settings.input("ta").spec.unit or "").rsplit("/", 1)[-1]
    if unit not in KELVIN_UNITS + CELSIUS_UNITS:
        raise ValueError(f"Temperature must be in degrees Celsius or kelvin, not {unit!r}")
    kelvin = F.col("_in_ta") + (KELVIN_OFFSET if unit in CELSIUS_UNITS else 0.0)
    emitted = F.pow(kelvin, F.lit(4.0)) * STEFAN_BOLTZMANN
    new = F.col("_in_lw_unc") * settings.param("correction_factor") + emitted
    return replace_within_dates(_with_inputs(frame, settings, "lw_unc", "ta"), frame, settings, new)


@method("correction", "pa_corr")
def pressure(frame: Frame, settings: Settings) -> DataFrame:
    """Add a pressure offset given at sea level, brought to the altitude of the sensor."""
    ratio = pressure_ratio(F.col("_in_ta"), settings.param("altitude"))
    new = F.col(frame.spec.value) + settings.param("correction_factor") * ratio
    return replace_within_dates(_with_inputs(frame, settings, "ta"), frame, settings, new)


@method("correction", "wd")
def wind_direction(frame: Frame, settings: Settings) -> DataFrame:
    """Wind direction from the two wind components, in degrees. Dates in the settings are not looked at."""
    angle = F.atan2("_in_ux", "_in_uy") * (180.0 / math.pi) + 90.0
    turned = F.when(angle < 0, angle + 360.0).otherwise(angle)
    merged = _with_inputs(frame, settings, "ux", "uy")
    return merged.withColumn(frame.spec.value, round_even(turned, 5)).select(*frame.df.columns)


@method("correction", "albedo_south_slope_correction")
def albedo_on_slope(frame: Frame, settings: Settings) -> DataFrame:
    """Albedo on a slope facing south; the zenith angle and the slope ``theta_g`` are in radians."""
    zenith, swin = F.col("_in_solar_zenith"), F.col("_in_swin")
    clear_sky = F.cos(zenith) * CLEAR_SKY_MAX
    excess = swin - clear_sky * CLEAR_SKY_MIN_FRACTION
    beta = clip(F.try_divide(excess, clear_sky * (1 - CLEAR_SKY_MIN_FRACTION)), 0, 1)
    direct = 1 - beta + beta * F.cos(zenith)
    new = clip(F.try_divide(F.col(frame.spec.value) * direct, F.cos(zenith - settings.param("theta_g"))), 0, 1)
    return replace_within_dates(_with_inputs(frame, settings, "swin", "solar_zenith"), frame, settings, new)
