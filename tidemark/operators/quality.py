"""Quality checks: which values fail.

A check takes a Frame and Settings and returns the frame's DataFrame with the boolean column ``_failed`` added. Null
means the check could not say, which counts as passed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import within_dates, within_day_window
from tidemark.functions.values import nan_to_null
from tidemark.operators.intervals import mark_in_periods
from tidemark.operators.chunks import SLOT, chunk_window, own_rows, with_halo, with_slot
from tidemark.plans.methods import Frame, Settings, method

FAILED = "_failed"


def _inside(frame: Frame, settings: Settings) -> Column | None:
    """Rows a check looks at. Without a start date that is all of them."""
    if settings.start is None:
        return None
    return within_dates(frame.spec.time, settings.start, settings.end)


def _restrict(result: Column, frame: Frame, settings: Settings) -> Column:
    inside = _inside(frame, settings)
    return result if inside is None else F.when(inside, result).otherwise(F.lit(False))


def _outside_range(value: Column, settings: Settings) -> Column:
    return (value < settings.param("lt")) | (value > settings.param("gt"))


def align_check(
    frame: Frame, other: Frame, condition: Callable[[Column], Column], settings: Settings, dated: bool = True
) -> DataFrame:
    """Check another series at the times of this one's rows, by key and time.

    Rows the other series does not have get null; rows only the other has play no part.
    """
    ids = [F.col(old).alias(new) for old, new in zip(other.spec.id_columns, frame.spec.id_columns)]
    value = nan_to_null(other.df, other.spec.value).alias("_other")
    if other.df is frame.df and other.spec.id_columns == frame.spec.id_columns:
        joined = frame.df.withColumn("_other", value).withColumn("_there", F.lit(True))
    else:
        companion = other.df.select(*ids, value, F.lit(True).alias("_there"))
        joined = frame.df.join(companion, frame.spec.id_columns, "left")
    result = condition(F.col("_other"))
    if dated:
        result = _restrict(result, frame, settings)
    return joined.withColumn(FAILED, F.when(F.col("_there"), result)).drop("_other", "_there")


@method("quality_control", "range")
def outside_range(frame: Frame, settings: Settings) -> DataFrame:
    """Below ``lt`` or above ``gt``; the limits themselves pass."""
    return frame.df.withColumn(FAILED, _restrict(_outside_range(_value(frame), settings), frame, settings))


@method("quality_control", "error_code")
def error_code(frame: Frame, settings: Settings) -> DataFrame:
    """One of the listed values."""
    codes = settings.param("value")
    codes = codes if isinstance(codes, (list, tuple)) else [codes]
    return frame.df.withColumn(FAILED, _restrict(F.col(frame.spec.value).isin(*codes), frame, settings))


@method("quality_control", "spike")
def spike(frame: Frame, settings: Settings, chunk_size: int | None = None) -> DataFrame:
    """Far from both neighbours, on the same side. Null at the ends of a series and next to a missing value.

    Needs a padded series. Each chunk carries one extra row either side, so a series is spread over many tasks.
    """
    extra = {} if chunk_size is None else {"chunk_size": chunk_size}
    rows = with_halo(with_slot(frame.df, frame.spec), SLOT, 1, 1, **extra).withColumn("_v", _value(frame))
    order = chunk_window(frame.spec, SLOT)
    rise = F.col("_v") - F.lag("_v").over(order)
    fall = F.lead("_v").over(order) - F.col("_v")
    jump = F.least(F.abs("_rise"), F.abs("_fall"))
    known = F.col("_rise").isNotNull() & F.col("_fall").isNotNull()
    turned = F.col("_rise") * F.col("_fall") < 0
    result = F.when(known, turned & (jump > settings.param("gt")))
    if (inside := _inside(frame, settings)) is not None:
        # Rows without two neighbours stay undecided inside the dates, and pass outside them.
        result = F.when(inside, result).otherwise(F.lit(False))
    marked = rows.withColumn("_rise", rise).withColumn("_fall", fall).withColumn(FAILED, result)
    return own_rows(marked).drop("_rise", "_fall", "_v", SLOT)


def _companion_below(input_name: str):
    def check(frame: Frame, settings: Settings) -> DataFrame:
        other = settings.input(input_name)
        return align_check(frame, other, lambda value: value < settings.param("lt"), settings)

    check.__doc__ = f"The {input_name} series is below ``lt`` at that time."
    return check


battery = method("quality_control", "battery_v")(_companion_below("battv"))
samples = method("quality_control", "samples")(_companion_below("scans"))
signal = method("quality_control", "snowd_signal")(_companion_below("signal_quality"))
soil_temperature = method("quality_control", "tdt_tsoil")(_companion_below("soil_ta"))


@method("quality_control", "nr01_temp")
def sensor_temperature(frame: Frame, settings: Settings) -> DataFrame:
    """The sensor's own temperature is out of range at that time."""
    other = settings.input("sensor_ta")
    return align_check(frame, other, lambda value: _outside_range(value, settings), settings)


@method("quality_control", "pluvio_diag")
def diagnostic(frame: Frame, settings: Settings) -> DataFrame:
    """The diagnostic is above ``gt`` at that time."""
    other = settings.input("sensor_diag")
    return align_check(frame, other, lambda value: value > settings.param("gt"), settings)


@method("quality_control", "flux_qc_flag")
def flux_flag(frame: Frame, settings: Settings) -> DataFrame:
    """The companion quality flag says 2 (poor). Dates are not looked at."""
    other = settings.input("qc_flag")
    return align_check(frame, other, lambda value: value == 2, settings, dated=False)


@method("quality_control", "hfp_removal")
def time_of_day_window(frame: Frame, settings: Settings) -> DataFrame:
    """Time of day in [time_ge, time_le], both inclusive."""
    hit = within_day_window(frame.spec.time, settings.param("time_ge"), settings.param("time_le"))
    return frame.df.withColumn(FAILED, _restrict(hit, frame, settings))


@method("quality_control", "manual_removal")
def manual_removal(frame: Frame, settings: Settings) -> DataFrame:
    """In a period somebody marked as bad for this site and variable, or for all variables of the site.

    The input ``periods`` has site, variable, start, end (see ``sources.manualflags``). Site codes are compared in
    upper case. The frame's first key is the site.
    """
    site = frame.spec.keys[0]
    periods = settings.input("periods").df
    variable = str(settings.params.get("variable", frame.spec.value)).upper()
    wanted = periods.where(F.col("variable").isin(variable, "ALL")).select(
        F.upper("site").alias("_site"), "start", "end"
    )
    spec = frame.spec.with_(keys=("_site",))
    upper = frame.df.withColumn("_site", F.upper(site))
    return mark_in_periods(upper, spec, wanted, FAILED).drop("_site")


def _value(frame: Frame) -> Column:
    """The value column with NaN as null, so that NaN is not larger than every limit."""
    return nan_to_null(frame.df, frame.spec.value)
