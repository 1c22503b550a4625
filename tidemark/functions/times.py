"""Time arithmetic on zone-free timestamps. The session time zone is UTC (see ``tidemark.session.prepare``)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.spec import MICROS_PER_DAY, Period, SeriesSpec

TimeLike = str | dt.datetime | Column


def micros(time: Column | str) -> Column:
    """Microseconds since 1970."""
    time = F.col(time) if isinstance(time, str) else time
    return F.unix_micros(time.cast("timestamp"))


def from_micros(count: Column) -> Column:
    return F.timestamp_micros(count).cast("timestamp_ntz")


def at(moment: TimeLike) -> Column:
    """A zone-free timestamp from text, a datetime, or a column."""
    if isinstance(moment, Column):
        return moment
    if isinstance(moment, dt.date) and not isinstance(moment, dt.datetime):
        moment = dt.datetime.combine(moment, dt.time.min)
    return F.lit(str(moment)).cast("timestamp_ntz")


def floor_div(number: Column, size: int) -> Column:
    """Whole-number division that rounds towards minus infinity."""
    return F.call_function("div", number - F.pmod(number, F.lit(size)), F.lit(size))


def shift(time: Column | str, period: Period, steps: int | Column = 1) -> Column:
    """Move a time by a number of periods."""
    time = F.col(time) if isinstance(time, str) else time
    if period.is_calendar:
        return time + F.make_ym_interval(months=F.lit(steps) * period.months)
    return from_micros(micros(time) + F.lit(steps) * period.micros)


def slot(time: Column | str, period: Period) -> Column:
    """Number of the period that holds this time, counted from a fixed origin. Grid neighbours differ by one."""
    if period.is_calendar:
        return floor_div(F.year(time).cast("long") * 12 + F.month(time) - 1, period.months)
    return floor_div(micros(time), period.micros)


def slot_start(number: Column, period: Period) -> Column:
    """Start time of a numbered period."""
    if period.is_calendar:
        month = number * period.months
        year = floor_div(month, 12).cast("int")
        zero = F.lit(0)
        return F.make_timestamp_ntz(year, (F.pmod(month, F.lit(12)) + 1).cast("int"), F.lit(1), zero, zero, zero)
    return from_micros(number * period.micros)


def time_of_day(time: Column | str) -> Column:
    """Microseconds since midnight."""
    return F.pmod(micros(time), F.lit(MICROS_PER_DAY))


def within_day_window(time: Column | str, start: str, end: str) -> Column:
    """True if the time of day is in [start, end], both inclusive, given as HH:MM:SS."""
    return time_of_day(time).between(seconds_of_day(start) * 1_000_000, seconds_of_day(end) * 1_000_000)


def within_dates(time: Column | str, start: TimeLike | None, end: TimeLike | None) -> Column:
    """True if the time is in [start, end], both inclusive; a missing bound is open."""
    time = F.col(time) if isinstance(time, str) else time
    inside = F.lit(True)
    if start is not None:
        inside = time >= at(start)
    if end is not None:
        inside = inside & (time <= at(end)) if start is not None else time <= at(end)
    return inside


def bucket_slot(spec: SeriesSpec, period: Period) -> Column:
    """Number of the coarser period a row belongs to. An end-anchored value at midnight belongs to the day before."""
    if spec.anchor != "end":
        return slot(spec.time, period)
    return slot(from_micros(micros(spec.time) - 1), period)


def seconds_of_day(clock: str) -> int:
    hours, minutes, seconds = (int(part) for part in clock.split(":"))
    return hours * 3_600 + minutes * 60 + seconds


def grid_times_per_day(period: Period, start: str, end: str) -> int:
    """How many grid times of a day lie in the window [start, end]."""
    step = period.micros
    low, high = (seconds_of_day(clock) * 1_000_000 for clock in (start, end))
    return sum(low <= instant <= high for instant in range(0, MICROS_PER_DAY, step))


def grid_times_before(instant: Column, period: Period, start: str, end: str) -> Column:
    """How many grid times whose time of day is in [start, end] lie before an instant, given in microseconds; counted
    from a fixed origin, so that differences count the times in between."""
    step, (low, high) = period.micros, (seconds_of_day(clock) * 1_000_000 for clock in (start, end))
    upto = F.least(F.pmod(instant, F.lit(MICROS_PER_DAY)), F.lit(high + 1))
    today = floor_div(upto + (step - 1), step) - -(-low // step)
    whole_days = floor_div(instant, MICROS_PER_DAY) * grid_times_per_day(period, start, end)
    return (whole_days + F.greatest(F.lit(0), today)).cast("long")
