"""What a series is: its key, time and value columns, its period and where in the period a time label sits."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND

# Metadata anchor code -> anchor used here.
ANCHOR_CODES = {"proc": "start", "prec": "end", "inst": "point"}
ANCHORS = ("start", "end", "point")

_ISO_DURATION = re.compile(
    r"P(?:(?P<years>\d+)Y)?(?:(?P<months>\d+)M)?(?:(?P<weeks>\d+)W)?(?:(?P<days>\d+)D)?"
    r"(?:T(?:(?P<hours>\d+)H)?(?:(?P<minutes>\d+)M)?(?:(?P<seconds>\d+(?:\.\d+)?)S)?)?"
)
_MICROS = {
    "weeks": 7 * MICROS_PER_DAY,
    "days": MICROS_PER_DAY,
    "hours": 3_600 * MICROS_PER_SECOND,
    "minutes": 60 * MICROS_PER_SECOND,
}


@dataclass(frozen=True)
class Period:
    """A step in time: either a whole number of months, or a fixed number of microseconds."""

    months: int = 0
    micros: int = 0

    @staticmethod
    def parse(text: str | Period) -> Period:
        """Read an ISO-8601 duration such as ``PT30M``, ``P1D`` or ``P1M``."""
        if isinstance(text, Period):
            return text
        match = _ISO_DURATION.fullmatch(text)
        parts = {name: part for name, part in match.groupdict().items() if part} if match else {}
        months = 12 * int(parts.pop("years", 0)) + int(parts.pop("months", 0))
        micros = round(float(parts.pop("seconds", 0)) * MICROS_PER_SECOND)
        micros += sum(int(number) * _MICROS[unit] for unit, number in parts.items())
        if (months > 0) == (micros > 0):
            raise ValueError(f"Not a usable period: {text!r}")
        return Period(months, micros)

    @property
    def is_calendar(self) -> bool:
        """True for month and year periods, whose length in seconds varies."""
        return self.months > 0

    @property
    def seconds(self) -> float:
        if self.is_calendar:
            raise ValueError("A month-based period has no fixed number of seconds")
        return self.micros / MICROS_PER_SECOND

    def count(self, longer: Period) -> int | None:
        """How many of this period fit in ``longer``; None when that number is not fixed."""
        if self.is_calendar and longer.is_calendar:
            whole, rest = divmod(longer.months, self.months)
        elif self.is_calendar or longer.is_calendar:
            return None
        else:
            whole, rest = divmod(longer.micros, self.micros)
        return whole if rest == 0 else None


def anchor_from_code(code: str) -> str:
    """Map the metadata anchor code to start, end or point."""
    try:
        return ANCHOR_CODES[code]
    except KeyError:
        raise ValueError(f"Unknown time anchor: {code}") from None


@dataclass(frozen=True)
class SeriesSpec:
    """Describes the columns of a DataFrame that holds many series of one variable.

    ``keys`` name the series (usually the site). Keys and time are never null: a row without them belongs to no series.
    A value labelled T covers [T, T + period) for the ``start`` anchor,
    (T - period, T] for ``end`` and the instant T for ``point``.
    """

    period: Period
    keys: tuple[str, ...] = ("site",)
    time: str = "time"
    value: str = "value"
    anchor: str = "start"
    unit: str | None = None
    resolution: Period | None = None

    @staticmethod
    def of(period: str | Period, **fields) -> SeriesSpec:
        spec = SeriesSpec(Period.parse(period), **fields)
        if spec.anchor not in ANCHORS:
            raise ValueError(f"Unknown time anchor: {spec.anchor}")
        return spec

    def with_(self, **fields) -> SeriesSpec:
        return replace(self, **fields)

    @property
    def id_columns(self) -> list[str]:
        """The columns that identify one row: the series keys and the time."""
        return [*self.keys, self.time]


def check_same_cadence(*specs: SeriesSpec) -> None:
    """Series are only joined on time if they agree on time column, resolution and period. Anchors may differ."""
    first = specs[0]
    for other in specs[1:]:
        if other.time != first.time:
            raise ValueError(f"Time columns differ: {first.time} and {other.time}")
        if other.period != first.period:
            raise ValueError(f"Periods differ: {first.period} and {other.period}")
        if (other.resolution or other.period) != (first.resolution or first.period):
            raise ValueError(f"Resolutions differ: {first.resolution} and {other.resolution}")
