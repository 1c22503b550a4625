"""Methods by name, and the settings one method run gets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame

from tidemark.spec import SeriesSpec

KINDS = ("correction", "quality_control", "infill", "aggregation", "derivation")


@dataclass(frozen=True)
class Frame:
    """A DataFrame of many series, with the description of its columns."""

    df: DataFrame
    spec: SeriesSpec

    def pair(self) -> tuple[DataFrame, SeriesSpec]:
        return self.df, self.spec


@dataclass(frozen=True)
class Settings:
    """One method run: its parameters, named inputs, and the dates it is limited to (both inclusive).

    Parameters that differ from site to site, or in time, come as a table instead: ``by_site`` has the series keys,
    ``start``, ``end`` (inclusive, null is open) and a column per parameter. The method then only acts on rows that
    lie in one of its rows, and all sites still go through one job.
    """

    method: str
    params: dict[str, Any] = field(default_factory=dict)
    inputs: dict[str, Frame] = field(default_factory=dict)
    start: dt.datetime | str | None = None
    end: dt.datetime | str | None = None
    by_site: DataFrame | None = None

    def input(self, name: str) -> Frame:
        if name not in self.inputs:
            raise ValueError(f"Method {self.method} needs the input {name}")
        return self.inputs[name]

    def param(self, name: str) -> Any:
        if name not in self.params:
            raise ValueError(f"Method {self.method} needs the parameter {name}")
        return self.params[name]


_METHODS: dict[tuple[str, str], Callable] = {}


def method(kind: str, *names: str) -> Callable[[Callable], Callable]:
    """Register a function as a method. Users add their own the same way."""
    if kind not in KINDS:
        raise ValueError(f"Unknown kind of method: {kind}")

    def register(function: Callable) -> Callable:
        for name in names:
            _METHODS[kind, name] = function
        return function

    return register


def get_method(kind: str, name: str) -> Callable:
    try:
        return _METHODS[kind, name]
    except KeyError:
        raise KeyError(f"No {kind} method is named {name}; known: {method_names(kind)}") from None


def method_names(kind: str) -> list[str]:
    return sorted(name for known, name in _METHODS if known == kind)
