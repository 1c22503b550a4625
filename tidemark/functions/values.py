"""Missing values and rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_float(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType))


def missing(df: DataFrame, name: str) -> Column:
    """True where the value is missing: null, or NaN for floating columns."""
    return F.isnull(name) | F.isnan(name) if is_float(df, name) else F.isnull(name)


def present(df: DataFrame, name: str) -> Column:
    return ~missing(df, name)


def nan_to_null(df: DataFrame, name: str) -> Column:
    """The column with NaN read as null, so that aggregates and comparisons skip it."""
    return F.when(~F.isnan(name), F.col(name)).alias(name) if is_float(df, name) else F.col(name)


def round_even(column: Column | str, decimals: int) -> Column:
    """Round half to even."""
    return F.bround(column, decimals)


def as_column(number: Column | float) -> Column:
    """A number or a column of numbers, as a column of doubles."""
    return number if isinstance(number, Column) else F.lit(float(number))


def clip(column: Column, low: Column | float | None = None, high: Column | float | None = None) -> Column:
    """Limit to [low, high]. Null stays null, which least and greatest would not do, and NaN stays NaN. A limit that is null in a row does
    not limit that row."""
    if low is None and high is None:
        raise ValueError("At least one limit must be given")
    # Spark orders NaN above every number, so it is let through first.
    limited = F.when(F.isnan(column), column)
    if low is not None:
        limited = limited.when(column < low, as_column(low))
    if high is not None:
        limited = limited.when(column > high, as_column(high))
    return limited.otherwise(column)
