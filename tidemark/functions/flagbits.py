"""Integer bit flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.values import missing

# The core flags and their bits.
CORE_FLAGS = {
    "corrected": 1,
    "estimated": 2,
    "missing": 4,
    "removed": 8,
    "suspicious": 16,
    "unchecked": 32,
    "unsuccessful_correction": 64,
}
# What a flag column can be for.
FLAG_ROLES = ("core", "quality_control", "correction", "infill")
# Flag type of the metadata -> what the flag column is for.
FLAG_TYPES = {
    "core_flags": "core",
    "quality_control_flags": "quality_control",
    "correction_flags": "correction",
    "infill_flags": "infill",
}


def set_bit(flag: Column | str, bit: int, mask: Column) -> Column:
    """Add a flag where the mask is true. A null mask means not flagged."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    return F.when(mask, flag.bitwiseOR(F.lit(bit))).otherwise(flag).cast("int")


def clear_bit(flag: Column | str, bit: int, mask: Column) -> Column:
    """Take a flag away where the mask is true."""
    flag = F.col(flag) if isinstance(flag, str) else flag
    return F.when(mask, flag.bitwiseAND(F.lit(~bit))).otherwise(flag).cast("int")


def has_bit(flag: Column | str, bit: int) -> Column:
    flag = F.col(flag) if isinstance(flag, str) else flag
    return flag.bitwiseAND(F.lit(bit)) != 0


def changed(df: DataFrame, before: str, after: str) -> Column:
    """True where a value appeared, vanished or became another value. Null and NaN count as the same."""
    was, now = missing(df, before), missing(df, after)
    return (was != now) | (~was & ~now & F.coalesce(F.col(before) != F.col(after), F.lit(False)))


def appeared_or_vanished(df: DataFrame, before: str, after: str) -> Column:
    """True where the missing status differs between the two columns."""
    return missing(df, before) != missing(df, after)
