"""Flag columns of a dataset and the core flags each kind of step sets."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.flagbits import CORE_FLAGS, FLAG_ROLES, clear_bit, set_bit
from tidemark.functions.values import missing, present


@dataclass(frozen=True)
class FlagColumns:
    """The flag columns of a dataset: column name per role, and the flag scheme of each role (flag name -> bit)."""

    columns: dict[str, str] = field(default_factory=dict)
    schemes: dict[str, dict[str, int]] = field(default_factory=dict)

    def __post_init__(self):
        unknown = set(self.columns) - set(FLAG_ROLES)
        if unknown:
            raise ValueError(f"Unknown flag role: {sorted(unknown)}")

    def column(self, role: str) -> str | None:
        return self.columns.get(role)

    def bit(self, role: str, flag: str) -> int:
        scheme = CORE_FLAGS if role == "core" and "core" not in self.schemes else self.schemes[role]
        return scheme[flag]


def ensure_flag_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Create the declared flag columns that do not exist yet, all zero. Existing ones are kept."""
    return df.withColumns({name: F.lit(0).cast("int") for name in columns if name not in df.columns})


def set_initial_core(df: DataFrame, value: str, core: str) -> DataFrame:
    """After a load: every row is unchecked, and missing where there is no value."""
    flagged = set_bit(core, CORE_FLAGS["unchecked"], F.lit(True))
    return df.withColumn(core, set_bit(flagged, CORE_FLAGS["missing"], missing(df, value)))


def set_core_after_correction(df: DataFrame, value: str, core: str, correction: str) -> DataFrame:
    """Corrected where a correction left a value, unsuccessful where it left none."""
    touched = F.col(correction) != 0
    flagged = set_bit(core, CORE_FLAGS["corrected"], touched & present(df, value))
    return df.withColumn(
        core, set_bit(flagged, CORE_FLAGS["unsuccessful_correction"], touched & missing(df, value))
    )


def set_core_after_qc(df: DataFrame, core: str, quality: str) -> DataFrame:
    """No longer unchecked once there is a QC flag, whatever it says."""
    return df.withColumn(core, clear_bit(core, CORE_FLAGS["unchecked"], F.col(quality).isNotNull()))


def set_core_after_infill(df: DataFrame, core: str, infill: str) -> DataFrame:
    """Estimated where an infill method wrote."""
    return df.withColumn(core, set_bit(core, CORE_FLAGS["estimated"], F.col(infill) != 0))


def set_core_after_derivation(df: DataFrame, value: str, core: str) -> DataFrame:
    """Missing where the derivation gave no value."""
    return df.withColumn(core, set_bit(core, CORE_FLAGS["missing"], missing(df, value)))


def remove_flagged(df: DataFrame, value: str, quality: str, core: str | None = None) -> DataFrame:
    """Null the values that failed any check. Only rows that had a value get the removed flag."""
    failed = F.col(quality) > 0
    new = {value: F.when(failed, F.lit(None)).otherwise(F.col(value))}
    if core is not None:
        new[core] = set_bit(core, CORE_FLAGS["removed"], failed & present(df, value))
    return df.withColumns(new)


def flag_role_problems(flag_columns: DataFrame) -> DataFrame:
    """Check a table (dataset, column_name, role): the role must be known and used once per dataset."""
    problems = flag_columns.groupBy("dataset", "role").agg(
        F.count("*").alias("n"), F.min("column_name").alias("first_column"), F.max("column_name").alias("last_column")
    )
    reason = F.when(~F.col("role").isin(*FLAG_ROLES), "unknown role").when(F.col("n") > 1, "duplicate role")
    return problems.withColumn("reason", reason).where("reason is not null")


def check_flag_roles(flag_columns: DataFrame) -> None:
    bad = flag_role_problems(flag_columns).limit(1).collect()
    if bad:
        raise ValueError(f"Flag columns: {bad[0]['reason']} in {bad[0].asDict()}")
