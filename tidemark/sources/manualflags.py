"""The hand-kept list of bad periods: SITE_ID, VARIABLES_AFFECTED (split by ;), START_DATETIME, END_DATETIME."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def read_manual_flags(spark: SparkSession, path: str) -> DataFrame:
    """Read the list as rows (site, variable, start, end), one per variable."""
    # Columns are found by name, so their order and any further columns do not matter.
    rows = spark.read.option("header", "true").option("enforceSchema", "false").csv(path)
    return parse_manual_flags(rows)


def parse_manual_flags(rows: DataFrame) -> DataFrame:
    """One row per site and variable, in upper case and trimmed; blank variables are dropped. An empty end is open."""
    names = F.explode(F.split("VARIABLES_AFFECTED", ";"))
    return (
        rows.withColumn("_variable", names)
        .select(
            F.upper(F.trim("SITE_ID")).alias("site"),
            F.upper(F.trim("_variable")).alias("variable"),
            F.to_timestamp_ntz("START_DATETIME", F.lit(TIME_FORMAT)).alias("start"),
            F.to_timestamp_ntz("END_DATETIME", F.lit(TIME_FORMAT)).alias("end"),
        )
        .where("variable != ''")
    )
