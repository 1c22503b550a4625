"""Registry of the queries, and the series they start from, in Spark and in SQL.

The tables hold no sensor data, so each query first makes series from them:

* ``hourly``: events by type and hour (value, scans, battv), with real gaps; ``padded`` is the same on the full grid.
* ``daily``: order totals by priority and day.
* ``met``: weather-like columns by return flag and ship day, from averages over the line items.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.functions.times import slot, slot_start
from tidemark.operators.align import pad
from tidemark.plans.methods import Frame
from tidemark.session import prepare
from tidemark.spec import Period, SeriesSpec

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

HOUR, DAY = Period.parse("PT1H"), Period.parse("P1D")
HOURLY_SPEC = SeriesSpec(HOUR)
DAILY_SPEC = SeriesSpec(DAY)


def query(name: str, sql: str | None = None):
    """Register a query under a name, with its SQL."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A benchmark table. Its schema is looked up once per path, not once per query."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = prepare(spark).read.parquet(path).schema
    return prepare(spark).read.schema(_SCHEMAS[path]).parquet(path)


def r6(column: Column | str) -> Column:
    """Results are compared after rounding to six places."""
    return F.bround(column, 6)


def q6(expression: str) -> str:
    return f"round_even({expression}, 6)"


# Readings are scaled by a factor with no short decimal form. Otherwise means land exactly between two roundings, and a
# different order of adding up would round them differently.
UNIT = 1.0471975511965976


# --- hourly ------------------------------------------------------------------------------------------------------

HOURLY = f"""hourly AS (
  SELECT event_type AS site, date_trunc('hour', ts) AS time, avg(value) * {UNIT} AS value, count(*)::DOUBLE AS scans,
         min(value) AS battv
  FROM events GROUP BY 1, 2)"""
PADDED = f"""{HOURLY}, ends AS (SELECT site, min(time) AS lo, max(time) AS hi FROM hourly GROUP BY site),
grid AS (SELECT site, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS time FROM ends),
padded AS (SELECT g.site, g.time, h.value, h.scans, h.battv FROM grid g LEFT JOIN hourly h USING (site, time))"""


def hour_of(time: Column | str) -> Column:
    return slot_start(slot(time, HOUR), HOUR)


def day_of(time: Column | str) -> Column:
    return slot_start(slot(time, DAY), DAY)


def hourly(spark: SparkSession, folder: str, value: str = "value") -> Frame:
    events = table(spark, folder, "events").select(
        F.col("event_type").alias("site"), hour_of("ts").alias("time"), "value"
    )
    df = events.groupBy("site", "time").agg(
        (F.avg("value") * UNIT).alias("value"), F.count("*").cast("double").alias("scans"), F.min("value").alias("battv")
    )
    return Frame(df, HOURLY_SPEC.with_(value=value))


def hourly_bounds(spark: SparkSession, folder: str) -> DataFrame:
    """First and last hour of each site, straight from the scan."""
    ends = table(spark, folder, "events").groupBy(F.col("event_type").alias("site"))
    ends = ends.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    return ends.select("site", hour_of("lo").alias("first_time"), hour_of("hi").alias("last_time"))


def padded(spark: SparkSession, folder: str, value: str = "value") -> Frame:
    frame = hourly(spark, folder, value)
    return Frame(pad(frame.df, frame.spec, hourly_bounds(spark, folder)), frame.spec)


# --- daily -------------------------------------------------------------------------------------------------------

DAILY = f"""daily AS (
  SELECT o_orderpriority AS site, date_trunc('day', o_orderdate)::TIMESTAMP AS time,
         sum(o_totalprice) / 100000 * {UNIT} AS value, count(*)::DOUBLE AS orders
  FROM orders GROUP BY 1, 2)"""
DAILY_PADDED = f"""{DAILY}, dends AS (SELECT site, min(time) AS lo, max(time) AS hi FROM daily GROUP BY site),
dgrid AS (SELECT site, unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS time FROM dends),
dpadded AS (SELECT g.site, g.time, d.value, d.orders FROM dgrid g LEFT JOIN daily d USING (site, time))"""


def daily(spark: SparkSession, folder: str, value: str = "value") -> Frame:
    orders = table(spark, folder, "orders").select(
        F.col("o_orderpriority").alias("site"), day_of("o_orderdate").alias("time"), "o_totalprice"
    )
    df = orders.groupBy("site", "time").agg(
        (F.sum("o_totalprice") / 100000 * UNIT).alias("value"), F.count("*").cast("double").alias("orders")
    )
    return Frame(df, DAILY_SPEC.with_(value=value))


def daily_padded(spark: SparkSession, folder: str, value: str = "value") -> Frame:
    frame = daily(spark, folder, value)
    ends = table(spark, folder, "orders").groupBy(F.col("o_orderpriority").alias("site"))
    ends = ends.agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    bounds = ends.select("site", day_of("lo").alias("first_time"), day_of("hi").alias("last_time"))
    return Frame(pad(frame.df, frame.spec, bounds), frame.spec)


# --- met ---------------------------------------------------------------------------------------------------------

# Each column of ``met`` as text that both engines read, over the averages q, d, x and p.
MET_COLUMNS = {
    "swin": "p / 100",
    "swout": "p * d / 25",
    "lwin": "300 + q",
    "lwout": "350 + q * 1.5",
    "ta": "q / 2",
    "rh": "40 + d * 800",
    "ws": "0.5 + x * 100",
    "pa": "950 + q * 2",
    "g1": "d * 200",
    "g2": "x * 250",
    "h": "q * 3",
    "le": "q * 5 + 20",
    "ux": "d * 100 - 5",
    "uy": "x * 100 - 4",
    "counts": "1000 + p / 50",
    "zenith": "d * 40 - 0.5",
    "albedo": "d * 12",
    "vwc": "q * 1.2",
}
_MET_LIST = ", ".join(f"({text}) AS {name}" for name, text in MET_COLUMNS.items())
MET = f"""met AS (SELECT site, time, {_MET_LIST} FROM (
  SELECT l_returnflag AS site, date_trunc('day', l_shipdate)::TIMESTAMP AS time, avg(l_quantity) * {UNIT} AS q,
         avg(l_discount) * {UNIT} AS d, avg(l_tax) * {UNIT} AS x, avg(l_extendedprice) * {UNIT} AS p
  FROM lineitem GROUP BY 1, 2))"""


def met_table(spark: SparkSession, folder: str) -> DataFrame:
    items = table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("site"),
        day_of("l_shipdate").alias("time"),
        "l_quantity",
        "l_discount",
        "l_tax",
        "l_extendedprice",
    )
    means = items.groupBy("site", "time").agg(
        (F.avg("l_quantity") * UNIT).alias("q"),
        (F.avg("l_discount") * UNIT).alias("d"),
        (F.avg("l_tax") * UNIT).alias("x"),
        (F.avg("l_extendedprice") * UNIT).alias("p"),
    )
    return means.selectExpr("site", "time", *(f"double({text}) AS {name}" for name, text in MET_COLUMNS.items()))


def column_of(df: DataFrame, value: str, **fields) -> Frame:
    """One column of a daily table as a series."""
    return Frame(df, DAILY_SPEC.with_(value=value, **fields))
