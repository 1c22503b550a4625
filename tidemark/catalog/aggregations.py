"""Aggregation and rolling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import (
    DAILY_PADDED,
    DAY,
    HOURLY,
    HOURLY_SPEC,
    PADDED,
    UNIT,
    daily_padded,
    hourly,
    padded,
    q6,
    query,
    r6,
    slot,
    slot_start,
    table,
)
from tidemark.functions.flagbits import CORE_FLAGS
from tidemark.operators import aggregate
from tidemark.operators.align import keep_first
from tidemark.operators.chunks import number_rows, with_slot
from tidemark.operators.flagging import FlagColumns, ensure_flag_columns
from tidemark.plans import runner
from tidemark.plans.methods import Frame, Settings, get_method
from tidemark.sources.store import run_report
from tidemark.spec import Period, SeriesSpec

DAY_OF = "date_trunc('day', time)::TIMESTAMP"


def _run(frame: Frame, name: str, **params):
    return get_method("aggregation", name)(frame, Settings(name, {"aggregation_period": "P1D"} | params))


def _out(df, value="value", *extra):
    return df.select(
        "site",
        "time",
        r6(value).alias("value"),
        F.col(f"count_{value}").cast("long").alias("n"),
        F.col("expected_count_time").cast("long").alias("expected"),
        F.col(f"valid_{value}").alias("valid"),
        *extra,
    )


def _sql(value: str, where: str = "TRUE", expected: int = 24, source: str = "padded", cte: str = PADDED) -> str:
    return f"""WITH {cte} SELECT site, {DAY_OF} AS time, {q6(value)} AS value, count(value) AS n,
      {expected}::BIGINT AS expected, TRUE AS valid FROM {source} WHERE {where} GROUP BY 1, 2"""


for _name, _method, _expression in (
    ("agg_sum", "sum", "sum(value)"),
    ("agg_mean", "mean", "avg(value)"),
    ("agg_max", "max", "max(value)"),
    ("agg_min", "min", "min(value)"),
    ("agg_stdev", "stdev", "stddev_samp(value)"),
    ("agg_mean_sum", "mean_sum", "avg(value) * 24"),
    ("agg_mean_rad", "mean_rad", "avg(value) * 86400 / 1e6"),
):
    query(_name, _sql(_expression))(lambda spark, folder, m=_method: _out(_run(padded(spark, folder), m)))


@query(
    "agg_angular_mean",
    _sql(
        "CASE WHEN atan2(avg(sin(radians(value))), avg(cos(radians(value)))) < 0 "
        "THEN degrees(atan2(avg(sin(radians(value))), avg(cos(radians(value))))) + 360 "
        "ELSE degrees(atan2(avg(sin(radians(value))), avg(cos(radians(value))))) END"
    ),
)
def agg_angular_mean(spark, folder):
    return _out(_run(padded(spark, folder), "angular_mean"))


@query("agg_time_window", _sql("avg(value)", "time::TIME BETWEEN TIME '10:30:00' AND TIME '14:00:00'", 4))
def agg_time_window(spark, folder):
    return _out(_run(padded(spark, folder), "mean", start_time="10:30:00", end_time="14:00:00"))


@query(
    "agg_time_window_hourly",
    f"""WITH quarters AS (SELECT event_type AS site, time_bucket(INTERVAL 15 MINUTE, ts) AS time, avg(value) * {UNIT} AS value
      FROM events GROUP BY 1, 2)
    SELECT site, date_trunc('hour', time) AS time, {q6("avg(value)")} AS value, count(value) AS n,
      CASE hour(date_trunc('hour', time)) WHEN 10 THEN 2 WHEN 14 THEN 1 ELSE 4 END::BIGINT AS expected, TRUE AS valid
    FROM quarters WHERE time::TIME BETWEEN TIME '10:30:00' AND TIME '14:00:00' GROUP BY 1, 2""",
)
def agg_time_window_hourly(spark, folder):
    """Quarter hours to hours, within a part of the day that cuts hours."""
    quarter = Period.parse("PT15M")
    events = table(spark, folder, "events").select(
        F.col("event_type").alias("site"), slot_start(slot("ts", quarter), quarter).alias("time"), "value"
    )
    rows = events.groupBy("site", "time").agg((F.avg("value") * UNIT).alias("value"))
    params = {"aggregation_period": "PT1H", "start_time": "10:30:00", "end_time": "14:00:00"}
    return _out(get_method("aggregation", "mean")(Frame(rows, HOURLY_SPEC.with_(period=quarter)), Settings("mean", params)))


@query(
    "agg_point_estimate",
    f"""WITH {PADDED}, numbered AS (SELECT *, row_number() OVER (PARTITION BY site, {DAY_OF} ORDER BY time) AS rn
      FROM padded), picked AS (SELECT site, {DAY_OF} AS day, time, value FROM numbered WHERE rn = 13)
    SELECT b.site, b.time, {q6("p.value")} AS value, b.n, 24::BIGINT AS expected, TRUE AS valid,
           p.time AS time_of_nth_value
    FROM (SELECT site, {DAY_OF} AS time, count(value) AS n FROM padded GROUP BY 1, 2) b
    LEFT JOIN picked p ON p.site = b.site AND p.day = b.time""",
)
def agg_point_estimate(spark, folder):
    return _out(_run(padded(spark, folder), "point_estimate", n=12), "value", "time_of_nth_value")


@query(
    "agg_end_anchor",
    f"""WITH {PADDED} SELECT site,
      date_trunc('day', time - INTERVAL 1 MICROSECOND)::TIMESTAMP + INTERVAL 1 DAY AS time, {q6("avg(value)")} AS value,
      count(value) AS n, 24::BIGINT AS expected, TRUE AS valid FROM padded GROUP BY 1, 2""",
)
def agg_end_anchor(spark, folder):
    frame = padded(spark, folder)
    ended = Frame(frame.df, frame.spec.with_(anchor="end"))
    return _out(_run(ended, "mean", aggregation_time_anchor="end"))


@query(
    "agg_monthly",
    f"""WITH {DAILY_PADDED} SELECT site, date_trunc('month', time)::TIMESTAMP AS time, {q6("avg(value)")} AS value,
      count(value) AS n, day(last_day(date_trunc('month', any_value(time))::DATE))::BIGINT AS expected, TRUE AS valid
    FROM dpadded GROUP BY 1, 2""",
)
def agg_monthly(spark, folder):
    return _out(_run(daily_padded(spark, folder), "mean", aggregation_period="P1M"))


_COUNTED = f"""{PADDED}, buckets AS (SELECT site, {DAY_OF} AS time, avg(value) AS value, count(value) AS n
  FROM padded GROUP BY 1, 2)"""
_CORE = """CASE WHEN n <> 24 AND n >= 22 THEN 2 ELSE 0 END + CASE WHEN n <> 24 AND n < 22 AND n > 0 THEN 8 ELSE 0 END
  + CASE WHEN n = 0 THEN 4 ELSE 0 END"""


@query(
    "agg_threshold",
    f"""WITH {_COUNTED} SELECT site, time, {q6("CASE WHEN n >= 22 THEN value END")} AS value, n,
      24::BIGINT AS expected, n >= 22 AS valid FROM buckets""",
)
def agg_threshold(spark, folder):
    frame = padded(spark, folder)
    return _out(aggregate.null_below_threshold(_run(frame, "mean", threshold=22), frame.spec))


@query("agg_core_flags", f"WITH {_COUNTED} SELECT site, time, n, ({_CORE})::INT AS core FROM buckets")
def agg_core_flags(spark, folder):
    frame = padded(spark, folder)
    flagged = ensure_flag_columns(_run(frame, "mean", threshold=22), ["core"])
    flagged = aggregate.set_core_after_aggregation(flagged, frame.spec, "core")
    return flagged.select("site", "time", F.col("count_value").alias("n"), "core")


@query(
    "agg_step",
    f"""WITH {_COUNTED} SELECT site, time, round_even(CASE WHEN n >= 22 THEN value END, 2) AS daily_mean,
      ({_CORE})::INT AS daily_mean_core FROM buckets""",
)
def agg_step(spark, folder):
    target = SeriesSpec(DAY, value="daily_mean")
    flags = FlagColumns({"core": "daily_mean_core"}, {"core": CORE_FLAGS})
    settings = Settings("mean", {"threshold": 22, "round": 2})
    return runner.aggregate_to(padded(spark, folder), target, settings, flags).df


@query(
    "dedupe_keep_first",
    """SELECT event_type AS site, date_trunc('hour', ts) AS time, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts, event_id) = 1""",
)
def dedupe_keep_first(spark, folder):
    from tidemark.catalog.registry import hour_of, table

    events = table(spark, folder, "events")
    rows = events.select(F.col("event_type").alias("site"), hour_of("ts").alias("time"), "ts", "event_id", "value")
    return keep_first(rows, ["site", "time"], ["ts", "event_id"]).drop("ts")


@query(
    "run_report",
    f"""WITH {PADDED} SELECT site, count(*) AS rows, count(value) AS values, count(*) - count(value) AS missing,
      count(*) FILTER (value > 100) AS removed FROM padded GROUP BY site""",
)
def run_report_query(spark, folder):
    frame = padded(spark, folder)
    flagged = frame.df.withColumn("core", F.when(F.col("value") > 100, 8).otherwise(0))
    return run_report(flagged, frame.spec, "core")


# --- Rolling -----------------------------------------------------------------------------------------------------


def _rolling_sql(before: int, after: int) -> str:
    frame = f"PARTITION BY site ORDER BY time ROWS BETWEEN {before} PRECEDING AND {after} FOLLOWING"
    return f"""WITH {PADDED}, rolled AS (SELECT site, time, avg(value) OVER ({frame}) AS mean,
      count(value) OVER ({frame}) AS n, row_number() OVER (PARTITION BY site ORDER BY time) AS up,
      row_number() OVER (PARTITION BY site ORDER BY time DESC) AS down FROM padded)
    SELECT site, time, {q6(f"CASE WHEN up > {before} AND down > {after} AND n >= 3 THEN mean END")} AS value, n
    FROM rolled"""


def _rolling(alignment: str, frame: Frame, window: str = "PT5H", threshold: int = 3):
    params = {"window_size": window, "threshold": threshold, "alignment": alignment}
    rolled = aggregate.rolling_mean(frame, Settings("rolling_mean_for_counts", params))
    return rolled.select("site", "time", r6("value").alias("value"), F.col("count_value").alias("n"))


query("rolling_center", _rolling_sql(2, 2))(lambda spark, folder: _rolling("center", padded(spark, folder)))
query("rolling_trailing", _rolling_sql(4, 0))(lambda spark, folder: _rolling("trailing", padded(spark, folder)))
query("rolling_leading", _rolling_sql(0, 4))(lambda spark, folder: _rolling("leading", padded(spark, folder)))


@query(
    "rolling_daily_month",
    f"""WITH {DAILY_PADDED}, rolled AS (SELECT site, time, avg(value) OVER w AS mean, count(value) OVER w AS n,
      row_number() OVER (PARTITION BY site ORDER BY time) AS up FROM dpadded
      WINDOW w AS (PARTITION BY site ORDER BY time ROWS BETWEEN 29 PRECEDING AND CURRENT ROW))
    SELECT site, time, {q6("CASE WHEN up > 29 AND n >= 15 THEN mean END")} AS value, n FROM rolled""",
)
def rolling_daily_month(spark, folder):
    return _rolling("trailing", daily_padded(spark, folder), "P30D", 15)


@query(
    "tail_n_per_series",
    f"""WITH {HOURLY} SELECT site, time, {q6("value")} AS value FROM hourly
    QUALIFY row_number() OVER (PARTITION BY site ORDER BY time DESC) <= 48""",
)
def tail_n_per_series(spark, folder):
    frame = hourly(spark, folder)
    numbered = number_rows(with_slot(frame.df, frame.spec), frame.spec, newest_first=True)
    return numbered.where("_row < 48").select("site", "time", r6("value").alias("value"))


@query(
    "whole_blocks_per_series",
    f"""WITH {HOURLY}, numbered AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY time DESC) - 1 AS back,
      count(*) OVER (PARTITION BY site) AS n FROM hourly)
    SELECT site, time, back // 48 AS block, {q6("value")} AS value FROM numbered WHERE back < n // 48 * 48""",
)
def whole_blocks_per_series(spark, folder):
    """Blocks of 48 rows counted back from the newest; rows older than the last whole block are left out."""
    frame = hourly(spark, folder)
    numbered = number_rows(with_slot(frame.df, frame.spec), frame.spec, newest_first=True)
    blocks = numbered.withColumn("block", F.floor(F.col("_row") / 48).cast("long"))
    whole = blocks.where(F.col("block") < F.floor(F.col("_rows") / 48))
    return whole.select("site", "time", "block", r6("value").alias("value"))
