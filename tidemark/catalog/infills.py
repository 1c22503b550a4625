"""Infill queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import DAY, HOURLY_SPEC, PADDED, hour_of, padded, q6, query, r6, table
from tidemark.functions.flagbits import CORE_FLAGS
from tidemark.operators.flagging import FlagColumns
from tidemark.plans import runner
from tidemark.plans.methods import Frame, Settings, get_method

START, END = "2024-01-04 00:00:00", "2024-01-27 06:00:00"
_IN = f"time BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"

# Nearest known values either side; last_value over known rows, from the front and from the back.
NEAREST = f"""{PADDED}, nearest AS (SELECT *, epoch_us(time) / 3600000000 AS h,
    last_value(value IGNORE NULLS) OVER back AS v0,
    last_value(CASE WHEN value IS NOT NULL THEN epoch_us(time) / 3600000000 END IGNORE NULLS) OVER back AS h0,
    first_value(value IGNORE NULLS) OVER ahead AS v1,
    first_value(CASE WHEN value IS NOT NULL THEN epoch_us(time) / 3600000000 END IGNORE NULLS) OVER ahead AS h1
  FROM padded WINDOW back AS (PARTITION BY site ORDER BY time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
    ahead AS (PARTITION BY site ORDER BY time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""
_LINE = "v0 + (v1 - v0) * ((h - h0) / (h1 - h0))"

# Another series for the same sites: the number of distinct users in the hour.
ALT = """alt AS (SELECT event_type AS site, date_trunc('hour', ts) AS time, max(user_id)::DOUBLE + 1 AS users
  FROM events GROUP BY 1, 2),
shifted AS (SELECT site, time + INTERVAL 1 HOUR AS time, users FROM alt)"""


def _alternative(spark, folder) -> Frame:
    """An hour late, so that it has values where the padded series has none."""
    events = table(spark, folder, "events").select(F.col("event_type").alias("site"), hour_of("ts").alias("time"), "user_id")
    users = events.groupBy("site", "time").agg((F.max("user_id").cast("double") + 1).alias("users"))
    return Frame(users.withColumn("time", F.expr("time + INTERVAL 1 HOUR")), HOURLY_SPEC.with_(value="users"))


def _fill(frame: Frame, name: str, inputs=None, dated=False, **params):
    limits = {"start": START, "end": END} if dated else {}
    df = get_method("infill", name)(frame, Settings(name, params, inputs or {}, **limits))
    return df.select("site", "time", r6("value").alias("value"))


@query(
    "infill_linear",
    f"""WITH {NEAREST} SELECT site, time,
      {q6(f"CASE WHEN value IS NULL AND {_IN} THEN {_LINE} ELSE value END")} AS value FROM nearest""",
)
def infill_linear(spark, folder):
    return _fill(padded(spark, folder), "linear_interp", dated=True)


@query(
    "infill_linear_max_gap",
    f"""WITH {NEAREST} SELECT site, time,
      {q6(f"CASE WHEN value IS NULL AND h1 - h0 - 1 <= 1 THEN {_LINE} ELSE value END")} AS value FROM nearest""",
)
def infill_linear_max_gap(spark, folder):
    return _fill(padded(spark, folder), "linear_interp", max_gap_size=1)


@query(
    "infill_alt",
    f"""WITH {PADDED}, {ALT} SELECT p.site, p.time,
      {q6("coalesce(p.value, a.users * 0.5)")} AS value FROM padded p LEFT JOIN shifted a USING (site, time)""",
)
def infill_alt(spark, folder):
    inputs = {"alt_data_source": _alternative(spark, folder)}
    return _fill(padded(spark, folder), "alt_data", inputs, correction_factor=0.5)


# Pairs within 6 hours of the gap of each missing row; a gap starts an hour after h0 and ends an hour before h1.
_PAIRED = f"""{NEAREST}, {ALT},
both_known AS (SELECT n.site, n.h, n.value AS own, a.users AS other FROM nearest n JOIN shifted a USING (site, time)
  WHERE n.value IS NOT NULL),
gaps AS (SELECT DISTINCT site, h0, h1 FROM nearest WHERE value IS NULL),
pairs AS (SELECT g.site, g.h0, g.h1, b.h, b.own, b.other,
    CASE WHEN b.h <= g.h0 THEN g.h0 - b.h ELSE b.h - g.h1 END AS distance
  FROM gaps g JOIN both_known b ON b.site = g.site
    AND ((b.h <= g.h0 AND b.h > g.h0 - 6) OR (b.h >= g.h1 AND b.h < g.h1 + 6)))"""


def _dynamic_sql(pairs: str, least: int) -> str:
    return f"""WITH {_PAIRED}, used AS ({pairs}),
    factors AS (SELECT site, h0, h1, sum(own) / sum(other) AS factor FROM used GROUP BY 1, 2, 3
      HAVING count(*) >= {least})
    SELECT n.site, n.time, {q6("coalesce(n.value, a.users * f.factor)")} AS value FROM nearest n
    LEFT JOIN shifted a USING (site, time)
    LEFT JOIN factors f ON f.site = n.site AND f.h0 = n.h0 AND f.h1 = n.h1"""


@query("infill_alt_dynamic", _dynamic_sql("SELECT * FROM pairs", 7))
def infill_alt_dynamic(spark, folder):
    inputs = {"alt_data_source": _alternative(spark, folder)}
    return _fill(padded(spark, folder), "alt_data_dynamic", inputs, window="PT6H", min_threshold=7)


@query(
    "infill_alt_dynamic_nearest",
    _dynamic_sql(
        """SELECT * FROM pairs
        QUALIFY row_number() OVER (PARTITION BY site, h0, h1 ORDER BY distance, h) <= 5""",
        1,
    ),
)
def infill_alt_dynamic_nearest(spark, folder):
    inputs = {"alt_data_source": _alternative(spark, folder)}
    return _fill(padded(spark, folder), "alt_data_dynamic", inputs, window="PT6H", max_threshold=5)


_INFILL_FLAGS = FlagColumns({"core": "core", "infill": "infill"}, {"infill": {"linear_interp": 1, "alt_data": 2}})


@query(
    "infill_step_flags",
    f"""WITH {NEAREST}, {ALT}, one AS (SELECT site, time, value,
      CASE WHEN value IS NULL AND h1 - h0 - 1 <= 1 THEN {_LINE} ELSE value END AS line FROM nearest),
    two AS (SELECT o.*, coalesce(line, a.users * 0.5) AS both_filled FROM one o LEFT JOIN shifted a USING (site, time)),
    f AS (SELECT *, CASE WHEN value IS NULL AND line IS NOT NULL THEN 1 ELSE 0 END
      + CASE WHEN line IS NULL AND both_filled IS NOT NULL THEN 2 ELSE 0 END AS infill FROM two)
    SELECT site, time, round_even(both_filled, 3) AS value, infill::INT AS infill,
      (32 + CASE WHEN value IS NULL THEN 4 ELSE 0 END + CASE WHEN infill > 0 THEN 2 ELSE 0 END)::INT AS core FROM f""",
)
def infill_step_flags(spark, folder):
    frame = padded(spark, folder)
    series = runner.load(frame, frame.spec, _INFILL_FLAGS)
    methods = [
        Settings("linear_interp", {"max_gap_size": 1}),
        Settings("alt_data", {"correction_factor": 0.5}, {"alt_data_source": _alternative(spark, folder)}),
    ]
    df = runner.fill(series, methods).df
    return df.select("site", "time", F.bround("value", 3).alias("value"), "infill", "core")


# --- A whole plan ------------------------------------------------------------------------------------------------

_PLAN_FLAGS = FlagColumns(
    {"core": "core", "quality_control": "qc", "infill": "infill"},
    {"quality_control": {"range": 1}, "infill": {"linear_interp": 1}},
)


def hourly_plan(spark, folder):
    """Load, range check, fill single missing hours: hourly values with all their flags."""
    plan = runner.DatasetPlan(
        HOURLY_SPEC,
        (
            runner.Step("load", source="raw"),
            runner.Step("quality_control", (Settings("range", {"lt": 1, "gt": 150}),)),
            runner.Step("infill", (Settings("linear_interp", {"max_gap_size": 2}),)),
        ),
        _PLAN_FLAGS,
    )
    return plan


@query(
    "plan_end_to_end",
    f"""WITH {PADDED}, checked AS (SELECT site, time, CASE WHEN value < 1 OR value > 150 THEN NULL ELSE value END
      AS value FROM padded),
    {NEAREST.replace(PADDED + ", nearest", "nearest").replace("FROM padded", "FROM checked")},
    filled AS (SELECT site, time, CASE WHEN value IS NULL AND h1 - h0 - 1 <= 2 THEN {_LINE} ELSE value END AS value
      FROM nearest),
    daily AS (SELECT site, date_trunc('day', time)::TIMESTAMP AS time, avg(value) AS value, count(value) AS n
      FROM filled GROUP BY 1, 2)
    SELECT site, time, round_even(CASE WHEN n >= 20 THEN value END, 3) AS daily_mean,
      (CASE WHEN n <> 24 AND n >= 20 THEN 2 WHEN n <> 24 AND n > 0 THEN 8 ELSE 0 END
       + CASE WHEN n = 0 THEN 4 ELSE 0 END)::INT AS daily_core FROM daily""",
)
def plan_end_to_end(spark, folder):
    daily = runner.DatasetPlan(
        HOURLY_SPEC.with_(period=DAY, value="daily_mean"),
        (
            runner.Step(
                "aggregation", (Settings("mean", {"threshold": 20, "round": 3}),), source="hourly"
            ),
        ),
        FlagColumns({"core": "daily_core"}, {"core": CORE_FLAGS}),
    )
    plans = {"daily": daily, "hourly": hourly_plan(spark, folder)}
    result = runner.run_plans(plans, {"raw": padded(spark, folder)})
    result.raise_if_failed()
    return result.done["daily"].df
