"""Quality control queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.registry import MET, PADDED, column_of, hourly, met_table, padded, q6, query, r6, table
from tidemark.functions.flagbits import set_bit
from tidemark.operators import flagging
from tidemark.operators.flagging import FlagColumns
from tidemark.operators.quality import FAILED
from tidemark.plans import runner
from tidemark.plans.methods import Frame, Settings, get_method
from tidemark.sources.manualflags import parse_manual_flags

START, END = "2024-01-03 00:00:00", "2024-01-25 12:00:00"
_IN = f"time BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"


def _check(frame: Frame, name: str, inputs=None, dated=True, value="value", **params):
    limits = {"start": START, "end": END} if dated else {}
    df = get_method("quality_control", name)(frame, Settings(name, params, inputs or {}, **limits))
    return df.select("site", "time", r6(value).alias("value"), F.col(FAILED).alias("failed"))


def _sql(failed: str, dated: bool = True) -> str:
    chosen = f"CASE WHEN {_IN} THEN {failed} ELSE FALSE END" if dated else failed
    return f"WITH {PADDED} SELECT site, time, {q6('value')} AS value, {chosen} AS failed FROM padded"


query("qc_range", _sql("value < 10 OR value > 90"))(lambda s, d: _check(padded(s, d), "range", lt=10, gt=90))
query("qc_time_of_day", _sql("time::TIME BETWEEN TIME '01:00:00' AND TIME '03:00:00'"))(
    lambda s, d: _check(padded(s, d), "hfp_removal", time_ge="01:00:00", time_le="03:00:00")
)


@query(
    "qc_error_code",
    f"""WITH {PADDED} SELECT site, time, {q6("scans")} AS value, CASE WHEN {_IN} THEN scans IN (1, 7) ELSE FALSE END
      AS failed FROM padded""",
)
def qc_error_code(spark, folder):
    frame = padded(spark, folder, "scans")
    df = get_method("quality_control", "error_code")(frame, Settings("error_code", {"value": [1, 7]}, {}, START, END))
    return df.select("site", "time", r6("scans").alias("value"), F.col(FAILED).alias("failed"))


_NEIGHBOURS = f"""{PADDED}, near AS (SELECT *, value - lag(value) OVER w AS rise, lead(value) OVER w - value AS fall
  FROM padded WINDOW w AS (PARTITION BY site ORDER BY time))"""
_SPIKE = """CASE WHEN rise IS NULL OR fall IS NULL THEN NULL
  ELSE rise * fall < 0 AND least(abs(rise), abs(fall)) > 40 END"""


@query(
    "qc_spike",
    f"""WITH {_NEIGHBOURS} SELECT site, time, {q6("value")} AS value,
      CASE WHEN {_IN} THEN {_SPIKE} ELSE FALSE END AS failed FROM near""",
)
def qc_spike(spark, folder):
    return _check(padded(spark, folder), "spike", gt=40)


def _aligned_sql(failed: str, dated: bool = True) -> str:
    """The companion is the hourly table itself, an hour late, so some rows find nothing."""
    chosen = f"CASE WHEN {_IN} THEN {failed} ELSE FALSE END" if dated else failed
    return f"""WITH {PADDED}, late AS (SELECT site, time + INTERVAL 1 HOUR AS time, value AS other, scans, battv
      FROM hourly), checked AS (SELECT site, time, {chosen} AS failed FROM late)
    SELECT p.site, p.time, {q6("p.value")} AS value, c.failed FROM padded p LEFT JOIN checked c USING (site, time)"""


def _late(spark, folder, value):
    frame = hourly(spark, folder, value)
    return Frame(frame.df.withColumn("time", F.expr("time + INTERVAL 1 HOUR")), frame.spec)


def _aligned(spark, folder, name, input_name, value, dated=True, **params):
    return _check(padded(spark, folder), name, {input_name: _late(spark, folder, value)}, dated, **params)


query("qc_battery", _aligned_sql("battv < 8"))(
    lambda s, d: _aligned(s, d, "battery_v", "battv", "battv", lt=8)
)
query("qc_samples", _aligned_sql("scans < 2"))(lambda s, d: _aligned(s, d, "samples", "scans", "scans", lt=2))
query("qc_signal", _aligned_sql("scans < 3"))(
    lambda s, d: _aligned(s, d, "snowd_signal", "signal_quality", "scans", lt=3)
)
query("qc_soil_temp", _aligned_sql("battv < 5"))(
    lambda s, d: _aligned(s, d, "tdt_tsoil", "soil_ta", "battv", lt=5)
)
query("qc_diagnostic", _aligned_sql("scans > 3"))(
    lambda s, d: _aligned(s, d, "pluvio_diag", "sensor_diag", "scans", gt=3)
)
query("qc_sensor_temp", _aligned_sql("battv < 4 OR battv > 60"))(
    lambda s, d: _aligned(s, d, "nr01_temp", "sensor_ta", "battv", lt=4, gt=60)
)
query("qc_flux_flag", _aligned_sql("scans = 2", dated=False))(
    lambda s, d: _aligned(s, d, "flux_qc_flag", "qc_flag", "scans")
)


@query(
    "qc_align",
    f"""WITH {MET}, late AS (SELECT site, time + INTERVAL 3 DAY AS time, ws < 4 AS failed FROM met)
    SELECT m.site, m.time, {q6("m.swin")} AS value, l.failed FROM met m LEFT JOIN late l USING (site, time)""",
)
def qc_align(spark, folder):
    met = met_table(spark, folder)
    late = column_of(met.withColumn("time", F.expr("time + INTERVAL 3 DAYS")), "ws")
    frame = column_of(met, "swin")
    return _check(frame, "battery_v", {"battv": late}, dated=False, value="swin", lt=4)


# The hand-kept list: a period for every day whose smallest reading is low, marked for value or for all variables.
MANUAL = """listed AS (
  SELECT lower(event_type) AS SITE_ID,
         CASE WHEN min(value) < 0.2 THEN 'All' WHEN min(value) < 0.6 THEN ' value ; scans;' ELSE 'battv;;scans' END
           AS VARIABLES_AFFECTED,
         strftime(date_trunc('day', ts)::TIMESTAMP + INTERVAL 3 HOUR, '%Y-%m-%d %H:%M:%S') AS START_DATETIME,
         CASE WHEN date_trunc('day', ts) < TIMESTAMP '2024-01-29' THEN
           strftime(date_trunc('day', ts)::TIMESTAMP + INTERVAL 29 HOUR, '%Y-%m-%d %H:%M:%S') END AS END_DATETIME
  FROM events GROUP BY event_type, date_trunc('day', ts) HAVING min(value) < 1),
manual AS (SELECT upper(trim(SITE_ID)) AS site, upper(trim(unnest(string_split(VARIABLES_AFFECTED, ';')))) AS variable,
    START_DATETIME::TIMESTAMP AS "start", END_DATETIME::TIMESTAMP AS "end" FROM listed),
periods AS (SELECT * FROM manual WHERE variable <> '')"""


def manual_list(spark, folder):
    """The list as the file would hold it, all text."""
    days = table(spark, folder, "events").groupBy("event_type", F.to_date("ts").alias("day"))
    lows = days.agg(F.min("value").alias("low")).where("low < 1").withColumn("from", F.col("day").cast("timestamp_ntz"))
    names = F.when(F.col("low") < 0.2, "All").when(F.col("low") < 0.6, " value ; scans;").otherwise("battv;;scans")
    written = "yyyy-MM-dd HH:mm:ss"
    return lows.select(
        F.lower("event_type").alias("SITE_ID"),
        names.alias("VARIABLES_AFFECTED"),
        F.date_format(F.expr("from + INTERVAL 3 HOURS"), written).alias("START_DATETIME"),
        F.when(F.col("day") < "2024-01-29", F.date_format(F.expr("from + INTERVAL 29 HOURS"), written)).alias(
            "END_DATETIME"
        ),
    )


@query(
    "qc_manual_removal",
    f"""WITH {PADDED}, {MANUAL} SELECT site, time, {q6("value")} AS value, EXISTS (
      SELECT 1 FROM periods m WHERE m.site = upper(p.site) AND m.variable IN ('VALUE', 'ALL')
        AND p.time >= m.start AND (m.end IS NULL OR p.time <= m.end)) AS failed FROM padded p""",
)
def qc_manual_removal(spark, folder):
    frame = padded(spark, folder)
    periods = Frame(parse_manual_flags(manual_list(spark, folder)), frame.spec)
    return _check(frame, "manual_removal", {"periods": periods}, dated=False)


_LIMITS = """limits AS (SELECT event_type AS site, avg(value) / 4 AS lt, avg(value) * 2 AS gt FROM events
  WHERE event_type <> 'view' GROUP BY 1)"""


@query(
    "qc_range_by_site",
    f"""WITH {PADDED}, {_LIMITS} SELECT p.site, p.time,
      {q6("CASE WHEN coalesce(value < lt OR value > gt, FALSE) THEN NULL ELSE value END")} AS value,
      (CASE WHEN value < lt OR value > gt THEN 1 ELSE 0 END)::INT AS qc FROM padded p LEFT JOIN limits l USING (site)""",
)
def qc_range_by_site(spark, folder):
    """Limits of each site from its own mean; one site has none and is not checked."""
    events = table(spark, folder, "events").where("event_type <> 'view'")
    means = events.groupBy(F.col("event_type").alias("site")).agg(F.avg("value").alias("mean"))
    always = F.lit(None).cast("timestamp_ntz")
    limits = means.select(
        "site", always.alias("start"), always.alias("end"), (F.col("mean") / 4).alias("lt"), (F.col("mean") * 2).alias("gt")
    )
    frame = padded(spark, folder)
    flags = FlagColumns({"quality_control": "qc"}, {"quality_control": {"range": 1}})
    checked = runner.check(runner.load(frame, frame.spec, flags), [Settings("range", by_site=limits)])
    return checked.df.select("site", "time", r6("value").alias("value"), "qc")


# --- Steps -------------------------------------------------------------------------------------------------------

_QC_FLAGS = FlagColumns(
    {"core": "core", "quality_control": "qc"}, {"quality_control": {"range": 1, "spike": 2, "samples": 4}}
)
_CHECKED = f"""{_NEIGHBOURS}, low AS (SELECT site, time, scans < 2 AS few FROM hourly),
checked AS (SELECT n.site, n.time, n.value,
    CASE WHEN n.value < 10 OR n.value > 90 THEN 1 ELSE 0 END
    + CASE WHEN rise * fall < 0 AND least(abs(rise), abs(fall)) > 40 THEN 2 ELSE 0 END
    + CASE WHEN few THEN 4 ELSE 0 END AS qc FROM near n LEFT JOIN low USING (site, time))"""


def _loaded(spark, folder):
    frame = padded(spark, folder)
    return runner.load(frame, frame.spec, _QC_FLAGS)


def _methods(spark, folder):
    return [
        Settings("range", {"lt": 10, "gt": 90}),
        Settings("spike", {"gt": 40}),
        Settings("samples", {"lt": 2}, {"scans": hourly(spark, folder, "scans")}),
    ]


def _flagged(df):
    return df.select("site", "time", r6("value").alias("value"), "qc", "core")


@query(
    "qc_step_flags",
    f"""WITH {_CHECKED} SELECT site, time, {q6("value")} AS value, qc::INT AS qc,
      (CASE WHEN value IS NULL THEN 4 ELSE 0 END)::INT AS core FROM checked""",
)
def qc_step_flags(spark, folder):
    series = runner.check(_loaded(spark, folder), _methods(spark, folder), remove=False)
    return _flagged(series.df)


_REMOVED = f"""WITH {_CHECKED} SELECT site, time, {q6("CASE WHEN qc = 0 THEN value END")} AS value, qc::INT AS qc,
  (CASE WHEN value IS NULL THEN 4 ELSE 0 END + CASE WHEN qc > 0 AND value IS NOT NULL THEN 8 ELSE 0 END)::INT AS core
  FROM checked"""


@query("qc_multi_block", _REMOVED)
def qc_multi_block(spark, folder):
    """Two blocks of checks in a row: nothing is removed before the second has seen it."""
    methods = _methods(spark, folder)
    plan = runner.DatasetPlan(
        padded(spark, folder).spec,
        (
            runner.Step("load", source="raw"),
            runner.Step("quality_control", tuple(methods[:1])),
            runner.Step("quality_control", tuple(methods[1:])),
        ),
        _QC_FLAGS,
    )
    return _flagged(runner.run_plan(plan, {"raw": padded(spark, folder)}).df)


@query(
    "qc_remove_flagged",
    f"""WITH {PADDED}, f AS (SELECT *, CASE WHEN scans < 2 OR scans IS NULL THEN 4 ELSE 0 END AS qc FROM padded)
    SELECT site, time, {q6("CASE WHEN qc > 0 THEN NULL ELSE value END")} AS value, qc::INT AS qc,
      (CASE WHEN qc > 0 AND value IS NOT NULL THEN 8 ELSE 0 END)::INT AS core FROM f""",
)
def qc_remove_flagged(spark, folder):
    frame = padded(spark, folder)
    few = (F.col("scans") < 2) | F.col("scans").isNull()
    flagged = flagging.ensure_flag_columns(frame.df, ["qc", "core"]).withColumn("qc", set_bit("qc", 4, few))
    return _flagged(flagging.remove_flagged(flagged, "value", "qc", "core"))
