"""Padding, joins on time and interval joins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.catalog.registry import (
    DAILY,
    DAILY_SPEC,
    HOURLY,
    MET,
    PADDED,
    column_of,
    daily,
    day_of,
    hourly,
    met_table,
    padded,
    q6,
    query,
    r6,
    table,
)
from tidemark.functions.times import within_dates
from tidemark.functions.values import missing, present
from tidemark.operators import align, intervals as spans
from tidemark.plans import runner
from tidemark.plans.methods import Frame
from tidemark.sources import ancillary
from tidemark.sources.store import within_window
from tidemark.spec import anchor_from_code

HOURLY_COLUMNS = f"site, time, {q6('value')} AS value, scans, {q6('battv')} AS battv"


def _hourly_out(df):
    return df.select("site", "time", r6("value").alias("value"), "scans", r6("battv").alias("battv"))


@query("pad_series", f"WITH {PADDED} SELECT {HOURLY_COLUMNS} FROM padded")
def pad_series(spark, folder):
    frame = hourly(spark, folder)
    return _hourly_out(align.pad(frame.df, frame.spec))


@query(
    "pad_range",
    f"""WITH {HOURLY}, grid AS (SELECT site, unnest(generate_series(TIMESTAMP '2023-12-31 12:00:00',
      TIMESTAMP '2024-02-01 00:00:00', INTERVAL 1 HOUR)) AS time FROM (SELECT DISTINCT site FROM hourly))
    SELECT {HOURLY_COLUMNS} FROM grid LEFT JOIN hourly USING (site, time)""",
)
def pad_range(spark, folder):
    frame = hourly(spark, folder)
    return _hourly_out(align.pad_range(frame.df, frame.spec, "2023-12-31 12:00:00", "2024-02-01 00:00:00"))


@query(
    "load_rename",
    f"WITH {PADDED} SELECT site, time AS TIMESTAMP_END, {q6('value')} AS AIR_TEMP, scans FROM padded",
)
def load_rename(spark, folder):
    frame = padded(spark, folder)
    target = frame.spec.with_(time="TIMESTAMP_END", value="AIR_TEMP", anchor=anchor_from_code("prec"))
    loaded = runner.load(frame, target)
    scans = runner.load(Frame(frame.df, frame.spec.with_(value="scans")), target.with_(value="scans"))
    both = align.left_on_time(loaded.df, target, scans=(scans.df, scans.spec))
    return both.withColumn("AIR_TEMP", r6("AIR_TEMP"))


@query(
    "filter_interval",
    f"""WITH {HOURLY} SELECT site, time, time >= TIMESTAMP '2024-01-10' AND time <= TIMESTAMP '2024-01-12 06:00:00'
      AS inside, time >= TIMESTAMP '2024-01-20' AS after_start, time <= TIMESTAMP '2024-01-05' AS before_end,
      TRUE AS unlimited FROM hourly""",
)
def filter_interval(spark, folder):
    return hourly(spark, folder).df.select(
        "site",
        "time",
        within_dates("time", "2024-01-10 00:00:00", "2024-01-12 06:00:00").alias("inside"),
        within_dates("time", "2024-01-20 00:00:00", None).alias("after_start"),
        within_dates("time", None, "2024-01-05 00:00:00").alias("before_end"),
        within_dates("time", None, None).alias("unlimited"),
    )


@query(
    "missing_predicate",
    f"""WITH {PADDED}, marked AS (SELECT site, time, CASE WHEN value > 100 THEN 'nan'::DOUBLE ELSE value END AS v
      FROM padded) SELECT site, time, v IS NULL OR isnan(v) AS missing, v IS NOT NULL AND NOT isnan(v) AS present
    FROM marked""",
)
def missing_predicate(spark, folder):
    df = padded(spark, folder).df
    df = df.withColumn("v", F.when(F.col("value") > 100, F.lit(float("nan"))).otherwise(F.col("value")))
    return df.select("site", "time", missing(df, "v").alias("missing"), present(df, "v").alias("present"))


@query(
    "round_values",
    f"""WITH {HOURLY} SELECT site, time, round_even(value, 1) AS one, round_even(value, 0) AS none,
      round_even(value, -1) AS tens FROM hourly""",
)
def round_values(spark, folder):
    places = {"one": 1, "none": 0, "tens": -1}
    rows = hourly(spark, folder).df
    return rows.select("site", "time", *(F.bround("value", n).alias(name) for name, n in places.items()))


@query(
    "trim_to_window",
    f"""WITH {HOURLY} SELECT {HOURLY_COLUMNS} FROM hourly
    WHERE time::DATE BETWEEN DATE '2024-01-08' AND DATE '2024-01-15'""",
)
def trim_to_window(spark, folder):
    return _hourly_out(within_window(hourly(spark, folder).df, "time", "2024-01-08", "2024-01-15"))


# --- Joins -------------------------------------------------------------------------------------------------------


@query(
    "merge_series_wide",
    f"""WITH {MET},
    r AS (SELECT site, time + INTERVAL 2 DAY AS time, ta FROM met), s AS (SELECT site, time, ws FROM met WHERE ws > 4)
    SELECT site, time, {q6("m.swin")} AS swin, {q6("r.ta")} AS ta, {q6("s.ws")} AS ws FROM met m
    FULL JOIN r USING (site, time) FULL JOIN s USING (site, time)""",
)
def merge_series_wide(spark, folder):
    met = met_table(spark, folder)
    late = met.select("site", F.expr("time + INTERVAL 2 DAYS").alias("time"), "ta")
    windy = met.where("ws > 4").select("site", "time", "ws")
    frames = [(met.select("site", "time", "swin"), "swin"), (late, "ta"), (windy, "ws")]
    merged = align.merge_series([(df, DAILY_SPEC.with_(value=value)) for df, value in frames])
    return merged.select("site", "time", *(r6(name).alias(name) for name in ("swin", "ta", "ws")))


@query(
    "left_time_join",
    f"""WITH {MET}, r AS (SELECT site, time + INTERVAL 2 DAY AS time, ta FROM met)
    SELECT site, time, {q6("m.swin")} AS swin, {q6("r.ta")} AS ta FROM met m LEFT JOIN r USING (site, time)""",
)
def left_time_join(spark, folder):
    met = met_table(spark, folder)
    late = column_of(met.select("site", F.expr("time + INTERVAL 2 DAYS").alias("time"), "ta"), "ta")
    joined = align.left_on_time(met.select("site", "time", "swin"), DAILY_SPEC.with_(value="swin"), ta=late.pair())
    return joined.select("site", "time", r6("swin").alias("swin"), r6("ta").alias("ta"))


@query(
    "daily_to_hourly",
    f"""WITH {PADDED}, days AS (SELECT site, date_trunc('day', time)::DATE AS day, max(value) > 120 AS hot FROM hourly
      GROUP BY 1, 2 HAVING count(*) > 20)
    SELECT site, time, {q6("p.value")} AS value, d.hot FROM padded p
    LEFT JOIN days d USING (site) WHERE d.day = p.time::DATE
    UNION ALL SELECT site, time, {q6("p.value")}, NULL FROM padded p
    WHERE NOT EXISTS (SELECT 1 FROM days d WHERE d.site = p.site AND d.day = p.time::DATE)""",
)
def daily_to_hourly(spark, folder):
    rows = hourly(spark, folder).df.groupBy("site", day_of("time").alias("time"))
    days = rows.agg((F.max("value") > 120).alias("hot"), F.count("*").alias("n")).where("n > 20")
    frame = padded(spark, folder)
    joined = align.daily_onto_hourly(frame.df, frame.spec, days, DAILY_SPEC.with_(value="hot"), "hot")
    return joined.select("site", "time", r6("value").alias("value"), "hot")


@query(
    "union_by_name",
    f"""WITH {HOURLY}, {DAILY} SELECT site, time, {q6("value")} AS value, scans, NULL::DOUBLE AS orders FROM hourly
    UNION ALL SELECT site, time, {q6("value")}, NULL, orders FROM daily""",
)
def union_by_name(spark, folder):
    hours = hourly(spark, folder).df.select("site", "time", r6("value").alias("value"), "scans")
    days = daily(spark, folder).df.select("orders", r6("value").alias("value"), "time", "site")
    return align.stack_series([hours, days])


@query(
    "union_history",
    f"""WITH {HOURLY} SELECT site, time, {q6("value")} AS value, time >= TIMESTAMP '2024-01-20' AS is_current
    FROM hourly""",
)
def union_history(spark, folder):
    rows = hourly(spark, folder).df.select("site", "time", r6("value").alias("value"))
    history = rows.where("time < TIMESTAMP_NTZ '2024-01-20 00:00:00'").withColumn("is_current", F.lit(False))
    current = rows.where("time >= TIMESTAMP_NTZ '2024-01-20 00:00:00'").withColumn("is_current", F.lit(True))
    return history.unionByName(current)


@query(
    "load_wide_to_long",
    f"""WITH {HOURLY} SELECT site, time, variable, {q6("value")} AS value FROM (
      SELECT site, time, 'value' AS variable, value FROM hourly UNION ALL SELECT site, time, 'scans', scans FROM hourly
      UNION ALL SELECT site, time, 'battv', battv FROM hourly)""",
)
def load_wide_to_long(spark, folder):
    frame = hourly(spark, folder)
    return align.melt(frame.df, frame.spec, ["value", "scans", "battv"]).withColumn("value", r6("value"))


# --- Intervals ---------------------------------------------------------------------------------------------------

# Sensor heights: blocks of five days per site. Each but the last ends after four days, so there are gaps.
HEIGHTS = """blocks AS (SELECT event_type AS site, time_bucket(INTERVAL 5 DAY, ts, TIMESTAMP '2024-01-01') AS "start",
    avg(value) AS height FROM events GROUP BY 1, 2),
heights AS (SELECT site, "start", CASE WHEN lead("start") OVER (PARTITION BY site ORDER BY "start") IS NOT NULL
    THEN "start" + INTERVAL 4 DAY END AS "end", height FROM blocks)"""


def heights(spark, folder):
    day = F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date"))
    start = F.date_add(F.lit("2024-01-01").cast("date"), (F.floor(day / 5) * 5).cast("int")).cast("timestamp_ntz")
    blocks = table(spark, folder, "events").select(F.col("event_type").alias("site"), start.alias("start"), "value")
    blocks = blocks.groupBy("site", "start").agg(F.avg("value").alias("height"))
    has_next = F.lead("start").over(Window.partitionBy("site").orderBy("start")).isNotNull()
    return blocks.withColumn("end", F.when(has_next, F.expr("start + INTERVAL 4 DAYS")))


_ASOF = f"""WITH {PADDED}, {HEIGHTS}, matched AS (SELECT p.site, p.time, p.value, b.height, b."end"
  FROM padded p ASOF LEFT JOIN heights b ON p.site = b.site AND p.time >= b."start")
SELECT site, time, {q6("value")} AS value,
  {q6('CASE WHEN "end" IS NULL OR time < "end" THEN height END')} AS height FROM matched"""


@query("asof_interval_join", _ASOF)
def asof_interval_join(spark, folder):
    frame = padded(spark, folder)
    joined = spans.join_intervals(frame.df, frame.spec, heights(spark, folder), "height")
    return joined.select("site", "time", r6("value").alias("value"), r6("height").alias("height"))


@query("deployment_join", _ASOF)
def deployment_join(spark, folder):
    """Two platforms per site; only the anemometer's height is wanted."""
    frame = padded(spark, folder)
    both = heights(spark, folder).withColumn("platform", F.explode(F.array(F.lit("anem"), F.lit("rain"))))
    deployments = both.select(
        "site",
        F.concat_ws("-", "site", "platform", "start").alias("deployment_id"),
        "start",
        "end",
        F.when(F.col("platform") == "anem", F.col("height")).otherwise(-1.0).alias("height"),
    )
    found = align.deployment_intervals(deployments, "-anem-", "height", ["site"])
    joined = spans.join_intervals(frame.df, frame.spec, found, "height")
    return joined.select("site", "time", r6("value").alias("value"), r6("height").alias("height"))


# Soil properties per return flag and year, so that a long daily series meets several; the latest is open.
SOIL = """soil AS (SELECT l_returnflag AS site, date_trunc('year', l_shipdate)::TIMESTAMP AS "start",
    CASE WHEN lead(date_trunc('year', l_shipdate)) OVER (PARTITION BY l_returnflag ORDER BY date_trunc('year', l_shipdate))
      IS NOT NULL THEN date_trunc('year', l_shipdate)::TIMESTAMP + INTERVAL 1 YEAR END AS "end",
    10 + avg(l_discount) * 10 AS wilting_point, 40 + avg(l_tax) * 10 AS field_capacity, 58.0 AS saturation
  FROM lineitem GROUP BY l_returnflag, date_trunc('year', l_shipdate))"""


def soil(spark, folder):
    year = F.make_timestamp_ntz(F.year("l_shipdate"), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    means = table(spark, folder, "lineitem").groupBy(F.col("l_returnflag").alias("site"), year.alias("start")).agg(
        (F.avg("l_discount") * 10 + 10).alias("wilting_point"), (F.avg("l_tax") * 10 + 40).alias("field_capacity")
    )
    later = F.lead("start").over(Window.partitionBy("site").orderBy("start"))
    ends = F.when(later.isNotNull(), F.expr("start + INTERVAL 1 YEAR"))
    return means.withColumn("end", ends).withColumn("saturation", F.lit(58.0))


@query(
    "annotation_join",
    f"""WITH {MET}, {SOIL} SELECT m.site, m.time, {q6("m.vwc")} AS vwc, {q6("s.wilting_point")} AS wilting_point
    FROM met m LEFT JOIN soil s ON s.site = m.site AND m.time >= s."start" AND (s."end" IS NULL OR m.time < s."end")""",
)
def annotation_join(spark, folder):
    met = met_table(spark, folder).select("site", "time", "vwc")
    joined = spans.join_intervals(met, DAILY_SPEC.with_(value="vwc"), soil(spark, folder), "wilting_point")
    return joined.select("site", "time", r6("vwc").alias("vwc"), r6("wilting_point").alias("wilting_point"))


@query(
    "validate_intervals",
    """WITH iv AS (SELECT o_custkey AS customer, o_orderdate AS "start", CASE WHEN o_orderstatus <> 'O' THEN
        o_orderdate + INTERVAL 90 DAY END AS "end", o_orderkey AS id FROM orders),
    seen AS (SELECT *, lead("start") OVER w AS next_start, count(*) FILTER ("end" IS NULL) OVER (PARTITION BY customer)
        AS open_ends FROM iv WINDOW w AS (PARTITION BY customer ORDER BY "start", "end" NULLS LAST, id))
    SELECT customer, "start", reason FROM (SELECT *, CASE WHEN "end" IS NULL AND open_ends > 1 THEN
        'more than one open end' WHEN "end" IS NULL AND next_start IS NOT NULL THEN 'open end is not last'
        WHEN next_start < "end" THEN 'overlap' END AS reason FROM seen) WHERE reason IS NOT NULL""",
)
def validate_intervals(spark, folder):
    """Orders as intervals: 90 days, or open while the order is."""
    orders = table(spark, folder, "orders")
    end = F.when(F.col("o_orderstatus") != "O", F.expr("o_orderdate + INTERVAL 90 DAYS"))
    intervals = orders.select(F.col("o_custkey").alias("customer"), F.col("o_orderdate").alias("start"), end.alias("end"))
    return spans.invalid_intervals(intervals, ["customer"]).select("customer", "start", "reason")


@query(
    "merge_periods",
    """WITH iv AS (SELECT o_custkey AS customer, o_orderdate AS "start", o_orderdate + INTERVAL 120 DAY AS "end"
      FROM orders),
    f AS (SELECT *, CASE WHEN "start" <= max("end") OVER (PARTITION BY customer ORDER BY "start", "end"
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM iv),
    i AS (SELECT *, sum(fresh) OVER (PARTITION BY customer ORDER BY "start", "end" ROWS UNBOUNDED PRECEDING) AS island
      FROM f)
    SELECT customer, min("start") AS "start", max("end") AS "end" FROM i GROUP BY customer, island""",
)
def merge_periods(spark, folder):
    orders = table(spark, folder, "orders")
    end = F.expr("o_orderdate + INTERVAL 120 DAYS")
    periods = orders.select(F.col("o_custkey").alias("customer"), F.col("o_orderdate").alias("start"), end.alias("end"))
    return spans.merge_periods(periods, ["customer"])


# --- Tables for a flux run ---------------------------------------------------------------------------------------


@query(
    "biomet_table",
    f"""WITH {MET}, a AS (SELECT site, time, ta AS AirTemp_C FROM met), r AS (SELECT site, time, rh AS RH FROM met
      WHERE rh > 60), p AS (SELECT site, time + INTERVAL 1 DAY AS time, pa AS Pressure_Avg FROM met)
    SELECT site, time, round_even(AirTemp_C, 2) AS AirTemp_C, round_even(RH, 2) AS RH,
      round_even(Pressure_Avg, 2) AS Pressure_Avg FROM a JOIN r USING (site, time) JOIN p USING (site, time)""",
)
def biomet_table(spark, folder):
    return ancillary.biomet_table(_flux_inputs(met_table(spark, folder)))


def _flux_inputs(met):
    late = F.expr("time + INTERVAL 1 DAY").alias("time")
    return [
        (met.select("site", late, F.col("pa").alias("Pressure_Avg")), DAILY_SPEC.with_(value="Pressure_Avg")),
        (met.select("site", "time", "h"), DAILY_SPEC.with_(value="h")),
        (met.where("rh > 60").select("site", "time", F.col("rh").alias("RH")), DAILY_SPEC.with_(value="RH")),
        (met.select("site", "time", F.col("ta").alias("AirTemp_C")), DAILY_SPEC.with_(value="AirTemp_C")),
    ]


@query(
    "dynamic_metadata_table",
    f"""WITH {MET}, a AS (SELECT site, time, CASE WHEN ws > 4 THEN zenith END AS sonic_azimuth FROM met),
    c AS (SELECT site, time + INTERVAL 1 DAY AS time, q AS height_canopy FROM (SELECT site, time, h AS q FROM met
      WHERE h > 70))
    SELECT site, time, {q6("a.sonic_azimuth")} AS sonic_azimuth, {q6("c.height_canopy")} AS height_canopy
    FROM a FULL JOIN c USING (site, time) WHERE a.sonic_azimuth IS NOT NULL OR c.height_canopy IS NOT NULL""",
)
def dynamic_metadata_table(spark, folder):
    met = met_table(spark, folder)
    azimuth = F.when(F.col("ws") > 4, F.col("zenith")).alias("sonic_azimuth")
    canopy = met.where("h > 70").select(
        "site", F.expr("time + INTERVAL 1 DAY").alias("time"), F.col("h").alias("height_canopy")
    )
    frames = [
        (canopy, DAILY_SPEC.with_(value="height_canopy")),
        (met.select("site", "time", azimuth), DAILY_SPEC.with_(value="sonic_azimuth")),
    ]
    result = ancillary.instrument_table(frames)
    return result.select("site", "time", *(r6(name).alias(name) for name in ("sonic_azimuth", "height_canopy")))
