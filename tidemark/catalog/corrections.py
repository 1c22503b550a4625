"""Correction queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.alignment import heights
from tidemark.catalog.registry import MET, PADDED, column_of, met_table, padded, q6, query, r6
from tidemark.operators.flagging import FlagColumns
from tidemark.plans import runner
from tidemark.plans.methods import Frame, Settings, get_method

START, END = "2024-01-05 06:00:00", "2024-01-20 18:00:00"
MET_START, MET_END = "1997-01-01 00:00:00", "1999-12-31 00:00:00"
_IN = f"time BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"
_MET_IN = f"time BETWEEN TIMESTAMP '{MET_START}' AND TIMESTAMP '{MET_END}'"


def _simple_sql(expression: str) -> str:
    return f"""WITH {PADDED} SELECT site, time, {q6(f"CASE WHEN {_IN} THEN {expression} ELSE value END")} AS value
    FROM padded"""


def _simple(spark, folder, name, **params):
    frame = padded(spark, folder)
    df = get_method("correction", name)(frame, Settings(name, params, start=START, end=END))
    return df.select("site", "time", r6("value").alias("value"))


query("corr_add", _simple_sql("value - 40.5"))(lambda s, d: _simple(s, d, "add", correction_factor=-40.5))
query("corr_scalar", _simple_sql("value * 1.25"))(lambda s, d: _simple(s, d, "scalar", correction_factor=1.25))
query("corr_power", _simple_sql("pow(value, 1.5)"))(lambda s, d: _simple(s, d, "power", correction_factor=1.5))
query("corr_clip", _simple_sql("CASE WHEN value < 20 THEN 20 WHEN value > 90 THEN 90 ELSE value END"))(
    lambda s, d: _simple(s, d, "clip", min=20, max=90)
)


@query(
    "corr_absolute",
    f"""WITH {PADDED} SELECT site, time, {q6(f"CASE WHEN {_IN} THEN abs(value - 50) ELSE value - 50 END")} AS value
    FROM padded""",
)
def corr_absolute(spark, folder):
    frame = padded(spark, folder)
    centred = Frame(frame.df.withColumn("value", F.col("value") - 50), frame.spec)
    df = get_method("correction", "absolute")(centred, Settings("absolute", start=START, end=END))
    return df.select("site", "time", r6("value").alias("value"))


def _with_met(spark, folder, value, name, inputs, units=None, dated=True, **params):
    """Correct one weather series with others as inputs, joined on time."""
    met = met_table(spark, folder)
    # The inputs are series of their own: separate DataFrames, so they are joined.
    frames = {
        key: Frame(met.select("site", "time", column), column_of(met, column, unit=(units or {}).get(key)).spec)
        for key, column in inputs.items()
    }
    limits = {"start": MET_START, "end": MET_END} if dated else {}
    frame = Frame(met.select("site", "time", value), column_of(met, value).spec)
    df = get_method("correction", name)(frame, Settings(name, params, frames, **limits))
    return df.select("site", "time", r6(value).alias("value"))


def _met_sql(value: str, expression: str, dated: bool = True) -> str:
    chosen = f"CASE WHEN {_MET_IN} THEN {expression} ELSE {value} END" if dated else expression
    return f"WITH {MET} SELECT site, time, {q6(chosen)} AS value FROM met"


@query("corr_longwave", _met_sql("lwin", "lwout * 1.00924 + pow(ta + 273.15, 4) * 5.67e-8"))
def corr_longwave(spark, folder):
    inputs = {"lw_unc": "lwout", "ta": "ta"}
    return _with_met(spark, folder, "lwin", "lw_corr", inputs, {"ta": "unit/degc"}, correction_factor=1.00924)


@query(
    "corr_pressure",
    _met_sql("pa", "pa - 5.1 * pow(1 - (0.0065 * 74) / (ta + 0.0065 * 74 + 273.15), 5.257)"),
)
def corr_pressure(spark, folder):
    return _with_met(spark, folder, "pa", "pa_corr", {"ta": "ta"}, correction_factor=-5.1, altitude=74.0)


@query(
    "corr_wind_dir",
    f"""WITH {MET}, turned AS (SELECT site, time, 180 / pi() * atan2(ux, uy) + 90 AS angle FROM met)
    SELECT site, time, round_even(CASE WHEN angle < 0 THEN angle + 360 ELSE angle END, 5) AS value FROM turned""",
)
def corr_wind_dir(spark, folder):
    return _with_met(spark, folder, "h", "wd", {"ux": "ux", "uy": "uy"})


_BETA = """least(greatest((swin - 0.333333 * 1200 * cos(zenith)) / ((1 - 0.333333) * 1200 * cos(zenith)), 0), 1)"""


@query(
    "corr_albedo_slope",
    f"""WITH {MET}, clear AS (SELECT *, {_BETA} AS beta FROM met)
    SELECT site, time, {q6(f'''CASE WHEN {_MET_IN} THEN
      least(greatest(albedo * (1 - beta + beta * cos(zenith)) / cos(zenith - 0.3128764), 0), 1)
      ELSE albedo END''')} AS value FROM clear""",
)
def corr_albedo_slope(spark, folder):
    inputs = {"swin": "swin", "solar_zenith": "zenith"}
    return _with_met(spark, folder, "albedo", "albedo_south_slope_correction", inputs, theta_g=0.3128764)


# A factor for every site and block of five days, as calibrations give them; days between blocks have none.
_FACTORS = """factors AS (SELECT event_type AS site, time_bucket(INTERVAL 5 DAY, ts, TIMESTAMP '2024-01-01') AS "start",
    time_bucket(INTERVAL 5 DAY, ts, TIMESTAMP '2024-01-01') + INTERVAL 4 DAY AS "end", 1 + avg(value) / 100 AS factor
  FROM events GROUP BY 1, 2)"""


@query(
    "corr_by_site",
    f"""WITH {PADDED}, {_FACTORS}, f AS (SELECT p.site, p.time, p.value, p.value * f.factor AS corrected, f.factor
      FROM padded p LEFT JOIN factors f ON f.site = p.site AND p.time >= f."start" AND p.time <= f."end")
    SELECT site, time, {q6("CASE WHEN factor IS NULL THEN value ELSE corrected END")} AS value,
      (CASE WHEN corrected <> value THEN 1 ELSE 0 END)::INT AS corr FROM f""",
)
def corr_by_site(spark, folder):
    """Each site and period has a factor of its own; one job corrects them all."""
    blocks = heights(spark, folder)
    factors = blocks.select(
        "site",
        "start",
        F.expr("start + INTERVAL 4 DAYS").alias("end"),
        (F.col("height") / 100 + 1).alias("correction_factor"),
    )
    frame = padded(spark, folder)
    flags = FlagColumns({"correction": "corr"}, {"correction": {"scalar": 1}})
    corrected = runner.correct(runner.load(frame, frame.spec, flags), [Settings("scalar", by_site=factors)])
    return corrected.df.select("site", "time", r6("value").alias("value"), "corr")


@query(
    "corr_step_flags",
    f"""WITH {PADDED}, first AS (SELECT *, CASE WHEN {_IN} THEN value * 1.25 ELSE value END AS one
      FROM padded), second AS (SELECT *, CASE WHEN one < 20 THEN 20 ELSE one END AS two FROM first),
    flagged AS (SELECT site, time, two, CASE WHEN one IS NOT NULL AND value <> one THEN 1 ELSE 0 END
      + CASE WHEN one IS NOT NULL AND one <> two THEN 2 ELSE 0 END AS corr,
      32 + CASE WHEN value IS NULL THEN 4 ELSE 0 END AS core FROM second)
    SELECT site, time, {q6("two")} AS value, corr::INT AS corr,
      (core + CASE WHEN corr <> 0 AND two IS NOT NULL THEN 1 ELSE 0 END)::INT AS core FROM flagged""",
)
def corr_step_flags(spark, folder):
    frame = padded(spark, folder)
    flags = FlagColumns({"core": "core", "correction": "corr"}, {"correction": {"scalar": 1, "clip": 2}})
    series = runner.load(frame, frame.spec, flags)
    methods = [
        Settings("scalar", {"correction_factor": 1.25}, start=START, end=END),
        Settings("clip", {"min": 20}),
    ]
    return runner.correct(series, methods).df.select("site", "time", r6("value").alias("value"), "corr", "core")
