"""Derivation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.catalog.alignment import SOIL, soil
from tidemark.catalog.registry import (
    DAILY_SPEC,
    HOURLY,
    HOURLY_SPEC,
    MET,
    PADDED,
    column_of,
    day_of,
    hourly,
    met_table,
    padded,
    q6,
    query,
    r6,
    table,
)
from tidemark.functions.flagbits import CORE_FLAGS
from tidemark.operators.flagging import FlagColumns
from tidemark.plans import runner
from tidemark.plans.methods import Frame, Settings, get_method
from tidemark.spec import SeriesSpec

RESULT = DAILY_SPEC.with_(value="value")


def _derive(met, name, inputs, **params):
    settings = Settings(name, params, {key: column_of(met, column) for key, column in inputs.items()})
    return get_method("derivation", name)(settings, RESULT)


def _register(name, method, inputs, expression, **params):
    """A derivation of weather columns: ``inputs`` maps input names to columns, ``expression`` says the same in SQL."""

    def run(spark, folder):
        df = _derive(met_table(spark, folder), method, inputs, **params)
        return df.select("site", "time", r6("value").alias("value"))

    query(name, f"WITH {MET} SELECT site, time, {q6(expression)} AS value FROM met")(run)


def _same(*names):
    return {name: name for name in names}


_register(
    "derive_net_radiation", "calculate_rn", _same("swin", "swout", "lwin", "lwout"), "swin - swout + lwin - lwout"
)
_register("derive_mean_shf", "calc_flux_mean_shf", _same("g1", "g2"), "(g1 + g2) / 2")
_register("derive_mean_g", "calc_mean_g", _same("g1", "g2"), "(g1 + g2) / 2")
_register(
    "derive_mslp",
    "calculate_mslp",
    _same("pa", "ta"),
    "pa / pow(1 - 0.0065 * 74 / (ta + 0.0065 * 74 + 273.15), 5.257)",
    altitude=74.0,
)
_ES = "0.6108 * exp(17.27 * ta / (ta + 237.3))"
_SLOPE, _GAMMA, _WIND = f"(4098 * {_ES} / pow(ta + 237.3, 2))", "(0.000665 * pa / 10)", "(4.87 * ws / ln(67.8 * 2.5 - 5.42))"
_register(
    "derive_pe",
    "calculate_pe",
    {"rn": "swin", "g": "g1"} | _same("ta", "rh", "ws", "pa"),
    f"""(0.408 * {_SLOPE} * (swin - g1) * 0.0018 + {_GAMMA} * 18.5 / (ta + 273) * {_WIND} * {_ES} * (1 - rh / 100))
      / ({_SLOPE} + {_GAMMA} * (1 + 0.34 * {_WIND}))""",
    wind_height=2.5,
)
_register("derive_et", "latent_heat_to_et", _same("le", "ta"), "le * 1800 / ((2.501 - 0.002361 * ta) * 1e6)")
_register(
    "derive_et_l1",
    "calc_flux_et_l1",
    {"latent_heat_flux": "le", "ta": "ta"},
    "le * 1800 / ((2.501 - 0.002361 * ta) * 1e6)",
)
_register(
    "derive_abs_humidity",
    "calculate_q",
    _same("ta", "rh"),
    f"{_ES} * 1000 * rh / 100 / (461.5 * (ta + 273.15)) * 1000",
)
_register(
    "derive_albedo",
    "calc_albedo",
    {"swin": "swin", "swout": "swout", "solar_zenith": "zenith"},
    "CASE WHEN zenith < pi() / 2 THEN swout / swin END",
)
_register(
    "derive_factor_intensity",
    "calc_factor_inten",
    {"crns_count": "counts"},
    "1 / (1 + 0.95 * (counts / 2100 - 1))",
    ref_c0=2100,
    gamma=0.95,
)
_register("derive_factor_humidity", "calc_factor_q", {"q": "g1"}, "1 + 0.0054 * (g1 - 8)", ref_q0=8)
_register("derive_factor_pressure", "calc_factor_PA", _same("pa"), "exp((pa - 1013.25) / 130)", l=130)
_register(
    "derive_correct_counts",
    "correct_counts",
    {"cts_mod": "counts", "cosmosfactor_inten": "albedo", "cosmosfactor_pa": "ws", "cosmosfactor_q": "zenith"},
    "counts * albedo * ws * zenith",
)
_register(
    "derive_latent_heat",
    "calc_flux_le_l1",
    {"rn": "swin", "g": "g1", "h": "h"},
    "swin - g1 - h",
)
_SITE = {"ref_soc": 0.032, "ref_bulkdensity": 1.06, "ref_latticewater": 0.025}
_COUNTS = {"n0_mod": 2710.0, "n_min": 1300.0, "n_max": 2281.0}
_VWC = "((0.0808 / ({c} / 2710 - 0.372) - 0.115) - 0.025 - 0.032) * 1.06 * 100"
_register(
    "derive_vwc",
    "calculate_vwc",
    {"cts_mod_corr": "counts"},
    f"CASE WHEN counts BETWEEN 1300 AND 2281 THEN {_VWC.format(c='counts')} END",
    **_SITE,
    **_COUNTS,
)
_FLOOR = "(0.24 * 2710)"
_register(
    "derive_swe",
    "calculate_crns_swe",
    {"cts_smo": "counts", "cts_est": "swin"},
    f"CASE WHEN (counts - {_FLOOR}) / (swin - {_FLOOR}) > 0 THEN -48 * ln((counts - {_FLOOR}) / (swin - {_FLOOR})) END",
    n0_mod=2710,
)
_register(
    "derive_swe_sigma",
    "calculate_crns_sigma_swe",
    {"cts_smo": "counts", "cts_est": "swin"},
    f"48 * sqrt(counts / pow(counts - {_FLOOR}, 2) + swin / pow(swin - {_FLOOR}, 2))",
    n0_mod=2710,
)
_ATTENUATION = """1 / (1 / 1144.0::DOUBLE + (1 / 141.0::DOUBLE - 1 / 1144.0::DOUBLE)
  * pow(1 + exp(-(swin / counts - 0.313) / 0.082), -1.117))"""
_register(
    "derive_swe_buried",
    "calculate_snowfox_swe",
    {"cts_smo": "swin", "cts_est": "counts"},
    f"-ln(swin / counts) * ({_ATTENUATION})",
)
_register(
    "derive_swe_buried_sigma",
    "calculate_snowfox_sigma_swe",
    {"cts_smo": "swin", "cts_est": "counts"},
    f"sqrt(1 / swin + 1 / counts) * ({_ATTENUATION})",
)
_register(
    "derive_eff_depth",
    "calculate_eff_depth",
    {"cosmos_vwc": "vwc"},
    "5.8 / (1.06 * (0.032 + 0.025) + vwc / 100 + 0.0829)",
    **_SITE,
)
_WATER = "(vwc / 100 + 1.06 * (0.032 + 0.025))"
_register(
    "derive_d86",
    "calculate_d86",
    {"cosmos_vwc": "vwc", "pa": "pa"},
    f"""(8.321 + 0.14249 * (0.96655 + exp(-0.01 * 5 / (0.5 / (0.86 - exp(-pa / 1013.25))))) * (20 + {_WATER})
      / (0.0429 + {_WATER})) / 1.06""",
    **_SITE,
    distance=5,
)
_register("derive_water_level", "distance_to_level", {"dist_to_water": "ws"}, "3.5 - ws", sensor_height=3.5)


@query(
    "derive_snow_day",
    f"WITH {MET} SELECT site, time, albedo >= 0.4 AND albedo <= 0.9 AS value FROM met",
)
def derive_snow_day(spark, folder):
    met = met_table(spark, folder)
    limits = {"albedo_min_threshold": 0.4, "albedo_max_threshold": 0.9}
    return _derive(met, "is_snow_day", {"albedo": "albedo"}, **limits)


def _separate(met, column, where, days=0):
    """A column as a series of its own, on some of the days, so that inputs really have to be joined."""
    time = F.expr(f"time + INTERVAL {days} DAYS").alias("time")
    return column_of(met.where(where).select("site", time, column), column)


@query(
    "derive_precip_tipping",
    f"""WITH {MET}, a AS (SELECT site, time, ws FROM met WHERE ws > 3), b AS (SELECT site, time + INTERVAL 1 DAY AS time,
      g1 FROM met WHERE g1 > 8)
    SELECT site, time, {q6("greatest(ws, g1)")} AS value FROM a FULL JOIN b USING (site, time)""",
)
def derive_precip_tipping(spark, folder):
    met = met_table(spark, folder)
    inputs = {"precip_tipping_a": _separate(met, "ws", "ws > 3"), "precip_tipping_b": _separate(met, "g1", "g1 > 8", 1)}
    df = get_method("derivation", "get_precip_tipping")(Settings("get_precip_tipping", {}, inputs), RESULT)
    return df.select("site", "time", r6("value").alias("value"))


@query(
    "derive_vwc_snow",
    f"""WITH {MET}, e AS (SELECT site, time, counts * 0.9 AS est FROM met WHERE albedo > 0.6),
    c AS (SELECT site, time, coalesce(e.est, m.counts) AS c FROM met m FULL JOIN e USING (site, time))
    SELECT site, time, {q6(f"CASE WHEN c BETWEEN 1300 AND 2281 THEN {_VWC.format(c='c')} END")} AS value FROM c""",
)
def derive_vwc_snow(spark, folder):
    met = met_table(spark, folder)
    snowy = met.where("albedo > 0.6").select("site", "time", (F.col("counts") * 0.9).alias("est"))
    inputs = {"cts_est": column_of(snowy, "est"), "cts_mod_corr": column_of(met, "counts")}
    settings = Settings("calculate_vwc_with_snow", _SITE | _COUNTS, inputs)
    df = get_method("derivation", "calculate_vwc_with_snow")(settings, RESULT)
    return df.select("site", "time", r6("value").alias("value"))


@query(
    "derive_smi",
    f"""WITH {MET}, {SOIL}, j AS (SELECT m.site, m.time, m.vwc, s.* EXCLUDE (site) FROM met m LEFT JOIN soil s
      ON s.site = m.site AND m.time >= s."start" AND (s."end" IS NULL OR m.time < s."end"))
    SELECT site, time, {q6('''CASE WHEN saturation IS NULL THEN NULL ELSE (CASE WHEN vwc > saturation THEN saturation
      ELSE vwc END - wilting_point) / (field_capacity - wilting_point) END''')} AS value FROM j""",
)
def derive_smi(spark, folder):
    properties = soil(spark, folder)
    names = {
        "vwc_wilting_point": "wilting_point",
        "vwc_field_capacity": "field_capacity",
        "vwc_saturation": "saturation",
    }
    attributes = {name: column_of(properties, column) for name, column in names.items()}
    df = _derive(met_table(spark, folder), "calculate_smi", {"cosmos_vwc": "vwc"}, **attributes)
    return df.select("site", "time", r6("value").alias("value"))


@query(
    "derive_solar_zenith",
    """WITH places AS (SELECT n_name AS site, 50 + avg(c_acctbal) / 1000 AS lat
      FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
    grid AS (SELECT site, lat, unnest(generate_series(TIMESTAMP '2024-06-01', TIMESTAMP '2024-06-11',
      INTERVAL 30 MINUTE)) AS time FROM places),
    sun AS (SELECT site, time, radians(lat) AS phi, 0.409 * sin(2 * pi() / 365 * dayofyear(time) - 1.39) AS decl,
      pi() / 12 * (hour(time) + minute(time) / 60 - 12) AS turn FROM grid)
    SELECT site, time, round_even(acos(sin(phi) * sin(decl) + cos(phi) * cos(decl) * cos(turn)), 6) AS value
    FROM sun""",
)
def derive_solar_zenith(spark, folder):
    nations = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    customers = table(spark, folder, "customer").join(nations, "c_nationkey")
    places = customers.groupBy(F.col("n_name").alias("site")).agg((F.avg("c_acctbal") / 1000 + 50).alias("lat"))
    target = SeriesSpec.of("PT30M")
    window = {"load_start": "2024-06-01 00:00:00", "load_end": "2024-06-11 00:00:00"}
    params = window | {"sites": Frame(places, target.with_(value="lat"))}
    df = get_method("derivation", "solar_zenith")(Settings("solar_zenith", params), target)
    return df.select("site", "time", r6("value").alias("value"))


# A day counts as snow if its largest hourly reading is high.
_SNOW = f"""{PADDED}, days AS (SELECT site, date_trunc('day', time)::DATE AS day, max(value) > 180 AS snow FROM hourly
  GROUP BY 1, 2),
lying AS (SELECT p.site, p.time, p.value, coalesce(d.snow, FALSE) AS snow FROM padded p
  LEFT JOIN days d ON d.site = p.site AND d.day = p.time::DATE),
runs AS (SELECT *, count(*) FILTER (NOT snow AND value IS NOT NULL) OVER (PARTITION BY site ORDER BY time
  ROWS UNBOUNDED PRECEDING) AS run FROM lying),
est AS (SELECT *, max(value) OVER (PARTITION BY site, run ORDER BY time ROWS UNBOUNDED PRECEDING) AS est FROM runs)"""


@query(
    "snow_estimated_counts",
    f"""WITH {_SNOW} SELECT site, time, {q6("CASE WHEN snow AND run > 0 THEN est END")} AS value FROM est""",
)
def snow_estimated_counts(spark, folder):
    days = hourly(spark, folder).df.groupBy("site", day_of("time").alias("time"))
    snow = Frame(days.agg((F.max("value") > 180).alias("snow")), DAILY_SPEC.with_(value="snow"))
    settings = Settings("get_snow_estimated_counts", {}, {"cts_smo": padded(spark, folder), "snow": snow})
    df = get_method("derivation", "get_snow_estimated_counts")(settings, HOURLY_SPEC)
    return df.select("site", "time", r6("value").alias("value"))


@query(
    "derive_step_flags",
    f"""WITH {PADDED}, {HOURLY.replace("hourly AS", "again AS")}
    SELECT p.site, p.time, round_even(p.value - a.battv, 2) AS net,
      (CASE WHEN p.value IS NULL OR a.battv IS NULL THEN 4 ELSE 0 END)::INT AS net_core
    FROM padded p LEFT JOIN again a USING (site, time)""",
)
def derive_step_flags(spark, folder):
    frame = padded(spark, folder)
    target = HOURLY_SPEC.with_(value="net")
    inputs = {
        "rn": frame,
        "g": Frame(frame.df, frame.spec.with_(value="battv")),
        "h": Frame(frame.df.withColumn("zero", F.lit(0.0)), frame.spec.with_(value="zero")),
    }
    settings = Settings("calc_flux_le_l2", {"round": 2}, inputs)
    return runner.derive_to(settings, target, FlagColumns({"core": "net_core"}, {"core": CORE_FLAGS})).df
