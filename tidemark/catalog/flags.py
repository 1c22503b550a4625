"""Flag queries and despiking."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog.registry import PADDED, hourly, padded, q6, query, r6, table
from tidemark.functions.flagbits import appeared_or_vanished, changed, clear_bit, has_bit, set_bit
from tidemark.operators import despike, flagging
from tidemark.plans.run import despike_days
from tidemark.session import new_table_path
from tidemark.sources import store
from tidemark.spec import SeriesSpec

_BASE = f"""{PADDED}, f AS (SELECT *, CASE WHEN scans > 3 THEN 3 WHEN scans = 2 THEN 4 ELSE 0 END AS flag FROM padded)"""


def _flagged(spark, folder):
    """Padded rows with a flag column made from the number of scans, and a zero core flag."""
    flag = F.when(F.col("scans") > 3, 3).when(F.col("scans") == 2, 4).otherwise(0).cast("int")
    return flagging.ensure_flag_columns(padded(spark, folder).df.withColumn("flag", flag), ["core"])


def _out(df, *columns):
    return df.select("site", "time", *columns)


@query("flag_init", f"WITH {_BASE} SELECT site, time, flag::INT AS flag, 0::INT AS core, 0::INT AS qc FROM f")
def flag_init(spark, folder):
    return _out(flagging.ensure_flag_columns(_flagged(spark, folder), ["flag", "core", "qc"]), "flag", "core", "qc")


@query(
    "flag_initial_core",
    f"""WITH {_BASE} SELECT site, time, (flag | 32 | CASE WHEN value IS NULL THEN 4 ELSE 0 END)::INT AS flag FROM f""",
)
def flag_initial_core(spark, folder):
    return _out(flagging.set_initial_core(_flagged(spark, folder), "value", "flag"), "flag")


@query(
    "flag_core_correction",
    f"""WITH {_BASE} SELECT site, time, (CASE WHEN flag <> 0 AND v IS NOT NULL THEN 1 WHEN flag <> 0 THEN 64 ELSE 0 END)
      ::INT AS core FROM (SELECT *, CASE WHEN battv < 30 THEN value END AS v FROM f)""",
)
def flag_core_correction(spark, folder):
    rows = _flagged(spark, folder).withColumn("v", F.when(F.col("battv") < 30, F.col("value")))
    return _out(flagging.set_core_after_correction(rows, "v", "core", "flag"), "core")


@query(
    "flag_core_qc",
    f"WITH {_BASE} SELECT site, time, (CASE WHEN scans IS NULL THEN 36 ELSE 4 END)::INT AS core FROM f",
)
def flag_core_qc(spark, folder):
    rows = _flagged(spark, folder).withColumn("core", F.lit(36)).withColumn("qc", F.col("scans").cast("int"))
    return _out(flagging.set_core_after_qc(rows, "core", "qc"), "core")


@query(
    "flag_core_infill",
    f"WITH {_BASE} SELECT site, time, (CASE WHEN flag <> 0 THEN 6 ELSE 4 END)::INT AS core FROM f",
)
def flag_core_infill(spark, folder):
    rows = _flagged(spark, folder).withColumn("core", F.lit(4))
    return _out(flagging.set_core_after_infill(rows, "core", "flag"), "core")


@query(
    "flag_add_remove",
    f"""WITH {_BASE} SELECT site, time, (CASE WHEN value > 60 THEN flag | 8 ELSE flag END)::INT AS added,
      (CASE WHEN value > 60 THEN flag & ~1 ELSE flag END)::INT AS taken, (flag & 2) <> 0 AS has_two FROM f""",
)
def flag_add_remove(spark, folder):
    high = F.col("value") > 60
    return _flagged(spark, folder).select(
        "site",
        "time",
        set_bit("flag", 8, high).alias("added"),
        clear_bit("flag", 1, high).alias("taken"),
        has_bit("flag", 2).alias("has_two"),
    )


_BEFORE_AFTER = f"""{PADDED}, pair AS (SELECT site, time, value AS b, CASE WHEN value > 100 THEN NULL WHEN value < 20
  THEN value + 1 WHEN value IS NULL AND hour(time) < 12 THEN 5 ELSE value END AS a FROM padded)"""


def _before_after(spark, folder):
    after = (
        F.when(F.col("value") > 100, F.lit(float("nan")))
        .when(F.col("value") < 20, F.col("value") + 1)
        .when(F.col("value").isNull() & (F.hour("time") < 12), 5.0)
        .otherwise(F.col("value"))
    )
    return padded(spark, folder).df.withColumn("after", after)


@query("mask_changed", f"WITH {_BEFORE_AFTER} SELECT site, time, a IS DISTINCT FROM b AS changed FROM pair")
def mask_changed(spark, folder):
    df = _before_after(spark, folder)
    return _out(df, changed(df, "value", "after").alias("changed"))


@query("mask_infilled", f"WITH {_BEFORE_AFTER} SELECT site, time, (a IS NULL) <> (b IS NULL) AS changed FROM pair")
def mask_infilled(spark, folder):
    df = _before_after(spark, folder)
    return _out(df, appeared_or_vanished(df, "value", "after").alias("changed"))


@query(
    "flag_roles_validate",
    """WITH c AS (SELECT l_orderkey AS dataset, 'col_' || l_linenumber AS column_name,
      CASE l_returnflag WHEN 'A' THEN 'core' WHEN 'R' THEN 'infill' ELSE 'other' END AS role FROM lineitem)
    SELECT dataset, role, count(*) AS n, min(column_name) AS first_column, max(column_name) AS last_column,
      CASE WHEN role = 'other' THEN 'unknown role' ELSE 'duplicate role' END AS reason FROM c GROUP BY 1, 2
    HAVING role = 'other' OR count(*) > 1""",
)
def flag_roles_validate(spark, folder):
    """Line items as the flag columns of their order."""
    flag = F.col("l_returnflag")
    declared = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("dataset"),
        F.concat(F.lit("col_"), F.col("l_linenumber")).alias("column_name"),
        F.when(flag == "A", "core").when(flag == "R", "infill").otherwise("other").alias("role"),
    )
    return flagging.flag_role_problems(declared)


# --- Despiking ---------------------------------------------------------------------------------------------------

# Hourly flux: H and Tau per site with its radiation; one hour in five or so has no radiation.
_FLUX = """flux AS (SELECT site, time, value AS H, battv AS Tau, CASE WHEN scans <> 2 THEN scans * 9 END AS light
  FROM hourly)"""
FLUX_SPEC = SeriesSpec.of("PT1H", value="H")


def flux(spark, folder):
    rows = hourly(spark, folder).df
    light = F.when(F.col("scans") != 2, F.col("scans") * 9)
    return rows.select("site", "time", F.col("value").alias("H"), F.col("battv").alias("Tau"), light.alias("light"))


def _despike_sql(source: str, window: int, sensitivity: float, columns: dict[str, str], extra: str, where: str) -> str:
    """The despiking rule over ``source``, one column at a time: numbered back from the newest row, in whole blocks."""
    parts, joined, picked = [], "", []
    for column, name in columns.items():
        c = column.lower()
        parts.append(f"""
    diff_{c} AS (SELECT *, CASE WHEN back = 0 THEN {column} - {column} ELSE
        ({column} - CASE WHEN back = n // {window} * {window} - 1 THEN {column} ELSE lag({column}) OVER s END)
        - (lead({column}) OVER s - {column}) END AS dd FROM numbered WINDOW s AS (PARTITION BY site ORDER BY time)),
    mid_{c} AS (SELECT site, back // {window} AS block, median(CASE WHEN day THEN dd END) AS md,
        median(CASE WHEN night THEN dd END) AS mn FROM diff_{c} GROUP BY 1, 2),
    off_{c} AS (SELECT d.*, m.md, m.mn, abs(dd - md) AS ad, abs(dd - mn) AS an FROM diff_{c} d
        JOIN mid_{c} m ON m.site = d.site AND m.block = d.back // {window}),
    mad_{c} AS (SELECT site, back // {window} AS block, median(CASE WHEN day THEN ad END) AS sd,
        median(CASE WHEN night THEN an END) AS sn FROM off_{c} GROUP BY 1, 2),
    clean_{c} AS (SELECT o.site, o.time, CASE WHEN o.back < o.n // {window} * {window} AND coalesce(
        (day AND (dd < md - {sensitivity} * sd / 0.6745 OR dd > md + {sensitivity} * sd / 0.6745))
        OR (night AND (dd < mn - {sensitivity} * sn / 0.6745 OR dd > mn + {sensitivity} * sn / 0.6745)), FALSE)
        THEN NULL ELSE {column} END AS clean FROM off_{c} o
        JOIN mad_{c} m ON m.site = o.site AND m.block = o.back // {window})""")
        joined += f" JOIN clean_{c} USING (site, time)"
        picked.append(f"{q6(f'clean_{c}.clean')} AS {name}")
    return f"""{source}, numbered AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY time DESC) - 1 AS back,
      count(*) OVER (PARTITION BY site) AS n, light IS NULL OR light >= 20 AS day, light IS NULL OR light < 20 AS night
      FROM flux), {", ".join(parts)}
    SELECT site, time, {", ".join(picked)}{extra} FROM numbered {joined} WHERE {where}"""


@query(
    "mad_despike",
    f"WITH {PADDED}, " + _despike_sql(_FLUX, 72, 2.5, {"H": "H", "Tau": "Tau"}, "", "TRUE"),
)
def mad_despike(spark, folder):
    clean = despike.remove_spikes(flux(spark, folder), FLUX_SPEC, ["H", "Tau"], "light", 3, 2.5)
    return clean.select("site", "time", r6("H").alias("H"), r6("Tau").alias("Tau"))


_LOOKBACK_FLUX = _FLUX.replace(
    "FROM hourly)", "FROM hourly WHERE time >= TIMESTAMP '2024-01-05' AND time < TIMESTAMP '2024-01-23')"
)


@query(
    "mad_despike_lookback",
    f"WITH {PADDED}, "
    + _despike_sql(
        _LOOKBACK_FLUX,
        312,
        2.5,
        {"H": "H_despiked", "Tau": "Tau_L2"},
        f", {q6('CASE WHEN clean_h.clean BETWEEN -200 AND 600 THEN clean_h.clean END')} AS H_L2, {q6('H')} AS H",
        "time >= TIMESTAMP '2024-01-18'",
    ),
)
def mad_despike_lookback(spark, folder):
    """From the stored month, of which the days and their look-back are opened."""
    names = {"H": "H_despiked", "Tau": "Tau_L2"}
    base = new_table_path(spark, "flux")
    store.write_days(flux(spark, folder), base, FLUX_SPEC)
    window = dt.date(2024, 1, 18), dt.date(2024, 1, 22)
    rows = despike_days(spark, base, FLUX_SPEC, *window, ["H", "Tau"], "light", output_names=names, sensitivity=2.5)
    return rows.select("site", "time", *(r6(name).alias(name) for name in ("H", "H_despiked", "Tau_L2", "H_L2")))
