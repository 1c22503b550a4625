"""Plans made from metadata tables, for sites that differ in the shape of their plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.catalog.infills import _LINE, NEAREST
from tidemark.catalog.registry import hourly, padded, q6, query, r6, table
from tidemark.operators.align import stack_series
from tidemark.plans.from_metadata import MetadataTables, broken_rules, plans_by_kind
from tidemark.plans.runner import run_plans

# What differs between sites: rows of a gap that are filled, hours for a daily mean, hours of a moving mean.
GAP, HOURS, WINDOW = "(1 + length(site) % 3)", "(4 + 3 * (length(site) % 4))", "(3 + 2 * (length(site) % 2))"


def _metadata(sites: DataFrame) -> MetadataTables:
    """Four datasets a site: stored, filled, daily mean and moving mean of the filled one."""
    kinds = {"raw": ("value", "raw", "PT1H"), "clean": ("TA", "processed", "PT1H"), "daily": ("TA", "processed", "P1D"),
             "smooth": ("SMOOTH", "processed", "PT1H")}
    steps = [
        ("clean", 10, "load", "load", {"dep_ts": "raw"}, {}),
        ("clean", 20, "infill", "linear_interp", {}, {"max_gap_size": GAP}),
        ("daily", 10, "aggregate", "mean", {"dep_ts": "clean"}, {"threshold": HOURS}),
        ("smooth", 10, "aggregate", "rolling_mean_for_counts", {"dep_ts": "clean"},
         {"threshold": "2", "window_size": f"concat('PT', {WINDOW}, 'H')", "alignment": "'center'"}),
    ]

    def rows(listed: list[str]) -> DataFrame:
        return stack_series([sites.selectExpr(*one) for one in listed])

    name = "concat(site, '-{}') AS dataset".format
    configuration = "concat(site, '-{}-{}') AS configuration".format
    no_time = ["cast(null AS timestamp_ntz) AS start", "cast(null AS timestamp_ntz) AS `end`"]
    return MetadataTables(
        rows([(name(one), "'net' AS network", "site", f"'{variable}' AS variable", "'time' AS time_column", f"'{level}' AS processing_level",
               f"'{period}' AS periodicity", "'start' AS anchor", "cast(null AS string) AS unit") for one, (variable, level, period) in kinds.items()]),
        rows([(name(one), f"{index} AS index", configuration(one, index)) for one, index, *_ in steps]),
        rows([(name(one), "site", configuration(one, index), f"'{kind}' AS kind", "0 AS position", f"'{method}' AS method", *no_time)
              for one, index, kind, method, *_ in steps]),
        rows([(name(one), configuration(one, index), "0 AS position", f"'{parameter}' AS parameter", f"'{role}' AS role",
               f"cast({value} AS string) AS value", *no_time)
              for one, index, _, _, inputs, values in steps
              for role, parameter, value in [
                  *(("dependency", key, f"concat(site, '-{needed}')") for key, needed in inputs.items()),
                  *(("value", key, value) for key, value in values.items())]]),
        rows([(name("clean"), "'TA_FILLED' AS column_name", "'scheme' AS scheme", "'infill' AS role")]),
        rows([("'scheme' AS scheme", "'linear_interp' AS flag", "1 AS bit")]).distinct(),
    )


def _moving(hours: int) -> str:
    half = hours // 2
    return f"""CASE WHEN {WINDOW} = {hours} AND up > {half} AND down > {half} AND count(value) OVER w{hours} >= 2
      THEN avg(value) OVER w{hours} END"""


@query(
    "plan_from_metadata",
    f"""WITH {NEAREST}, clean AS (SELECT site, time, CASE WHEN value IS NULL AND h1 - h0 - 1 <= {GAP} THEN {_LINE} ELSE value END AS value
      FROM nearest),
    placed AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY time) AS up,
      row_number() OVER (PARTITION BY site ORDER BY time DESC) AS down FROM clean),
    smooth AS (SELECT site, time, coalesce({_moving(3)}, {_moving(5)}) AS value FROM placed
      WINDOW w3 AS (PARTITION BY site ORDER BY time ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING),
        w5 AS (PARTITION BY site ORDER BY time ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING))
    SELECT 'clean' AS kind, site, time, {q6("value")} AS value FROM clean
    UNION ALL SELECT 'daily', site, date_trunc('day', time)::TIMESTAMP, {q6(f"CASE WHEN count(value) >= {HOURS} THEN avg(value) END")}
      FROM clean GROUP BY site, date_trunc('day', time)
    UNION ALL SELECT 'smooth', site, time, {q6("value")} FROM smooth""",
)
def plan_from_metadata(spark, folder):
    """One network, sites of which differ in gap limit, threshold and window: a variant of each plan for each shape."""
    tables = _metadata(hourly(spark, folder).df.select("site").distinct())
    result = run_plans(plans_by_kind(tables), {"value/PT1H/raw": padded(spark, folder)})
    result.raise_if_failed()
    names = {"clean": "TA/PT1H/processed", "daily": "TA/P1D/processed", "smooth": "SMOOTH/PT1H/processed"}
    return stack_series(
        [
            result.done[name].df.select(
                F.lit(kind).alias("kind"), "site", "time", r6(result.done[name].spec.value).alias("value")
            )
            for kind, name in names.items()
        ]
    )


# Orders as datasets of sites of their own, their line items as steps, settings and arguments. What the tables hold breaks rules:
# line numbers and parts repeat within an order, and suppliers need not be orders.
_ORDER, _PART = "concat('O', {})", "concat('C', l_partkey)"
_KIND = "CASE l_returnflag WHEN 'A' THEN 'qc' WHEN 'N' THEN 'correction' ELSE 'odd' END"
_METHOD = "CASE WHEN l_linestatus = 'F' THEN 'mystery' WHEN l_returnflag = 'A' THEN 'range' ELSE 'add' END"
_ANCHOR = "CASE WHEN o_totalprice > 400000 THEN 'end' ELSE 'start' END"
_ROLE = "CASE o_orderstatus WHEN 'P' THEN 'colour' ELSE 'core' END"
_THRESHOLD = "CASE WHEN l_quantity > 45 THEN 'many' ELSE '3' END"


def _orders_as_metadata(spark, folder) -> MetadataTables:
    orders, items = table(spark, folder, "orders"), table(spark, folder, "lineitem")
    dataset, own = f"{_ORDER.format('o_orderkey')} AS dataset", f"{_ORDER.format('l_orderkey')} AS dataset"
    site, configuration = "concat('S', {}) AS site".format, f"{_PART} AS configuration"
    never = ["cast(null AS timestamp_ntz) AS start", "cast(null AS timestamp_ntz) AS `end`"]
    arguments = [
        items.selectExpr(own, configuration, "0 AS position", "'dep_ts' AS parameter", "'dependency' AS role",
                         f"{_ORDER.format('l_suppkey')} AS value", *never),
        items.selectExpr(own, configuration, "0 AS position", "'threshold' AS parameter", "'value' AS role", f"{_THRESHOLD} AS value", *never),
    ]
    return MetadataTables(
        orders.selectExpr(dataset, "'net' AS network", site("o_orderkey"), "o_orderpriority AS variable", "'time' AS time_column",
                          "'raw' AS processing_level", "'P1D' AS periodicity", f"{_ANCHOR} AS anchor", "cast(null AS string) AS unit"),
        items.selectExpr(own, "l_linenumber AS index", configuration),
        items.selectExpr(own, site("l_orderkey"), configuration, f"{_KIND} AS kind", "0 AS position", f"{_METHOD} AS method", *never),
        stack_series(arguments),
        orders.selectExpr(dataset, "'F' AS column_name", "'scheme' AS scheme", f"{_ROLE} AS role"),
        spark.createDataFrame([("scheme", "add", 1)], "scheme string, flag string, bit int"),
    )


@query(
    "metadata_broken_rules",
    f"""WITH d AS (SELECT {_ORDER.format('o_orderkey')} AS dataset, * FROM orders),
    i AS (SELECT {_ORDER.format('l_orderkey')} AS dataset, {_PART} AS configuration, {_KIND} AS kind, {_METHOD} AS method,
      {_THRESHOLD} AS threshold, {_ORDER.format('l_suppkey')} AS needed, * FROM lineitem),
    -- Methods, and their parameters, are those of datasets that exist.
    m AS (SELECT * FROM i SEMI JOIN d USING (dataset))
    SELECT DISTINCT dataset, rule, detail FROM (
      SELECT dataset, 'index used more than once' AS rule, l_linenumber::VARCHAR AS detail FROM i GROUP BY dataset, l_linenumber HAVING count(*) > 1
      UNION ALL SELECT dataset, 'unknown configuration type', kind FROM m WHERE kind = 'odd'
      UNION ALL SELECT dataset, 'unknown method', method FROM m WHERE kind <> 'odd' AND method = 'mystery'
      UNION ALL SELECT dataset, 'parameter has several values', 'threshold' FROM m GROUP BY dataset, configuration HAVING count(DISTINCT threshold) > 1
      UNION ALL SELECT dataset, 'parameter is not a number', 'threshold' FROM m WHERE threshold = 'many'
      UNION ALL SELECT dataset, 'input is not exactly one dataset', 'dep_ts' FROM i GROUP BY dataset, configuration
        HAVING count(*) <> 1 OR count(*) FILTER (needed IN (SELECT dataset FROM d)) <> 1
      UNION ALL SELECT dataset, 'flag column', 'unknown role: colour' FROM d WHERE o_orderstatus = 'P'
      UNION ALL SELECT dataset, 'differs from its kind in anchor, time column or unit', '{{"anchor":"end","time_column":"time"}}' FROM d
        WHERE o_totalprice > 400000)""",
)
def metadata_broken_rules(spark, folder):
    """Every rule that a dataset breaks, from one table."""
    return broken_rules(_orders_as_metadata(spark, folder))
