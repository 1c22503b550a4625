"""Reading and writing: each query writes what it reads to the shared folder first, from the tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog.quality import MANUAL, manual_list
from tidemark.catalog.registry import DAILY_SPEC, HOURLY, HOURLY_SPEC, hour_of, hourly, q6, query, r6, table
from tidemark.operators.flagging import FlagColumns
from tidemark.plans.methods import Settings
from tidemark.plans.run import Stored, process_window
from tidemark.plans.runner import DatasetPlan, Step
from tidemark.session import new_table_path
from tidemark.sources import fluxfiles, metadata, store
from tidemark.sources.manualflags import read_manual_flags

_COLUMNS = f"site, time, {q6('value')} AS value, scans"


def _rows(spark, folder):
    return hourly(spark, folder).df.select("site", "time", r6("value").alias("value"), "scans")


def _stored(spark, folder, name):
    """The hourly table as a day-partitioned store."""
    base = new_table_path(spark, name)
    store.write_days(_rows(spark, folder), base, HOURLY_SPEC)
    return base


@query(
    "scan_date_range",
    f"WITH {HOURLY} SELECT {_COLUMNS} FROM hourly WHERE time::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-11'",
)
def scan_date_range(spark, folder):
    base = _stored(spark, folder, "scan")
    days = store.read_days(spark, base, dt.date(2024, 1, 5), dt.datetime(2024, 1, 11, 3))
    return days.select("site", "time", "value", "scans")


@query("scan_empty_window", f"WITH {HOURLY} SELECT site, count(*) FILTER (time::DATE = DATE '2031-05-01') AS n FROM hourly GROUP BY site")
def scan_empty_window(spark, folder):
    """Rows of each site in days nobody has stored, and where nothing is stored."""
    base = _stored(spark, folder, "scan")
    days = store.read_days(spark, base, "2031-05-01", "2031-05-03").select("site", "time", "value", "scans")
    nothing = store.read_days(spark, new_table_path(spark, "nothing"), "2031-05-01", "2031-05-03", schema=days.schema)
    found = days.unionByName(nothing).select("site", F.lit(1).alias("one"))
    sites = _rows(spark, folder).select("site").distinct()
    return sites.join(found, "site", "left").groupBy("site").agg(F.count("one").alias("n"))


@query("scan_select_existing", f"WITH {HOURLY} SELECT site, time, scans FROM hourly")
def scan_select_existing(spark, folder):
    base = _stored(spark, folder, "scan")
    return store.read_days(spark, base, columns=["site", "time", "no_such_column", "scans"])


@query(
    "scan_merge_schema",
    f"""WITH {HOURLY} SELECT site, time, CASE WHEN time < TIMESTAMP '2024-01-15' THEN {q6('value')} END AS value, scans,
      CASE WHEN time >= TIMESTAMP '2024-01-15' THEN {q6('battv')} END AS battv FROM hourly""",
)
def scan_merge_schema(spark, folder):
    """Files of the first half of the month lack one column, those of the second another."""
    base = new_table_path(spark, "merge")
    rows = hourly(spark, folder).df.withColumns({"value": r6("value"), "battv": r6("battv")})
    half = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    store.write_days(rows.where(F.col("time") < half).drop("battv"), base, HOURLY_SPEC)
    store.write_days(rows.where(F.col("time") >= half).drop("value"), base, HOURLY_SPEC)
    return store.read_days(spark, base).select("site", "time", "value", "scans", "battv")


@query(
    "sink_daily_partitions",
    f"""WITH {HOURLY} SELECT site, time::DATE AS date, count(*) AS n, {q6("sum(value)")} AS total, 1::BIGINT AS files
    FROM hourly GROUP BY 1, 2""",
)
def sink_daily_partitions(spark, folder):
    base = new_table_path(spark, "sink")
    store.write_days(hourly(spark, folder).df, base, HOURLY_SPEC)
    stored = spark.read.parquet(base).withColumn("file", F.col("_metadata.file_path"))
    return stored.groupBy("site", F.col("date").cast("date").alias("date")).agg(
        F.count("*").alias("n"), r6(F.sum("value")).alias("total"), F.count_distinct("file").alias("files")
    )


@query(
    "upsert_merge",
    f"""WITH {HOURLY}, old AS (SELECT site, time, value, scans FROM hourly
      WHERE hour(time) < 18 OR time < TIMESTAMP '2024-01-20 12:00:00'),
    fresh AS (SELECT site, time, TRUE AS is_new, CASE WHEN value > 100 THEN NULL ELSE value * 2 END AS value, battv
      FROM hourly WHERE time >= TIMESTAMP '2024-01-20 12:00:00')
    SELECT site, time, {q6("CASE WHEN f.is_new THEN f.value ELSE o.value END")} AS value, o.scans,
      {q6("f.battv")} AS battv FROM fresh f FULL JOIN old o USING (site, time)""",
)
def upsert_merge(spark, folder):
    """Stored: all hours of the first days, those before 18:00 of the last ones. New: all hours of the last days, some with
    null. One column is only stored, one new."""
    base = new_table_path(spark, "upsert")
    rows = hourly(spark, folder).df
    recent = F.expr("time >= TIMESTAMP_NTZ '2024-01-20 12:00:00'")
    old = rows.where((F.hour("time") < 18) | ~recent)
    store.write_days(old.select("site", "time", "value", "scans"), base, HOURLY_SPEC)
    new = rows.where(recent).select(
        "site", "time", F.when(F.col("value") <= 100, F.col("value") * 2).alias("value"), "battv"
    )
    store.upsert_days(new, base, HOURLY_SPEC)
    merged = store.read_days(spark, base)
    return merged.select("site", "time", r6("value").alias("value"), "scans", r6("battv").alias("battv"))


@query(
    "upsert_numeric_keys",
    """WITH monthly AS (SELECT lpad((o_custkey % 5)::VARCHAR, 7, '0') AS site,
      date_trunc('month', o_orderdate)::TIMESTAMP + to_hours((o_orderkey % 4)::BIGINT) AS time, count(*)::DOUBLE AS value
      FROM orders GROUP BY 1, 2)
    SELECT site, time, CASE WHEN year(time) >= 1996 AND hour(time) < 2 THEN value * 10 ELSE value END AS value FROM monthly""",
)
def upsert_numeric_keys(spark, folder):
    """Sites with names of digits, five for all customers. Some hours of the later days are stored again; none may get lost."""
    base = new_table_path(spark, "upsert")
    site = F.lpad((F.col("o_custkey") % 5).cast("string"), 7, "0").alias("site")
    hour = (F.col("o_orderkey") % 4).cast("int")
    time = F.make_timestamp_ntz(F.year("o_orderdate"), F.month("o_orderdate"), F.lit(1), hour, F.lit(0), F.lit(0)).alias("time")
    rows = table(spark, folder, "orders").groupBy(site, time).agg(F.count("*").cast("double").alias("value"))
    store.write_days(rows, base, HOURLY_SPEC)
    new = rows.where((F.year("time") >= 1996) & (F.hour("time") < 2)).withColumn("value", F.col("value") * 10)
    store.upsert_days(new, base, HOURLY_SPEC)
    return store.read_days(spark, base).select("site", "time", "value")


@query("raw_file_manifest", """SELECT ts::DATE AS date, 1::BIGINT AS files, TRUE AS has_bytes FROM events
    WHERE ts::DATE BETWEEN DATE '2024-01-10' AND DATE '2024-01-19' GROUP BY 1""")
def raw_file_manifest(spark, folder):
    base = new_table_path(spark, "raw")
    events = table(spark, folder, "events").select(F.to_json(F.struct("*")).alias("value"), F.to_date("ts").alias("date"))
    events.repartition("date").write.partitionBy("date").text(base)
    files = store.raw_file_manifest(spark, base, "2024-01-10", "2024-01-19", "*.txt")
    return files.groupBy("date").agg(F.count("*").alias("files"), (F.min("length") > 0).alias("has_bytes"))


@query("parse_manual_flags", f'WITH {MANUAL} SELECT site, variable, "start", "end" FROM periods')
def parse_manual(spark, folder):
    path = new_table_path(spark, "manual")
    manual_list(spark, folder).write.option("header", "true").csv(path)
    return read_manual_flags(spark, path)


# --- Flux files --------------------------------------------------------------------------------------------------


def _write_flux_files(spark, folder, name, header, line, where="true", group_row=True):
    """One file per site and day: a row of groups, the names, the units, and a line per hour."""
    base = new_table_path(spark, name)
    rows = hourly(spark, folder).df.where(where).withColumn("day", F.to_date("time"))
    data = rows.select("site", "day", F.unix_seconds(F.col("time").cast("timestamp")).alias("order"), line.alias("value"))
    heads = ([",".join("group" for _ in header)] if group_row else []) + [
        ",".join(header),
        ",".join("[unit]" for _ in header),
    ]
    top = F.array(*(F.struct(F.lit(n - 10).cast("bigint").alias("order"), F.lit(t).alias("value")) for n, t in enumerate(heads)))
    first = data.select("site", "day").distinct().select("site", "day", F.inline(top))
    lines = data.unionByName(first).repartition("site", "day").sortWithinPartitions("site", "day", "order")
    lines.select("site", "day", "value").write.partitionBy("site", "day").text(base)
    return base


def _full_output(spark, folder):
    """Every fifth value or so is written as a null mark; the last header name repeats; names of files hold commas and quotes."""
    value = F.round("value", 4).cast("string")
    line = F.concat_ws(
        ",",
        F.concat(F.lit('"'), "site", F.lit(', ""raw"".dat"')),
        F.date_format("time", "yyyy-MM-dd"),
        F.date_format("time", "HH:mm"),
        F.when(F.col("scans") == 1, "-9999").when(F.col("scans") == 2, "NAN").otherwise(value),
        F.when(F.col("scans") > 4, "bad cell").otherwise(F.col("battv").cast("string")),
        F.col("scans").cast("string"),
    )
    return _write_flux_files(spark, folder, "full", ["filename", "date", "time", "H", "Tau", "Tau"], line)


_FULL = """full_output AS (SELECT site, time AS DateTime, site || ', "raw".dat' AS filename,
    CASE WHEN scans > 2 THEN round(value, 4) END AS H, CASE WHEN scans <= 4 THEN battv END AS Tau, scans AS Tau_1
  FROM hourly)"""


@query(
    "ingest_flux_csv",
    f"""WITH {HOURLY}, {_FULL} SELECT site, DateTime, filename, {q6("H")} AS H, {q6("Tau")} AS Tau, Tau_1
    FROM full_output""",
)
def ingest_flux_csv(spark, folder):
    rows = fluxfiles.read_flux_files(spark, _full_output(spark, folder), "*.txt")
    return rows.select("site", "DateTime", "filename", r6("H").alias("H"), r6("Tau").alias("Tau"), "Tau_1")


@query(
    "flux_bundle",
    f"""WITH {HOURLY}, {_FULL}, qc AS (SELECT site, time AS DateTime, scans AS qc_H FROM hourly
      WHERE time > TIMESTAMP '2024-01-10'),
    met AS (SELECT site, time AS DateTime, battv AS RH FROM hourly WHERE battv < 50)
    SELECT site, DateTime - INTERVAL 30 MINUTE AS time, {q6("H")} AS H, {q6("Tau")} AS Tau, qc_H, {q6("RH")} AS RH
    FROM full_output LEFT JOIN qc USING (site, DateTime) LEFT JOIN met USING (site, DateTime)""",
)
def flux_bundle(spark, folder):
    """The full output is there twice, as a restarted run leaves it."""
    stamp = [F.date_format("time", "yyyy-MM-dd"), F.date_format("time", "HH:mm")]
    qc_line = F.concat_ws(",", *stamp, F.col("scans").cast("string"))
    met_line = F.concat_ws(",", *stamp, F.lit("7"), F.col("battv").cast("string"))
    qc_base = _write_flux_files(
        spark, folder, "qc", ["date", "time", "qc_H"], qc_line, "time > TIMESTAMP_NTZ '2024-01-10 00:00:00'"
    )
    met_base = _write_flux_files(
        spark, folder, "biomet", ["date", "time", "H", "RH"], met_line, "battv < 50", group_row=False
    )
    full = fluxfiles.read_flux_files(spark, _full_output(spark, folder), "*.txt", ["H", "Tau"])
    full = full.unionByName(full.withColumns({"H": F.lit(0.0), "_line": F.col("_line") + 1_000_000_000_000_000}))
    quality = fluxfiles.read_flux_files(spark, qc_base, "*.txt", ["qc_H"])
    biomet = fluxfiles.read_flux_files(spark, met_base, "*.txt", ["H", "RH"])
    bundle = fluxfiles.flux_bundle(full, quality, biomet, ["site"])
    return bundle.select("site", "time", r6("H").alias("H"), r6("Tau").alias("Tau"), "qc_H", r6("RH").alias("RH"))


# --- Metadata ----------------------------------------------------------------------------------------------------

_HOST = "http://example.org"


def _ref(*parts):
    return F.struct(F.concat(F.lit(f"{_HOST}/"), *parts).alias("@id"))


def _documents(df, name):
    """Write records as JSON documents with an items list, one record in each."""
    path = new_table_path(df.sparkSession, name)
    df.select(F.to_json(F.struct(F.array(F.struct("*")).alias("items"))).alias("value")).write.text(path)
    return path


def _dataset_items(spark, folder):
    """Parts as datasets, with their suppliers in line items as plan steps."""
    parts = table(spark, folder, "part")
    items = table(spark, folder, "lineitem")
    step = F.struct(
        F.col("l_linenumber").alias("index"), _ref(F.lit("config/"), F.col("l_orderkey").cast("string")).alias("configuration")
    )
    # Steps of a part are few; the first order of each line number is taken.
    lines = items.groupBy("l_partkey", "l_linenumber").agg(F.min("l_orderkey").alias("l_orderkey"))
    plans = lines.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.collect_list(step).alias("hasPart"))
    hourly_part = F.col("p_size") < 25
    return parts.join(plans, "p_partkey", "left").select(
        F.concat(F.lit(f"{_HOST}/id/dataset/P"), "p_partkey").alias("@id"),
        F.array(_ref(F.lit("type/time-series"))).alias("@type"),
        F.upper("p_brand").alias("sourceColumnName"),
        F.lit("time").alias("timeColumnName"),
        _ref(F.lit("level/"), F.when(F.col("p_retailprice") > 910, "processed").otherwise("raw")).alias("processingLevel"),
        F.array(_ref(F.lit("site/"), "p_brand", F.lit("/"))).alias("originatingSite"),
        F.array(
            F.struct(
                F.when(hourly_part, "PT1H").otherwise("P1D").alias("periodicity"),
                F.lit("PT1H").alias("resolution"),
                _ref(F.lit("anchor/"), F.when(hourly_part, "prec").otherwise("inst")).alias("valueTimeAnchor"),
            )
        ).alias("measure"),
        F.struct("hasPart").alias("methodology"),
        F.when(
            hourly_part,
            F.array(F.struct(F.lit("A_FLAG").alias("columnName"), _ref(F.lit("scheme/core-flags")).alias("valueScheme"))),
        ).alias("hasFlagColumn"),
        F.array(F.struct(F.array(F.concat(F.lit("s3://x/"), "p_brand", F.lit("/"))).alias("accessUrl"))).alias(
            "distribution"
        ),
    )


@query(
    "metadata_flatten_datasets",
    f"""SELECT '{_HOST}/id/dataset/P' || p_partkey AS dataset, p_brand AS site, upper(p_brand) AS variable,
      CASE WHEN p_retailprice > 910 THEN 'processed' ELSE 'raw' END AS processing_level, 'time-series' AS dataset_type,
      'PT1H' AS resolution, CASE WHEN p_size < 25 THEN 'PT1H' ELSE 'P1D' END AS periodicity,
      CASE WHEN p_size < 25 THEN 'end' ELSE 'point' END AS anchor, 's3://x/' || p_brand AS access_url FROM part""",
)
def metadata_flatten_datasets(spark, folder):
    path = _documents(_dataset_items(spark, folder), "datasets")
    flat = metadata.datasets(metadata.read_items(spark, path, "dataset", multi_line=False))
    return flat.drop("network", "time_column", "unit")


@query(
    "metadata_flatten_plan_steps",
    f"""SELECT '{_HOST}/id/dataset/P' || l_partkey AS dataset, l_linenumber AS index,
      '{_HOST}/config/' || min(l_orderkey) AS configuration FROM lineitem GROUP BY l_partkey, l_linenumber""",
)
def metadata_flatten_plan_steps(spark, folder):
    path = _documents(_dataset_items(spark, folder), "datasets")
    return metadata.plan_steps(metadata.read_items(spark, path, "dataset", multi_line=False))


@query(
    "metadata_flatten_flag_columns",
    f"""SELECT '{_HOST}/id/dataset/P' || p_partkey AS dataset, 'A_FLAG' AS column_name, 'core-flags' AS scheme,
      'core' AS role FROM part WHERE p_size < 25""",
)
def metadata_flatten_flag_columns(spark, folder):
    path = _documents(_dataset_items(spark, folder), "datasets")
    items = metadata.read_items(spark, path, "dataset", multi_line=False)
    schemes = metadata.read_items(spark, _documents(_schemes(spark, folder), "schemes"), "flag_scheme", multi_line=False)
    return metadata.flag_columns(items, schemes)


def _schemes(spark, folder):
    """Regions as flag schemes, their nations as the flags."""
    nations = table(spark, folder, "nation")
    concept = F.struct(F.array("n_name").alias("prefLabel"), F.expr("shiftleft(1, n_nationkey)").alias("value"))
    region = F.when(F.col("n_regionkey") == 0, "core-flags").otherwise(F.concat(F.lit("scheme-"), "n_regionkey"))
    flags = nations.groupBy(region.alias("scheme")).agg(F.collect_list(concept).alias("hasTopConcept"))
    return flags.select(
        F.concat(F.lit(f"{_HOST}/scheme/"), "scheme").alias("@id"),
        _ref(F.lit("flag-type/"), F.when(F.col("scheme") == "core-flags", "core_flags").otherwise("infill_flags")).alias("flagType"),
        "hasTopConcept",
    )


@query(
    "metadata_flatten_flag_members",
    """SELECT CASE WHEN n_regionkey = 0 THEN 'core-flags' ELSE 'scheme-' || n_regionkey END AS scheme, n_name AS flag,
      (1 << n_nationkey)::INT AS bit FROM nation""",
)
def metadata_flatten_flag_members(spark, folder):
    path = _documents(_schemes(spark, folder), "schemes")
    return metadata.flag_members(metadata.read_items(spark, path, "flag_scheme", multi_line=False))


def _site_items(spark, folder):
    """Customers as sites; those in debt have closed, and hold an annotation that changes in time."""
    customers = table(spark, folder, "customer")
    debt = F.col("c_acctbal") < 0
    part = F.struct(
        F.array(F.col("c_acctbal").cast("string")).alias("value"),
        F.struct(F.lit("2001-01-01T00:00:00").alias("startDate"), F.lit(None).cast("string").alias("endDate")).alias(
            "interval"
        ),
    )
    plain = F.struct(
        _ref(F.lit("property/ref-soc")).alias("property"),
        F.struct(F.array("c_mktsegment").alias("value")).alias("hasValue"),
        F.lit(None).cast("struct<hasCurrentValue:array<struct<value:array<string>,interval:struct<startDate:string,endDate:string>>>>").alias(
            "hasValueSeries"
        ),
    )
    dated = F.struct(
        _ref(F.lit("property/vwc-saturation")).alias("property"),
        F.lit(None).cast("struct<value:array<string>>").alias("hasValue"),
        F.struct(F.array(part).alias("hasCurrentValue")).alias("hasValueSeries"),
    )
    return customers.select(
        F.concat(F.lit(f"{_HOST}/id/site/C"), "c_custkey").alias("@id"),
        F.array("c_name").alias("identifier"),
        F.array(_ref(F.lit("network/N"), F.col("c_nationkey").cast("string"))).alias("utilisedBy"),
        (F.col("c_acctbal") / 100).alias("lat"),
        F.struct(
            F.lit("1995-02-03T00:00:00").alias("startDate"), F.when(debt, "1999-12-31T00:00:00").alias("endDate")
        ).alias("operatingPeriod"),
        F.when(debt, F.array(plain, dated)).otherwise(F.array(plain)).alias("hasAnnotation"),
    )


@query(
    "metadata_flatten_sites",
    """SELECT 'C' || c_custkey AS site, c_name AS short_code, 'N' || c_nationkey AS network,
      round_even(c_acctbal / 100, 6) AS lat, TIMESTAMP '1995-02-03' AS "start",
      CASE WHEN c_acctbal < 0 THEN TIMESTAMP '1999-12-31' END AS "end" FROM customer""",
)
def metadata_flatten_sites(spark, folder):
    path = _documents(_site_items(spark, folder), "sites")
    flat = metadata.sites(metadata.read_items(spark, path, "site", multi_line=False))
    return flat.select("site", "short_code", "network", r6("lat").alias("lat"), "start", "end")


@query(
    "metadata_flatten_annotations",
    f"""SELECT '{_HOST}/id/site/C' || c_custkey AS id, 'ref_soc' AS property, NULL::TIMESTAMP AS "start",
      NULL::TIMESTAMP AS "end", c_mktsegment AS value FROM customer
    UNION ALL SELECT '{_HOST}/id/site/C' || c_custkey, 'vwc_saturation', TIMESTAMP '2001-01-01', NULL,
      c_acctbal::VARCHAR FROM customer WHERE c_acctbal < 0""",
)
def metadata_flatten_annotations(spark, folder):
    path = _documents(_site_items(spark, folder), "sites")
    return metadata.annotations(metadata.read_items(spark, path, "site", multi_line=False))


def _configuration_items(spark, folder):
    """Orders as configurations that apply to their customer's datasets: one method with a literal, a named input, a
    dependency and a nested argument each."""
    orders = table(spark, folder, "orders")
    text = "struct<`@id`:string>"

    def argument(name, value=None, reference=None, structured=None):
        held = F.struct(
            (value if value is not None else F.lit(None).cast("array<string>")).alias("value"),
            (reference if reference is not None else F.lit(None).cast(text)).alias("valueReference"),
        )
        nested = "array<struct<argument:array<struct<parameter:struct<`@id`:string>,hasValue:struct<value:array<string>>>>>>"
        return F.struct(
            _ref(F.lit(f"parameter/{name}")).alias("parameter"),
            (held if structured is None else F.lit(None).cast(f"struct<value:array<string>,valueReference:{text}>")).alias(
                "hasValue"
            ),
            (structured if structured is not None else F.lit(None).cast(nested)).alias("hasStructuredValue"),
        )

    inner = F.struct(
        _ref(F.lit("parameter/wind-height.source")).alias("parameter"),
        F.struct(F.array(F.lit("deployment")).alias("value")).alias("hasValue"),
    )
    customer = F.col("o_custkey").cast("string")
    current = F.struct(
        _ref(F.lit("method/"), F.when(F.col("o_orderstatus") == "F", "range").otherwise("spike")).alias("method"),
        F.array(
            argument("gt", F.array(F.col("o_totalprice").cast("string"))),
            argument("sensor-ta", reference=_ref(F.lit("dataset/"), customer)),
            argument("dep-ts", reference=_ref(F.lit("raw/"), customer)),
            argument("wind-height", structured=F.array(F.struct(F.array(inner).alias("argument")))),
        ).alias("argument"),
        F.when(
            F.col("o_orderstatus") == "F",
            F.struct(
                F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("startDate"),
                F.lit(None).cast("string").alias("endDate"),
            ),
        ).alias("observationInterval"),
    )
    applied = F.struct(
        F.concat(F.lit(f"{_HOST}/dataset/D"), customer).alias("@id"),
        F.array(_ref(F.lit("site/C"), customer)).alias("originatingSite"),
    )
    return orders.select(
        F.concat(F.lit(f"{_HOST}/config/"), "o_orderkey").alias("@id"),
        _ref(F.lit("configuration-type/qc")).alias("type"),
        F.array(applied).alias("appliesToDataset"),
        F.array(current).alias("hasCurrentValue"),
    )


def _settings(spark, folder):
    path = _documents(_configuration_items(spark, folder), "configurations")
    return metadata.method_settings(metadata.read_items(spark, path, "configuration", multi_line=False))


@query(
    "metadata_flatten_methods",
    f"""SELECT '{_HOST}/dataset/D' || o_custkey AS dataset, 'C' || o_custkey AS site, '{_HOST}/config/' || o_orderkey
      AS configuration, 'qc' AS kind, 0 AS position, CASE o_orderstatus WHEN 'F' THEN 'range' ELSE 'spike' END AS method,
      CASE o_orderstatus WHEN 'F' THEN o_orderdate END AS "start", NULL::TIMESTAMP AS "end" FROM orders""",
)
def metadata_flatten_methods(spark, folder):
    return _settings(spark, folder).drop("arguments")


@query(
    "metadata_flatten_arguments",
    f"""WITH a AS (SELECT '{_HOST}/dataset/D' || o_custkey AS dataset, '{_HOST}/config/' || o_orderkey AS configuration,
      0 AS position, * FROM orders)
    SELECT dataset, configuration, position, 'gt' AS parameter, 'value' AS role,
      o_totalprice::DECIMAL(18, 2)::DOUBLE AS number, NULL AS text FROM a
    UNION ALL SELECT dataset, configuration, position, 'sensor_ta', 'input', NULL, '{_HOST}/dataset/' || o_custkey FROM a
    UNION ALL SELECT dataset, configuration, position, 'dep_ts', 'dependency', NULL, '{_HOST}/raw/' || o_custkey FROM a
    UNION ALL SELECT dataset, configuration, position, 'wind_height.wind_height.source', 'nested', NULL, 'deployment'
      FROM a""",
)
def metadata_flatten_arguments(spark, folder):
    flat = metadata.arguments(_settings(spark, folder))
    number = F.col("value").try_cast("double")
    return flat.select(
        "dataset",
        "configuration",
        "position",
        "parameter",
        "role",
        number.alias("number"),
        F.when(number.isNull(), F.col("value")).alias("text"),
    )


@query(
    "metadata_flatten_deployments",
    """SELECT 'D' || s_suppkey AS deployment_id, 'anem' || s_nationkey AS platform, NULL::TIMESTAMP AS "start",
      CASE WHEN s_acctbal < 0 THEN TIMESTAMP '2020-05-06 07:08:09' END AS "end",
      round_even(s_acctbal / 1000, 6) AS height FROM supplier""",
)
def metadata_flatten_deployments(spark, folder):
    """Suppliers as instruments on the platform of their nation; when they began is not known."""
    records = table(spark, folder, "supplier").select(
        F.concat(F.lit("D"), "s_suppkey").alias("@id"),
        F.when(F.col("s_acctbal") < 0, "2020-05-06T07:08:09").alias("endedAtTime"),
        (F.col("s_acctbal") / 1000).alias("deployedHeight"),
        F.concat(F.lit(f"{_HOST}/platform/anem"), "s_nationkey").alias("deployedOnPlatform"),
    )
    flat = metadata.deployments(metadata.read_items(spark, _documents(records, "deployments"), "deployment", multi_line=False))
    return flat.withColumn("height", r6("height"))


@query(
    "metadata_resolve_arguments",
    """WITH o AS (SELECT 'D' || o_custkey AS dataset, 'G' || o_orderkey AS configuration, 0 AS position, * FROM orders
      JOIN customer ON c_custkey = o_custkey)
    SELECT dataset, configuration, position, 'gt' AS parameter, round_even(o_totalprice, 6) AS number,
      NULL::TIMESTAMP AS "start" FROM o
    UNION ALL SELECT dataset, configuration, position, 'altitude', round_even(c_acctbal / 10, 6), NULL FROM o
    UNION ALL SELECT dataset, configuration, position, 'ref_soc', round_even(c_nationkey, 6), TIMESTAMP '2020-01-01' FROM o
      WHERE c_acctbal > 0""",
)
def metadata_resolve_arguments(spark, folder):
    """Orders as configurations: a literal, an attribute of the customer's site and an annotation some sites have."""
    orders = table(spark, folder, "orders").select(
        F.concat(F.lit("D"), "o_custkey").alias("dataset"),
        F.concat(F.lit("G"), "o_orderkey").alias("configuration"),
        F.lit(0).alias("position"),
        F.concat(F.lit("C"), "o_custkey").alias("site"),
        "o_totalprice",
    )
    entries = F.array(
        *(
            F.struct(F.lit(parameter).alias("parameter"), F.lit("value").alias("role"), value.alias("value"))
            for parameter, value in (
                ("gt", F.col("o_totalprice").cast("string")),
                ("site_attribute", F.lit("altitude")),
                ("annotation", F.lit("REF_SOC")),
            )
        )
    )
    arguments = orders.select("dataset", "configuration", "position", F.inline(entries))
    customers = table(spark, folder, "customer").withColumn("site", F.concat(F.lit("C"), "c_custkey"))
    nothing = F.lit(None).cast("double")
    sites = customers.select(
        "site",
        *(nothing.alias(name) for name in ("easting", "northing", "lat", "lon")),
        (F.col("c_acctbal") / 10).alias("altitude"),
    )
    notes = customers.where("c_acctbal > 0").select(
        F.concat(F.lit(f"{_HOST}/site/"), "site").alias("id"),
        F.lit("ref_soc").alias("property"),
        F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("start"),
        F.lit(None).cast("timestamp_ntz").alias("end"),
        F.col("c_nationkey").cast("string").alias("value"),
    )
    resolved = metadata.resolved_arguments(arguments, orders, sites, notes)
    number = r6(F.col("value").cast("double"))
    return resolved.select("dataset", "configuration", "position", "parameter", number.alias("number"), "start")


@query(
    "window_processed_and_saved",
    f"""WITH {HOURLY}, ends AS (SELECT site, min(time) AS lo, max(time) AS hi FROM hourly
      WHERE time::DATE BETWEEN DATE '2024-01-09' AND DATE '2024-01-21' GROUP BY site),
    grid AS (SELECT site, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS time FROM ends),
    checked AS (SELECT site, time, CASE WHEN h.value > 150 THEN NULL ELSE h.value END AS value FROM grid
      LEFT JOIN hourly h USING (site, time))
    SELECT site, date_trunc('day', time)::TIMESTAMP AS time,
      {q6("CASE WHEN count(value) >= 20 THEN avg(value) END")} AS daily_mean FROM checked
    WHERE time::DATE BETWEEN DATE '2024-01-10' AND DATE '2024-01-20' GROUP BY 1, 2""",
)
def window_processed_and_saved(spark, folder):
    """Ten days out of a stored month: read with a day either side, checked, aggregated, saved and read back."""
    raw, out = new_table_path(spark, "raw"), new_table_path(spark, "out")
    store.write_days(hourly(spark, folder).df, raw, HOURLY_SPEC)
    flags = FlagColumns({"quality_control": "qc"}, {"quality_control": {"range": 1}})
    check = Step("quality_control", (Settings("range", {"lt": 0, "gt": 150}),))
    daily = Step("aggregation", (Settings("mean", {"threshold": 20}),), source="hourly")
    plans = {
        "hourly": DatasetPlan(HOURLY_SPEC, (Step("load", source="raw"), check), flags),
        "daily": DatasetPlan(DAILY_SPEC.with_(value="daily_mean"), (daily,)),
    }
    window = dt.date(2024, 1, 10), dt.date(2024, 1, 20)
    process_window(spark, plans, {"raw": Stored(raw, HOURLY_SPEC)}, {"daily": out}, *window)
    return store.read_days(spark, out).select("site", "time", r6("daily_mean").alias("daily_mean"))
