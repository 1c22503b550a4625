import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.functions.flagbits import CORE_FLAGS
from tidemark.plans.from_metadata import MetadataTables, broken_datasets, broken_rules, plans_by_kind, stored_inputs
from tidemark.plans.runner import run_plans
from tidemark.sources.metadata import resolved_arguments


def resolve(spark, arguments, settings):
    """Site A has a sensor height that changes in time, as an annotation; nobody asks for the altitude by that name."""
    columns = "dataset string, configuration string, position int, parameter string, role string, value string"
    moved = dt.datetime(2025, 1, 1, 3)
    return (
        spark.createDataFrame(arguments, columns),
        spark.createDataFrame([(s[0], s[1], s[2], s[4]) for s in settings], "dataset string, site string, configuration string, position int"),
        spark.createDataFrame([("A", None, None, None, None, 10.0), ("B", None, None, None, None, 20.0)],
                              "site string, easting double, northing double, lat double, lon double, altitude double"),
        spark.createDataFrame(
            [("http://example.org/A", "sensor_height", None, moved, "100"), ("http://example.org/A", "sensor_height", moved, None, "200"),
             ("http://example.org/B", "sensor_height", None, None, "300")],
            "id string, property string, start timestamp_ntz, end timestamp_ntz, value string"),
    )


@pytest.fixture(scope="module")
def tables(spark):
    """Two sites with the same kinds of dataset. Site A is corrected twice, site B not at all; limits differ."""
    d = lambda day: dt.datetime(2025, 1, day)

    def make(columns, rows):
        return spark.createDataFrame(rows, columns)

    datasets, steps, settings, arguments = [], [], [], []
    for site in "AB":
        for name, variable, level, periodicity in (
            ("raw", "ta_raw", "raw", "PT1H"),
            ("battery", "battv", "raw", "PT1H"),
            ("clean", "TA", "processed", "PT1H"),
            ("daily", "TA", "processed", "P1D"),
        ):
            datasets.append((f"{site}-{name}", "net", site, variable, "time", level, periodicity, "start", None))
        clean, daily = f"{site}-clean", f"{site}-daily"
        for index, kind in enumerate(["load", "correction", "qc", "infill"]):
            if not (site == "B" and kind == "correction"):
                steps.append((clean, 10 * (index + 1), f"{site}-{kind}"))
        settings.append((clean, site, f"{site}-load", "load", 0, "load", None, None))
        arguments.append((clean, f"{site}-load", 0, "dep_ts", "dependency", f"{site}-raw"))
        if site == "A":
            settings.append((clean, site, "A-correction", "correction", 0, "add", None, d(1)))
            settings.append((clean, site, "A-correction", "correction", 1, "scalar", d(1), None))
            arguments.append((clean, "A-correction", 0, "correction_factor", "value", "100"))
            arguments.append((clean, "A-correction", 1, "correction_factor", "value", "2"))
        settings.append((clean, site, f"{site}-qc", "qc", 0, "range", None, None))
        settings.append((clean, site, f"{site}-qc", "qc", 1, "battery_v", None, None))
        arguments += [
            (clean, f"{site}-qc", 0, "lt", "value", "0"),
            (clean, f"{site}-qc", 0, "gt", "value", "30" if site == "A" else "3"),
            (clean, f"{site}-qc", 1, "lt", "value", "11"),
            (clean, f"{site}-qc", 1, "battv", "input", f"{site}-battery"),
        ]
        settings.append((clean, site, f"{site}-infill", "infill", 0, "linear_interp", None, None))
        arguments.append((clean, f"{site}-infill", 0, "max_gap_size", "value", "2"))
        steps.append((daily, 1, f"{site}-agg"))
        settings.append((daily, site, f"{site}-agg", "aggregate", 0, "mean", None, None))
        arguments += [
            (daily, f"{site}-agg", 0, "dep_ts", "dependency", clean),
            (daily, f"{site}-agg", 0, "threshold", "value", "3"),
        ]
        level = f"{site}-level"
        datasets.append((level, "net", site, "LEVEL", "time", "processed", "PT1H", "start", None))
        steps.append((level, 1, f"{site}-calc"))
        settings.append((level, site, f"{site}-calc", "calculate", 0, "distance_to_level", None, None))
        arguments += [
            (level, f"{site}-calc", 0, "dist_to_water", "input", f"{site}-raw"),
            (level, f"{site}-calc", 0, "annotation" if site == "A" else "site_attribute", "value",
             "SENSOR_HEIGHT" if site == "A" else "altitude"),
        ]
    flags = [(f"{s}-clean", f"TA_{r.upper()}", f"scheme-{r}", r) for s in "AB" for r in ("quality_control", "correction", "infill")]
    members = [
        ("scheme-quality_control", "range", 1),
        ("scheme-quality_control", "battery_v", 2),
        ("scheme-correction", "add", 1),
        ("scheme-correction", "scalar", 2),
        ("scheme-infill", "linear_interp", 1),
    ]
    return MetadataTables(
        make("dataset string, network string, site string, variable string, time_column string, processing_level string, "
             "periodicity string, anchor string, unit string", datasets),
        make("dataset string, index int, configuration string", steps),
        make("dataset string, site string, configuration string, kind string, position int, method string, "
             "start timestamp_ntz, end timestamp_ntz", settings),
        resolved_arguments(*resolve(spark, arguments, settings)),
        make("dataset string, column_name string, scheme string, role string", flags),
        make("scheme string, flag string, bit int", members),
    )


def test_sites_share_a_plan_and_keep_their_parameters(spark, tables, series, values):
    plans = plans_by_kind(tables)
    assert set(plans) == {"TA/PT1H/processed", "TA/P1D/processed", "LEVEL/PT1H/processed"}
    shapes = sorted([step.kind for step in variant.steps] for variant in plans["TA/PT1H/processed"].variants)
    # A is corrected and B is not; their daily means have the same shape.
    assert shapes == [
        ["load", "correction", "correction", "quality_control", "quality_control", "infill"],
        ["load", "quality_control", "quality_control", "infill"],
    ]
    assert len(plans["TA/P1D/processed"].variants) == 1
    inputs = stored_inputs(tables, plans, "/base")
    assert set(inputs) == {"ta_raw/PT1H/raw", "battv/PT1H/raw"} and inputs["battv/PT1H/raw"].spec.value == "battv"

    raw = series({"A": [1, 2, 3, 40, 5], "B": [1, 2, 3, 40, 5]}, "ta_raw")
    battery = series({"A": [12, 12, 12, 12, 12], "B": [12, 10, 12, 12, 12]}, "battv")
    result = run_plans(plans, {"ta_raw/PT1H/raw": raw, "battv/PT1H/raw": battery})
    result.raise_if_failed()
    done = result.done["TA/PT1H/processed"].df
    # A: the first value lies in both periods: (1 + 100) * 2, out of range. All others are doubled; 80 is out of range.
    assert values(done, "TA") == [None, 4, 6, 8, 10] + [1, 2, 3, None, None]
    assert values(done, "TA_CORRECTION") == [3, 2, 2, 2, 2] + [0] * 5
    assert values(done, "TA_QUALITY_CONTROL") == [1, 0, 0, 1, 0] + [0, 2, 0, 1, 1]
    assert values(done, "TA_INFILL") == [0, 0, 0, 1, 0] + [0, 1, 0, 0, 0]
    # Site A's height changes in time; site B only names an attribute that the method does not use.
    assert values(result.done["LEVEL/PT1H/processed"].df, "LEVEL") == [99, 98, 97, 160, 195] + [None] * 5
    daily = result.done["TA/P1D/processed"].df
    assert values(daily, "TA") == [7, 2]


def test_shaping_parameters_may_differ(spark, tables, series, values):
    """B wants more hours for a mean and fills shorter gaps than A."""
    own = F.when((F.col("dataset") == "B-daily") & (F.col("parameter") == "threshold"), "9")
    own = own.when((F.col("dataset") == "B-clean") & (F.col("parameter") == "max_gap_size"), "1")
    plans = plans_by_kind(replace(tables, arguments=tables.arguments.withColumn("value", own.otherwise(F.col("value")))))
    assert len(plans["TA/P1D/processed"].variants) == 2
    raw = series({"A": [1, 2, 40, 40, 5], "B": [1, 2, 40, 40, 3]}, "ta_raw")
    battery = series({"A": [12] * 5, "B": [12] * 5}, "battv")
    result = run_plans(plans, {"ta_raw/PT1H/raw": raw, "battv/PT1H/raw": battery})
    result.raise_if_failed()
    # The gap of two hours is filled at A, between 4 and 10.
    assert values(result.done["TA/PT1H/processed"].df, "TA") == [None, 4, 6, 8, 10] + [1, 2, None, None, 3]
    daily = result.done["TA/P1D/processed"].df
    assert values(daily, "TA") == [7, None]


def broken(tables, **changed):
    return {(r["dataset"], r["rule"]) for r in broken_rules(replace(tables, **changed)).collect()}


def more(spark, table, *rows):
    return table.union(spark.createDataFrame(list(rows), table.schema))


def test_sound_metadata_break_no_rule(tables):
    assert broken(tables) == set()


def test_broken_rules_fail_their_dataset_and_what_needs_it(spark, tables):
    index = more(spark, tables.steps, ("B-clean", 30, "B-again"))
    assert broken(tables, steps=index) == {("B-clean", "index used more than once")}
    failed = {(r["dataset"], r["rule"], r["detail"]) for r in broken_datasets(replace(tables, steps=index)).collect()}
    assert failed == {("B-clean", "index used more than once", "30"), ("B-daily", "depends on a broken dataset", None)}
    kind = tables.settings.withColumn("kind", F.when(F.col("configuration") == "B-agg", "magic").otherwise(F.col("kind")))
    assert broken(tables, settings=kind) == {("B-daily", "unknown configuration type")}
    method = tables.settings.withColumn("method", F.when(F.col("configuration") == "A-agg", "magic").otherwise(F.col("method")))
    assert broken(tables, settings=method) == {("A-daily", "unknown method")}
    arguments = tables.arguments
    nobody = arguments.withColumn("value", F.when(F.col("value") == "B-battery", "B-gone").otherwise(F.col("value")))
    assert broken(tables, arguments=nobody) == {("B-clean", "input is not exactly one dataset")}
    two = more(spark, arguments, ("A-clean", "A-qc", 1, "battv", "input", "A-raw", None, None))
    assert broken(tables, arguments=two) == {("A-clean", "input is not exactly one dataset")}
    several = more(spark, arguments, ("A-daily", "A-agg", 0, "threshold", "value", "4", None, None))
    assert broken(tables, arguments=several) == {("A-daily", "parameter has several values")}
    word = arguments.withColumn("value", F.when(F.col("parameter") == "threshold", "three").otherwise(F.col("value")))
    assert broken(tables, arguments=word) == {("A-daily", "parameter is not a number"), ("B-daily", "parameter is not a number")}
    flags = more(spark, tables.flag_columns, ("A-daily", "X", "scheme-infill", "colour"), ("B-daily", "Y", "scheme-infill", "infill"),
                 ("B-daily", "Z", "scheme-infill", "infill"))
    assert broken(tables, flag_columns=flags) == {("A-daily", "flag column"), ("B-daily", "flag column")}
    datasets = more(spark, tables.datasets, ("C-raw", "net", "C", "ta_raw", "time", "raw", "PT1H", "end", None),
                    ("A-other", "net", "A", "battv", "time", "raw", "PT1H", "start", None))
    assert broken(tables, datasets=datasets) == {
        ("C-raw", "differs from its kind in anchor, time column or unit"), ("A-other", "site has several datasets of a kind"),
        ("A-battery", "site has several datasets of a kind")}


def test_a_broken_dataset_fails_alone(spark, tables, series, values):
    steps = more(spark, tables.steps, ("B-clean", 30, "B-again"))
    plans = plans_by_kind(replace(tables, steps=steps))
    raw = series({"A": [1, 2, 3, 40, 5], "B": [1, 2, 3, 40, 5]}, "ta_raw")
    battery = series({"A": [12] * 5, "B": [12] * 5}, "battv")
    result = run_plans(plans, {"ta_raw/PT1H/raw": raw, "battv/PT1H/raw": battery})
    result.raise_if_failed()
    assert values(result.done["TA/PT1H/processed"].df, "TA") == [None, 4, 6, 8, 10]
    assert [(r["site"], r["TA"]) for r in result.done["TA/P1D/processed"].df.collect()] == [("A", 7.0)]
    assert {r["site"] for r in result.done["LEVEL/PT1H/processed"].df.collect()} == {"A", "B"}


def test_steps_of_a_site_run_in_its_own_order(spark, tables, series, values):
    """B is checked at 30 and 35, A filled at 32 in between: what B's first check finds is removed after its second."""
    steps = tables.steps.withColumn("index", F.when(F.col("configuration") == "A-infill", 32).otherwise(F.col("index")))
    steps = more(spark, steps, ("B-clean", 35, "B-second"))
    settings = more(spark, tables.settings, ("B-clean", "B", "B-second", "qc", 0, "error_code", None, None))
    arguments = more(spark, tables.arguments, ("B-clean", "B-second", 0, "value", "value", "40", None, None))
    members = more(spark, tables.flag_members, ("scheme-quality_control", "error_code", 4))
    plans = plans_by_kind(replace(tables, steps=steps, settings=settings, arguments=arguments, flag_members=members))
    raw = series({"A": [1, 2, 3, 40, 5], "B": [1, 2, 3, 40, 5]}, "ta_raw")
    battery = series({"A": [12] * 5, "B": [12] * 5}, "battv")
    result = run_plans(plans, {"ta_raw/PT1H/raw": raw, "battv/PT1H/raw": battery})
    result.raise_if_failed()
    flags = values(result.done["TA/PT1H/processed"].df.where("site = 'B'"), "TA_QUALITY_CONTROL")
    assert flags == [0, 0, 0, 1 + 4, 1]


def test_each_site_keeps_its_own_aggregation(spark, tables, series, values):
    method = F.when(F.col("dataset") == "B-daily", "sum").otherwise(F.col("method"))
    plans = plans_by_kind(replace(tables, settings=tables.settings.withColumn("method", method)))
    raw = series({"A": [1, 2, 3, 4], "B": [1, 2, 3, 2]}, "ta_raw")
    battery = series({"A": [12] * 4, "B": [12] * 4}, "battv")
    result = run_plans(plans, {"ta_raw/PT1H/raw": raw, "battv/PT1H/raw": battery})
    result.raise_if_failed()
    # A: the mean of 202, out of range, then 4, 6, 8; B: the sum.
    daily = result.done["TA/P1D/processed"].df
    assert [(row["site"], row["TA"]) for row in daily.orderBy("site").collect()] == [("A", 6.0), ("B", 8.0)]


def test_core_flags_follow_the_last_method_of_a_configuration(spark, tables, series, values):
    """``add`` leaves a negative value, and its broken power is none: the correction as a whole was unsuccessful."""
    one = F.col("configuration") == "A-correction"
    settings = tables.settings.withColumn("method", F.when(one & (F.col("position") == 1), "power").otherwise(F.col("method")))
    settings = settings.withColumn("start", F.when(~one, F.col("start"))).withColumn("end", F.when(~one, F.col("end")))
    number = F.when(F.col("position") == 0, "-10").otherwise("0.5")
    arguments = tables.arguments.withColumn("value", F.when(one, number).otherwise(F.col("value")))
    core = spark.createDataFrame([(f"{site}-clean", "TA_CORE", "scheme-core", "core") for site in "AB"], tables.flag_columns.schema)
    members = [("scheme-core", name, bit) for name, bit in CORE_FLAGS.items()] + [("scheme-correction", "power", 4)]
    more = spark.createDataFrame(members, tables.flag_members.schema)
    plans = plans_by_kind(replace(tables, settings=settings, arguments=arguments, flag_columns=tables.flag_columns.union(core),
                                  flag_members=tables.flag_members.union(more)))
    raw = series({"A": [1, 26, 1, 1], "B": [1, 2, 3, 2]}, "ta_raw")
    battery = series({"A": [12] * 4, "B": [12] * 4}, "battv")
    result = run_plans(plans, {"ta_raw/PT1H/raw": raw, "battv/PT1H/raw": battery})
    result.raise_if_failed()
    flags = values(result.done["TA/PT1H/processed"].df.where("site = 'A'"), "TA_CORE")
    bits = {CORE_FLAGS["corrected"], CORE_FLAGS["unsuccessful_correction"]}
    assert [{bit for bit in bits if flag & bit} for flag in flags] == [
        {CORE_FLAGS["unsuccessful_correction"]}, {CORE_FLAGS["corrected"]},
        {CORE_FLAGS["unsuccessful_correction"]}, {CORE_FLAGS["unsuccessful_correction"]},
    ]


def test_deployment_heights(spark):
    ids = ("d", "c", 0)
    arguments = [
        (*ids, "wind_height.wind_height.source", "nested", "deployment"),
        (*ids, "wind_height.wind_height.platform", "nested", "anem"),
        (*ids, "wind_height.wind_height.attribute", "nested", "deployedHeight"),
        (*ids, "lt", "value", "1"),
    ]
    settings = [("d", "A", "c", "calculate", 0, "calculate_pe", None, None)]
    later = dt.datetime(2025, 1, 2)
    deployments = spark.createDataFrame(
        [("x-anem-1", "A", None, later, 2.0), ("x-anem-2", "A", later, None, 3.0), ("x-rain", "A", None, None, 9.0),
         ("y-anem", "B", None, None, 7.0)],
        "deployment_id string, platform string, start timestamp_ntz, end timestamp_ntz, height double",
    )
    rows = resolved_arguments(*resolve(spark, arguments, settings), deployments).collect()
    assert {(r["parameter"], r["value"], r["start"], r["end"]) for r in rows} == {
        ("lt", "1", None, None), ("wind_height", "2.0", None, later), ("wind_height", "3.0", later, None),
    }
