import datetime as dt
import glob
import json
import os
import shutil

import pytest

from tidemark.plans import runner
from tidemark.plans.methods import Settings
from tidemark.session import new_table_path
from tidemark.sources import dayindex, fluxfiles, manualflags, metadata, store
from tidemark.spec import SeriesSpec
from tidemark.streaming.lookback import reprocess_touched_days

HOURLY = SeriesSpec.of("PT1H")
SCHEMA = "site string, time timestamp_ntz, value double"


def rows(spark, *cells, schema=SCHEMA):
    return spark.createDataFrame([("A", dt.datetime(2025, 1, d, h), *rest) for d, h, *rest in cells], schema)


def listed(df, column="value"):
    return [(r["time"].day, r["time"].hour, r[column]) for r in df.orderBy("site", "time").collect()]


# --- Day-partitioned store ---------------------------------------------------------------------------------------


def test_range_is_inclusive_and_ignores_time_of_day(spark):
    base = new_table_path(spark, "t")
    store.write_days(rows(spark, (1, 0, 1.0), (2, 23, 2.0), (3, 5, 3.0), (4, 1, 4.0)), base, HOURLY)
    got = store.read_days(spark, base, dt.datetime(2025, 1, 2, 23, 59), dt.datetime(2025, 1, 3, 1))
    assert listed(got) == [(2, 23, 2.0), (3, 5, 3.0)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan


def test_nothing_stored(spark):
    schema = rows(spark, (1, 0, 1.0)).schema
    base = new_table_path(spark, "t")
    assert store.read_days(spark, base, schema=schema).count() == 0
    store.write_days(rows(spark, (1, 0, 1.0)), base, HOURLY)
    assert store.read_days(spark, base, "2030-01-01", "2030-02-01", schema=schema).count() == 0


def test_writing_a_day_again_replaces_only_that_day(spark):
    base = new_table_path(spark, "t")
    store.write_days(rows(spark, (1, 0, 1.0), (2, 0, 2.0), (2, 1, 2.5)), base, HOURLY)
    store.write_days(rows(spark, (2, 0, 9.0)), base, HOURLY)
    assert listed(store.read_days(spark, base)) == [(1, 0, 1.0), (2, 0, 9.0)]


def test_keys_of_digits_keep_their_rows(spark):
    base = new_table_path(spark, "t")
    one = [("007", dt.datetime(2025, 1, 1, h), float(h)) for h in (0, 1)]
    store.upsert_days(spark.createDataFrame(one, SCHEMA), base, HOURLY)
    store.upsert_days(spark.createDataFrame([("007", dt.datetime(2025, 1, 1, 2), 9.0)], SCHEMA), base, HOURLY)
    got = store.read_days(spark, base)
    assert listed(got) == [(1, 0, 0.0), (1, 1, 1.0), (1, 2, 9.0)]
    assert {row["site"] for row in got.collect()} == {"007"}


def test_a_broken_file_outside_the_window_does_no_harm(spark):
    base = new_table_path(spark, "t")
    store.write_days(rows(spark, (1, 0, 1.0), (2, 0, 2.0), (9, 0, 3.0)), base, HOURLY)
    for path in glob.glob(f"{base}/site=A/date=2025-01-09/*.parquet"):
        with open(path, "wb") as file:
            file.write(b"broken")
    assert listed(store.read_days(spark, base, "2025-01-01", "2025-01-02")) == [(1, 0, 1.0), (2, 0, 2.0)]
    store.upsert_days(rows(spark, (2, 1, 5.0)), base, HOURLY)
    assert listed(store.read_days(spark, base, "2025-01-01", "2025-01-03")) == [(1, 0, 1.0), (2, 0, 2.0), (2, 1, 5.0)]
    with pytest.raises(Exception):  # noqa: B017 - not taken for an empty store
        store.read_days(spark, base, schema=rows(spark, (1, 0, 1.0)).schema).collect()


def opened(df):
    """Names of the folders that a plan lists."""
    paths = df._jdf.queryExecution().analyzed().collectLeaves().head().relation().location().rootPaths()
    return sorted(path.toString().rsplit("/", 2)[-2] + "/" + path.getName() for path in (paths.apply(k) for k in range(paths.size())))


def test_a_window_opens_its_folders_whatever_the_history(spark, monkeypatch):
    """Listings and paths are counted, after ten days of history and after four hundred."""
    listings = []
    plain = dayindex.child_names
    monkeypatch.setattr(dayindex, "child_names", lambda spark, path: listings.append(path) or plain(spark, path))
    seen = []
    for length in (10, 400):
        base = new_table_path(spark, "history")
        first = dt.datetime(2024, 1, 1)
        rows = [(site, first + dt.timedelta(days=k), float(k)) for site in "AB" for k in range(length)]
        store.write_days(spark.createDataFrame(rows, SCHEMA), base, HOURLY)
        listings.clear()
        got = store.read_days(spark, base, "2024-01-03", "2024-01-04")
        assert sorted((r["site"], r["value"]) for r in got.collect()) == [("A", 2.0), ("A", 3.0), ("B", 2.0), ("B", 3.0)]
        seen.append((opened(got), [path.removeprefix(base) for path in listings]))
    assert seen[0] == seen[1]
    assert seen[0][0] == ["site=A/date=2024-01-03", "site=A/date=2024-01-04", "site=B/date=2024-01-03", "site=B/date=2024-01-04"]


def test_an_upsert_opens_the_folders_it_touches(spark, monkeypatch):
    base = new_table_path(spark, "t")
    days = [(s, dt.datetime(2025, 1, d), float(d)) for s in "ABC" for d in range(1, 20)]
    store.write_days(spark.createDataFrame(days, SCHEMA), base, HOURLY)
    paths = []
    plain = dayindex._paths
    monkeypatch.setattr(dayindex, "_paths", lambda spark, base, folders, *rest: paths.extend(folders) or plain(spark, base, folders, *rest))
    store.upsert_days(spark.createDataFrame([("B", dt.datetime(2025, 1, 7, 1), 70.0), ("C", dt.datetime(2025, 2, 1), 1.0)], SCHEMA), base, HOURLY)
    assert paths == ["site=B/date=2025-01-07"]
    got = store.read_days(spark, base, "2025-01-07", "2025-02-02")
    assert sorted((r["site"], r["time"].day, r["value"]) for r in got.where("site = 'B' AND day(time) = 7 OR month(time) = 2").collect()) == [
        ("B", 7, 7.0), ("B", 7, 70.0), ("C", 1, 1.0)]


def test_a_lost_or_stale_index_is_rebuilt(spark):
    base = new_table_path(spark, "t")
    store.write_days(rows(spark, (1, 0, 1.0), (2, 0, 2.0), (3, 0, 3.0)), base, HOURLY)
    shutil.rmtree(f"{base}/_index")
    assert listed(store.read_days(spark, base, "2025-01-02", "2025-01-03")) == [(2, 0, 2.0), (3, 0, 3.0)]
    assert os.path.isdir(f"{base}/_index")
    # A job that died after entering a day, and a folder that somebody took away.
    dayindex.add(dayindex.touched_folders(rows(spark, (4, 0, 4.0)), ["site"], "time"), base, rows(spark, (4, 0, 4.0)).schema)
    shutil.rmtree(f"{base}/site=A/date=2025-01-02")
    assert listed(store.read_days(spark, base, "2025-01-01", "2025-01-04")) == [(1, 0, 1.0), (3, 0, 3.0)]
    store.upsert_days(rows(spark, (4, 0, 5.0), (2, 1, 9.0)), base, HOURLY)
    assert listed(store.read_days(spark, base, "2025-01-01", "2025-01-04")) == [(1, 0, 1.0), (2, 1, 9.0), (3, 0, 3.0), (4, 0, 5.0)]


def test_a_month_of_many_saves_is_compacted(spark, monkeypatch):
    monkeypatch.setattr(dayindex, "MOST_FILES", 4)
    base = new_table_path(spark, "t")
    for k in range(6):
        store.write_days(rows(spark, (1 + k % 3, 0, float(k))), base, HOURLY)
    assert len(glob.glob(f"{base}/_index/month=2025-01/*.parquet")) == 2
    assert listed(store.read_days(spark, base, "2025-01-01", "2025-01-31")) == [(1, 0, 3.0), (2, 0, 4.0), (3, 0, 5.0)]


def test_names_of_folders_are_those_of_spark(spark):
    names = ["plain", "", None, "a/b", "x=1", "50%", "{q}[w]^", "tab\there", "quote\"'", "a b", "é漢", "back\\slash", "c:d?e#f*", "\x7f"]
    base = new_table_path(spark, "t")
    day = dt.datetime(2025, 1, 1)
    store.write_days(spark.createDataFrame([(name, day, float(k)) for k, name in enumerate(names)], SCHEMA), base, HOURLY)
    got = store.read_days(spark, base, "2025-01-01", "2025-01-01")
    assert sorted(r["value"] for r in got.collect()) == [float(k) for k in range(len(names))]
    assert {r["site"] for r in got.collect()} == set(names) - {""}


def test_columns_of_a_window_come_from_the_index(spark):
    """No file is opened to find columns; types that disagree are left to Spark."""
    base = new_table_path(spark, "t")
    store.write_days(rows(spark, (1, 0, 1.0)), base, HOURLY)
    store.write_days(rows(spark, (2, 0, 2.0, 7), schema=SCHEMA + ", more int"), base, HOURLY)
    got = store.read_days(spark, base, "2025-01-01", "2025-01-02")
    assert listed(got, "more") == [(1, 0, None), (2, 0, 7)] and got.columns == ["time", "value", "more", "site", "date"]
    store.write_days(rows(spark, (3, 0, "x"), schema="site string, time timestamp_ntz, more string"), base, HOURLY)
    with pytest.raises(Exception, match="merge"):
        store.read_days(spark, base, "2025-01-01", "2025-01-03").collect()
    assert dayindex.merged_schema([None, "{}"]) is None


def test_an_empty_window_of_a_store(spark):
    base = new_table_path(spark, "t")
    store.write_days(rows(spark, (1, 0, 1.0)), base, HOURLY)
    got = store.read_days(spark, base, "2025-01-02", "2025-01-05")
    assert got.collect() == [] and {"time", "value", "site", "date"} == set(got.columns)


def test_raw_files_of_days_that_exist(spark):
    base = new_table_path(spark, "raw")
    spark.createDataFrame([(f"2025-01-0{d}", f"v{d}") for d in (1, 2, 5)], "date string, value string").write.partitionBy("date").text(base)
    got = store.raw_file_manifest(spark, base, "2025-01-02", "2025-01-06")
    assert sorted({str(r["date"]) for r in got.collect()}) == ["2025-01-02", "2025-01-05"]
    assert store.raw_file_manifest(spark, base, "2026-01-01", "2026-01-02").collect() == []


def test_counts_come_from_the_job_that_reads(spark):
    df, seen = store.counted(rows(spark, (1, 0, 1.0), (1, 1, None), (2, 0, 3.0)), "seen", ["value"])
    store.write_days(df, new_table_path(spark, "t"), HOURLY)
    assert store.counts_of(seen, ["value"]) == {"rows": 3, "value": 2}
    for none in (spark.createDataFrame([], SCHEMA), rows(spark, (1, 0, 1.0)).where("false"), rows(spark, (1, 0, 1.0)).where("value > 5")):
        df, seen = store.counted(none, "none seen", ["value"])
        df.write.format("noop").mode("overwrite").save()
        assert store.counts_of(seen, ["value"]) == {"rows": 0, "value": 0}


def test_nothing_to_write(spark):
    """No rows, and rows without a time, which belong to no day."""
    base = new_table_path(spark, "t")
    none = spark.createDataFrame([], SCHEMA)
    store.write_days(none, base, HOURLY)
    store.upsert_days(none, base, HOURLY)
    store.write_days(rows(spark, (1, 0, 1.0)), base, HOURLY)
    store.upsert_days(none, base, HOURLY)
    assert listed(store.read_days(spark, base, "2025-01-01", "2025-01-31")) == [(1, 0, 1.0)]


def test_upsert(spark):
    base = new_table_path(spark, "t")
    wide = SCHEMA + ", old int"
    store.upsert_days(rows(spark, (1, 0, 1.0, 5), (2, 0, 2.0, 6), (2, 1, 3.0, 7), (3, 0, 4.0, 8), schema=wide), base, HOURLY)
    new = SCHEMA + ", fresh int"
    store.upsert_days(rows(spark, (2, 1, None, 70), (2, 2, 8.0, 71), (4, 0, 1.5, 72), schema=new), base, HOURLY)
    got = store.read_days(spark, base)
    assert listed(got) == [(1, 0, 1.0), (2, 0, 2.0), (2, 1, None), (2, 2, 8.0), (3, 0, 4.0), (4, 0, 1.5)]
    assert listed(got, "old") == [(1, 0, 5), (2, 0, 6), (2, 1, 7), (2, 2, None), (3, 0, 8), (4, 0, None)]
    assert listed(got, "fresh") == [(1, 0, None), (2, 0, None), (2, 1, 70), (2, 2, 71), (3, 0, None), (4, 0, 72)]


def test_trim_and_widen():
    first, last = store.widened(dt.date(2025, 1, 2), dt.date(2025, 1, 3))
    assert (first, last) == (dt.date(2025, 1, 1), dt.date(2025, 1, 4))


# --- Flux files --------------------------------------------------------------------------------------------------


@pytest.fixture
def flux_folder(tmp_path):
    site = tmp_path / "site=A"
    site.mkdir()
    (site / "full_output_1.csv").write_text(
        "file_info,,,fluxes,,\nfilename,date,time,H,qc_H,H\n,[yyyy],[HH:MM],[W],[#],[W]\n"
        "a.dat,2026-01-20,00:30,10.5,0,1\na.dat,2026-01-20,01:00,-9999,2,2\na.dat,2026-01-20,01:30,oops,1,NaN\n"
    )
    (site / "full_output_2.csv").write_text(
        'g,,,\n"filename","date","time","Tau"\n,[],[],[]\nb.dat,2026-01-20,02:00,0.7\nb.dat,2026-01-20,00:30,0.9\n'
    )
    (site / "qc_details_1.csv").write_text("g,,\ndate,time,qc_Tau\n[],[],[]\n2026-01-20,00:30,1\n2026-01-20,00:30,2\n")
    (site / "biomet_1.csv").write_text("date,time,H,RH\n[],[],[],[]\n2026-01-20,00:30,99,80\n")
    return str(tmp_path)


def test_flux_files(spark, flux_folder):
    got = fluxfiles.read_flux_files(spark, flux_folder, "*full_output*").orderBy("DateTime", "filename").collect()
    assert [(r["DateTime"].strftime("%H:%M"), r["filename"], r["H"], r["H_1"], r["qc_H"], r["Tau"]) for r in got] == [
        ("00:30", "a.dat", 10.5, 1.0, 0.0, None),
        ("00:30", "b.dat", None, None, None, 0.9),
        ("01:00", "a.dat", None, 2.0, 2.0, None),
        ("01:30", "a.dat", None, None, 1.0, None),
        ("02:00", "b.dat", None, None, None, 0.7),
    ]
    assert {r["site"] for r in got} == {"A"}


def test_quoted_commas_and_quotes(spark, tmp_path):
    (tmp_path / "one.csv").write_text(
        'g,,,,\n"filename","date",time,"H, corrected",H\n,[],[],[],[]\n"a, ""b"".dat",2026-01-20,00:30,"1",2\n'
        '"date, time",2026-01-20,01:00,3\n"x",2026-01-20,01:30,5,6,7,8\n'
    )
    (tmp_path / "two.csv").write_text("date,time,H\n2026-01-20,02:00,9\n")
    got = fluxfiles.read_flux_files(spark, str(tmp_path), "*.csv").orderBy("DateTime").collect()
    assert [(r["filename"], r["H, corrected"], r["H"]) for r in got] == [
        ('a, "b".dat', 1.0, 2.0), ("date, time", 3.0, None), ("x", 5.0, 6.0), (None, None, 9.0)
    ]


def test_flux_bundle(spark, flux_folder):
    full, quality, biomet = (
        fluxfiles.read_flux_files(spark, flux_folder, f"*{kind}*") for kind in ("full_output", "qc_details", "biomet")
    )
    bundle = fluxfiles.flux_bundle(full, quality, biomet, ["site"])
    got = {r["time"].strftime("%H:%M"): r for r in bundle.collect()}
    assert sorted(got) == ["00:00", "00:30", "01:00", "01:30"]
    # The first file's row is kept, the first quality row too, and the output's own H is not overwritten.
    first = got["00:00"]
    assert (first["filename"], first["H"], first["qc_Tau"], first["RH"]) == ("a.dat", 10.5, 1.0, 80.0)
    assert got["01:30"]["Tau"] == 0.7 and got["01:30"]["RH"] is None


def test_manual_flags_file(spark, tmp_path):
    path = tmp_path / "flags.csv"
    path.write_text(
        "SITE_ID,VARIABLES_AFFECTED,START_DATETIME,END_DATETIME,NOTE\n"
        "hill1,ta; rh;,2024-01-01 00:00:00,2024-01-02 00:00:00,x\nMOOR,all,2024-03-01 00:00:00,,y\n"
    )
    got = {(r["site"], r["variable"]): r["end"] for r in manualflags.read_manual_flags(spark, str(path)).collect()}
    assert got == {
        ("HILL1", "TA"): dt.datetime(2024, 1, 2),
        ("HILL1", "RH"): dt.datetime(2024, 1, 2),
        ("MOOR", "ALL"): None,
    }


# --- Metadata ----------------------------------------------------------------------------------------------------


def document(tmp_path, *items):
    path = tmp_path / "records.json"
    path.write_text(json.dumps({"meta": {"@id": "m"}, "items": list(items)}, indent=2))
    return str(path)


def ref(name):
    return {"@id": f"http://example.org/{name}"}


def test_configuration_in_all_its_shapes(spark, tmp_path):
    arguments = [
        {"parameter": ref("p/gt"), "hasValue": {"value": [5]}},
        {"parameter": ref("p/start-time"), "hasValue": {"value": "10:30:00"}},
        {"parameter": ref("p/codes"), "hasValue": {"value": [1.5, 7]}},
        {"parameter": ref("p/sensor-ta"), "hasValue": {"valueReference": ref("d/ta")}},
        {"parameter": ref("p/dep-ts"), "hasValue": {"valueReference": [ref("d/raw")]}},
        {
            "parameter": ref("p/wind-height"),
            "hasStructuredValue": {"argument": [{"parameter": ref("p/wind-height.source"), "hasValue": {"value": ["deployment"]}}]},
        },
    ]
    item = {
        "@id": "c1",
        "type": ref("configuration-type/qc/"),
        "appliesToDataset": [
            {"@id": "d1", "originatingSite": [ref("site/s1")]},
            {"@id": "d2", "originatingSite": [ref("site/s2")]},
        ],
        "hasCurrentValue": [
            {
                "method": ref("method/range"),
                "argument": arguments,
                "observationInterval": {"startDate": "2024-01-01T00:00:00"},
            },
            {"method": ref("method/spike"), "argument": []},
        ],
    }
    settings = metadata.method_settings(metadata.read_items(spark, document(tmp_path, item), "configuration"))
    got = sorted((r["dataset"], r["site"], r["kind"], r["position"], r["method"], r["start"]) for r in settings.collect() if r["position"] == 0)
    assert got == [("d1", "s1", "qc", 0, "range", dt.datetime(2024, 1, 1)), ("d2", "s2", "qc", 0, "range", dt.datetime(2024, 1, 1))]
    flat = metadata.arguments(settings).where("dataset = 'd1'")
    assert sorted((r["parameter"], r["role"], r["value"]) for r in flat.collect()) == [
        ("codes", "value", "1.5"),
        ("codes", "value", "7"),
        ("dep_ts", "dependency", "http://example.org/d/raw"),
        ("gt", "value", "5"),
        ("sensor_ta", "input", "http://example.org/d/ta"),
        ("start_time", "value", "10:30:00"),
        ("wind_height.wind_height.source", "nested", "deployment"),
    ]
    references = metadata.references(metadata.arguments(settings))
    assert references.count() == 4
    assert metadata.input_problems(metadata.arguments(settings)).count() == 0


def test_two_datasets_for_one_input_is_a_problem(spark, tmp_path):
    argument = {"parameter": ref("p/ta"), "hasValue": {"valueReference": [ref("a"), ref("b")]}}
    item = {
        "@id": "c",
        "type": ref("qc"),
        "appliesToDataset": [{"@id": "d", "originatingSite": [ref("s")]}],
        "hasCurrentValue": [{"method": ref("m"), "argument": [argument]}],
    }
    settings = metadata.method_settings(metadata.read_items(spark, document(tmp_path, item), "configuration"))
    assert metadata.input_problems(metadata.arguments(settings)).count() == 1


def test_annotations(spark, tmp_path):
    item = {
        "@id": "s",
        "hasAnnotation": [
            {"property": ref("ref-soc"), "hasValue": {"value": [0.03]}},
            {"property": ref("soil"), "hasValue": {"valueReference": ref("clay")}},
            {
                "property": ref("vwc-saturation"),
                "hasValueSeries": {
                    "hasCurrentValue": [
                        {"value": [0.5], "interval": {"startDate": "2020-01-01T00:00:00", "endDate": "2021-01-01T00:00:00"}},
                        {"value": 0.6, "interval": {"startDate": "2021-01-01T00:00:00"}},
                    ]
                },
            },
        ],
    }
    notes = metadata.annotations(metadata.read_items(spark, document(tmp_path, item), "site")).collect()
    assert sorted((r["property"], r["value"], r["end"]) for r in notes if r["property"] != "vwc_saturation") == [
        ("ref_soc", "0.03", None),
        ("soil", "http://example.org/clay", None),
    ]
    dated = sorted((r["start"], r["value"]) for r in notes if r["property"] == "vwc_saturation")
    assert dated == [(dt.datetime(2020, 1, 1), "0.5"), (dt.datetime(2021, 1, 1), "0.6")]


def test_active_sites(spark):
    day = dt.datetime
    data = [
        ("open", None, None),
        ("later", day(2024, 2, 2), None),
        ("last day", day(2024, 1, 31, 12), None),
        ("ended at start", day(2020, 1, 1), day(2024, 1, 1)),
        ("ended in", day(2020, 1, 1), day(2024, 1, 1, 1)),
    ]
    table = spark.createDataFrame(data, "site string, start timestamp_ntz, end timestamp_ntz")
    got = metadata.active_sites(table, "2024-01-01 06:00:00", "2024-01-31 00:00:00")
    assert sorted(r["site"] for r in got.collect()) == ["ended in", "last day", "open"]


def test_site_years_and_clamp(spark):
    day = dt.datetime
    data = [("a", day(2019, 6, 15), day(2021, 2, 10)), ("b", day(2030, 1, 1), None), ("c", None, None)]
    table = spark.createDataFrame(data, "site string, start timestamp_ntz, end timestamp_ntz")
    got = sorted((r["site"], r["start"], r["end"]) for r in metadata.site_years(table, "2022-03-04").collect())
    assert got == [
        ("a", dt.date(2019, 6, 15), dt.date(2019, 12, 31)),
        ("a", dt.date(2020, 1, 1), dt.date(2020, 12, 31)),
        ("a", dt.date(2021, 1, 1), dt.date(2021, 2, 10)),
    ]
    assert metadata.sites_without_start(table).count() == 1
    assert metadata.clamped_start(table.where("site <> 'c'"), "2010-01-01").first()[0] == day(2019, 6, 15)
    assert metadata.clamped_start(table, "2010-01-01").first()[0] == day(2010, 1, 1)
    assert metadata.clamped_start(table.where("site = 'b'"), "2031-01-01").first()[0] == day(2031, 1, 1)


# --- Streaming ---------------------------------------------------------------------------------------------------


def test_stream_reprocesses_touched_days(spark):
    """A late row changes its day's mean; other days stay, and nothing is lost when a batch comes twice."""
    landing, raw, done = (new_table_path(spark, name) for name in ("landing", "raw", "done"))
    daily = SeriesSpec.of("P1D")

    def plan(data):
        frame = runner.Frame(data, HOURLY)
        return runner.aggregate_to(frame, daily, Settings("mean")).df, daily

    def feed(data):
        data.write.mode("append").parquet(landing)
        stream = spark.readStream.schema(data.schema).parquet(landing)
        writer = reprocess_touched_days(stream, HOURLY, raw, done, plan)
        query = writer.option("checkpointLocation", landing + "-state").trigger(availableNow=True).start()
        query.awaitTermination()

    feed(rows(spark, (1, 0, 1.0), (1, 1, 3.0), (2, 0, 5.0)))
    assert listed(store.read_days(spark, done)) == [(1, 0, 2.0), (2, 0, 5.0)]
    feed(rows(spark, (1, 2, 8.0)))
    assert listed(store.read_days(spark, done)) == [(1, 0, 4.0), (2, 0, 5.0)]
    feed(rows(spark, (1, 2, 8.0), (3, 0, 7.0)))
    assert listed(store.read_days(spark, done)) == [(1, 0, 4.0), (2, 0, 5.0), (3, 0, 7.0)]
