import datetime as dt

import pytest

from tidemark.functions.flagbits import CORE_FLAGS
from tidemark.operators.flagging import FlagColumns
from tidemark.plans.methods import Frame, Settings
from tidemark.plans import runner
from tidemark.plans.run import Stored, load_stored, process_window
from tidemark.plans.runner import DatasetPlan, Step, run_plan, run_plans
from tidemark.session import new_table_path
from tidemark.sources import store
from tidemark.spec import SeriesSpec

HOURLY, DAILY = SeriesSpec.of("PT1H"), SeriesSpec.of("P1D", value="daily")
FLAGS = FlagColumns(
    {"core": "core", "correction": "corr", "quality_control": "qc", "infill": "fill"},
    {"correction": {"add": 1}, "quality_control": {"range": 1}, "infill": {"linear_interp": 1}},
)
CLEAN = (
    Step("load", source="raw"),
    Step("correction", (Settings("add", {"correction_factor": 1}),)),
    Step("quality_control", (Settings("range", {"lt": 0, "gt": 100}),)),
    Step("infill", (Settings("linear_interp"),)),
)


def test_load_correct_check_fill_aggregate(series, values):
    numbers = [10.0] * 24
    numbers[5], numbers[6], numbers[23] = 500.0, None, None
    plans = {
        "daily": DatasetPlan(
            DAILY,
            (Step("aggregation", (Settings("mean", {"threshold": 20}),), source="hourly"),),
            FlagColumns({"core": "daily_core"}, {"core": CORE_FLAGS}),
        ),
        "hourly": DatasetPlan(HOURLY, CLEAN, FLAGS),
    }
    result = run_plans(plans, {"raw": series(numbers)})
    result.raise_if_failed()
    hourly = result.done["hourly"].df
    assert values(hourly) == [11.0] * 23 + [None]
    assert values(hourly, "corr") == [1] * 6 + [0] + [1] * 16 + [0]
    # Hour 5 was corrected, removed and filled; hour 6 was missing and filled; hour 23 stays missing.
    core = values(hourly, "core")
    assert core[4:7] == [1, 1 + 8 + 2, 4 + 2] and core[23] == 4
    assert values(result.done["daily"].df, "daily") == [11.0]
    assert values(result.done["daily"].df, "daily_core") == [2]


def test_a_failure_takes_its_descendants_along(series, values):
    good = DatasetPlan(HOURLY, (Step("load", source="raw"),))
    bad = DatasetPlan(HOURLY, (Step("load", source="raw"), Step("correction", (Settings("no_such_method"),))))
    late = DatasetPlan(HOURLY, (Step("load", source="bad"),))
    later = DatasetPlan(DAILY, (Step("aggregation", (Settings("mean"),), source="late"),))
    nowhere = DatasetPlan(HOURLY, (Step("load", source="not there"),))
    plans = {"later": later, "late": late, "bad": bad, "good": good, "nowhere": nowhere}
    result = run_plans(plans, {"raw": series([1, 2])})
    assert set(result.done) == {"good"}
    assert set(result.failed) == {"bad", "late", "later", "not there", "nowhere"}
    assert values(result.done["good"].df) == [1, 2]
    with pytest.raises(RuntimeError):
        result.raise_if_failed()


def test_named_inputs_come_from_other_plans(series, values):
    step = Step("quality_control", (Settings("battery_v", {"lt": 3}),), inputs={"battery_v": {"battv": "battery"}})
    flags = FlagColumns({"quality_control": "qc"}, {"quality_control": {"battery_v": 4}})
    plans = {
        "battery": DatasetPlan(HOURLY.with_(value="b"), (Step("load", source="raw battery"),)),
        "checked": DatasetPlan(HOURLY, (Step("load", source="raw"), step), flags),
    }
    result = run_plans(plans, {"raw": series([1, 2, 3]), "raw battery": series([5, 1, 5], "v")})
    assert values(result.done["checked"].df) == [1, None, 3]


def test_a_plan_cannot_start_with_a_check(series):
    for steps in ((Step("quality_control"),), (), (Step("dance"),)):
        with pytest.raises(ValueError):
            run_plan(DatasetPlan(HOURLY, steps), {"raw": series([1])})


def test_load_only_relabels_the_anchor(series, values):
    target = HOURLY.with_(time="end_time", value="ta", anchor="end")
    loaded = run_plan(DatasetPlan(target, (Step("load", source="raw"),)), {"raw": series([1, 2])})
    assert loaded.df.columns == ["site", "end_time", "ta"] and loaded.spec.anchor == "end"
    assert isinstance(loaded.frame, Frame)


# --- Parameters by site ------------------------------------------------------------------------------------------


def table_of(spark, columns, *rows):
    return spark.createDataFrame(list(rows), f"site string, start timestamp_ntz, end timestamp_ntz, {columns}")


def test_each_site_and_period_has_its_own_factor(spark, series, values):
    hour = lambda n: dt.datetime(2025, 1, 1, n)
    factors = table_of(
        spark, "correction_factor double", ("A", hour(0), hour(1), 2.0), ("A", hour(2), None, 3.0), ("B", None, hour(1), 10.0)
    )
    frame = series({"A": [1, 1, 1, 1], "B": [1, 1, 1], "C": [1]})
    loaded = runner.load(frame, HOURLY, FlagColumns({"correction": "corr"}, {"correction": {"add": 1}}))
    result = runner.correct(loaded, [Settings("add", by_site=factors)])
    assert values(result.df) == [3, 3, 4, 4] + [11, 11, 1] + [1]
    assert values(result.df, "corr") == [1, 1, 1, 1] + [1, 1, 0] + [0]
    assert result.df.columns == ["site", "time", "value", "corr"]


def test_checks_with_limits_by_site(spark, series, values):
    limits = table_of(spark, "lt double, gt double", ("A", None, None, 0.0, 5.0), ("B", None, None, 0.0, 50.0))
    flags = FlagColumns({"quality_control": "qc"}, {"quality_control": {"range": 1, "battery_v": 2, "spike": 4}})
    frame = series({"A": [1, 10, 1], "B": [1, 10, 1], "C": [1, 10, 1]})
    checked = runner.check(runner.load(frame, HOURLY, flags), [Settings("range", by_site=limits)])
    assert values(checked.df) == [1, None, 1] + [1, 10, 1] + [1, 10, 1]
    low = table_of(spark, "lt double", ("A", None, None, 5.0))
    battery = series({"A": [1, 9, 1], "C": [1, 1, 1]}, "v")
    checked = runner.check(
        runner.load(frame, HOURLY, flags), [Settings("battery_v", inputs={"battv": battery}, by_site=low)]
    )
    assert values(checked.df, "qc") == [2, 0, 2] + [0, 0, 0] + [0, 0, 0]
    steep = table_of(spark, "gt double", ("A", None, None, 5.0), ("B", None, None, 20.0))
    checked = runner.check(runner.load(frame, HOURLY, flags), [Settings("spike", by_site=steep)])
    assert values(checked.df, "qc") == [0, 4, 0] + [0, 0, 0] + [0, 0, 0]


def test_clip_and_infill_by_site(spark, series, values):
    limits = table_of(spark, "min double, max double", ("A", None, None, 0.0, None), ("B", None, None, None, 5.0))
    frame = series({"A": [-1, 9], "B": [-1, 9], "C": [-1, 9]})
    result = runner.correct(runner.Series(frame.df, HOURLY), [Settings("clip", by_site=limits)])
    assert values(result.df) == [0, 9] + [-1, 5] + [-1, 9]
    factors = table_of(spark, "correction_factor double", ("A", None, None, 0.5))
    gappy = series({"A": [1, None], "B": [1, None]})
    inputs = {"alt_data_source": series({"A": [8, 8], "B": [8, 8]}, "alt")}
    filled = runner.fill(runner.Series(gappy.df, HOURLY), [Settings("alt_data", inputs=inputs, by_site=factors)])
    assert values(filled.df) == [1, 4] + [1, None]


def test_overlapping_parameters_are_an_error(spark, series):
    factors = table_of(
        spark, "correction_factor double", ("A", None, dt.datetime(2025, 1, 1), 2.0), ("A", dt.datetime(2025, 1, 1), None, 3.0)
    )
    frame = series([1])
    with pytest.raises(ValueError, match="overlap"):
        runner.correct(runner.Series(frame.df, HOURLY), [Settings("add", by_site=factors)])


# --- Reading, processing and saving a window ---------------------------------------------------------------------


def test_process_window(spark, values):
    """Three stored days; the middle one is processed. The end-anchored daily mean needs a row of the next day."""
    raw, out = new_table_path(spark, "raw"), new_table_path(spark, "out")
    start = dt.datetime(2025, 1, 1)
    rows = [("A", start + dt.timedelta(hours=n), float(n), 1.0) for n in range(73) if n != 30]
    stored = spark.createDataFrame(rows, "site string, time timestamp_ntz, ta double, rh double")
    store.write_days(stored, raw, HOURLY)
    raw_ta, raw_no = HOURLY.with_(value="ta", anchor="end"), HOURLY.with_(value="gone")
    flags = FlagColumns({"core": "TA_CORE"}, {"core": CORE_FLAGS})
    daily = SeriesSpec.of("P1D", value="TA", anchor="end")
    hourly_flags = FlagColumns({"core": "RH_CORE"})
    plans = {
        "mean": DatasetPlan(daily, (Step("aggregation", (Settings("mean"),), source="ta"),), flags),
        "rh": DatasetPlan(HOURLY.with_(value="RH"), (Step("load", source="raw rh"),), hourly_flags),
        "ta hourly": DatasetPlan(HOURLY.with_(value="TAH"), (Step("load", source="ta"),)),
    }
    inputs = {"ta": Stored(raw, raw_ta), "raw rh": Stored(raw, HOURLY.with_(value="rh"))}
    outputs = {"mean": out + "/daily", "rh": out + "/hourly", "ta hourly": out + "/hourly"}
    day = dt.date(2025, 1, 2)
    result = process_window(spark, plans, inputs, outputs, day, day)
    assert result.counts == {
        "mean": {"rows": 1, "values": 1, "missing": 0},
        "rh": {"rows": 24, "values": 23, "missing": 1},
        "ta hourly": {"rows": 24, "values": 23, "missing": 1},
    }
    saved = store.read_days(spark, out + "/hourly")
    assert saved.count() == 24 and {"RH", "RH_CORE", "TAH"} <= set(saved.columns)
    assert sum(v is None for v in values(saved, "RH")) == 1
    means = store.read_days(spark, out + "/daily")
    assert values(means, "time") == [dt.datetime(2025, 1, 2)]
    # The day that ended at midnight of the 2nd: hours 1 to 24.
    assert values(means, "TA") == [12.5] and values(means, "TA_CORE") == [0]

    # A dataset whose column is not stored fails alone, with those that need it; the others are saved.
    plans["lost"] = DatasetPlan(HOURLY.with_(value="LOST"), (Step("load", source="gone"),))
    inputs["gone"] = Stored(raw, raw_no)
    with pytest.raises(RuntimeError, match="lost"):
        process_window(spark, plans, inputs, outputs | {"lost": out + "/lost"}, dt.date(2025, 1, 3), dt.date(2025, 1, 3))
    assert store.read_days(spark, out + "/hourly").count() == 48

    # Datasets of differing cadence cannot share a location.
    with pytest.raises(RuntimeError, match="Periods differ"):
        process_window(spark, {"mean": plans["mean"], "rh": plans["rh"]}, inputs | {"gone": inputs["ta"]},
                       {"mean": out + "/mixed", "rh": out + "/mixed"}, day, day)


def test_a_dataset_off_the_grid_fails_alone(spark, values):
    """Both lie in one location; a row off the grid has a value of one only."""
    raw = new_table_path(spark, "raw")
    start = dt.datetime(2025, 1, 1)
    rows = [("A", start + dt.timedelta(hours=n), float(n), 1.0) for n in range(5)] + [("A", start + dt.timedelta(minutes=90), 7.0, None)]
    store.write_days(spark.createDataFrame(rows, "site string, time timestamp_ntz, ta double, rh double"), raw, HOURLY)
    stored = {"ta": Stored(raw, HOURLY.with_(value="ta")), "rh": Stored(raw, HOURLY.with_(value="rh"))}
    loaded = load_stored(spark, stored, start.date(), start.date())
    assert loaded.failed == {"ta": f"rows off the grid at {raw}"}
    assert values(loaded.frames["rh"].df, "rh") == [1.0] * 5


def test_nothing_stored_fails(spark):
    loaded = load_stored(spark, {"x": Stored(new_table_path(spark, "none"), HOURLY)}, dt.date(2025, 1, 1), dt.date(2025, 1, 2))
    assert not loaded.frames and "nothing stored" in loaded.failed["x"]
