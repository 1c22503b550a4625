import datetime as dt
import random

import pytest

from tidemark.operators import flagging, quality
from tidemark.operators.flagging import FlagColumns
from tidemark.plans import runner
from tidemark.plans.methods import Frame, Settings, get_method
from tidemark.sources.manualflags import parse_manual_flags

T, F, N = True, False, None
ONE_TO_SEVEN = [1, 2, 3, 4, 5, 6, 7]
DATES = {"start": dt.datetime(2025, 1, 1, 2), "end": dt.datetime(2025, 1, 1, 4, 59)}


def run(frame, name, inputs=None, dates=False, **params):
    return get_method("quality_control", name)(frame, Settings(name, params, inputs or {}, **(DATES if dates else {})))


def test_range(series, values):
    frame = series(ONE_TO_SEVEN)
    assert values(run(frame, "range", lt=3, gt=5), "_failed") == [T, T, F, F, F, T, T]
    assert values(run(frame, "range", dates=True, lt=4, gt=4), "_failed") == [F, F, T, F, T, F, F]


def test_range_passes_nan(series, values):
    result = values(run(series([float("nan"), 9.0]), "range", lt=3, gt=5), "_failed")
    assert result[0] in (None, False) and result[1] is True


def test_error_code(series, values):
    frame = series(ONE_TO_SEVEN)
    assert values(run(frame, "error_code", value=[2, 5]), "_failed") == [F, T, F, F, T, F, F]
    assert values(run(frame, "error_code", value=2), "_failed") == [F, T, F, F, F, F, F]


def plain_spikes(numbers, limit):
    found = []
    for k, v in enumerate(numbers):
        around = [numbers[n] for n in (k - 1, k + 1) if 0 <= n < len(numbers)]
        if v is None or len(around) < 2 or None in around:
            found.append(None)
        else:
            above = [v - a > limit for a in around]
            below = [a - v > limit for a in around]
            found.append(all(above) or all(below))
    return found


@pytest.mark.parametrize("chunk", [None, 3])
def test_spike(series, values, chunk):
    chance = random.Random(17)
    sites = {s: [chance.choice([None, *(chance.uniform(0, 4) for _ in range(5)), 30.0, -30.0]) for _ in range(25)] for s in "AB"}
    result = quality.spike(series(sites), Settings("spike", {"gt": 6.5}), chunk)
    expected = {s: plain_spikes(sites[s], 6.5) for s in "AB"}
    assert values(result, "_failed") == expected["A"] + expected["B"] and T in expected["A"]
    dated = quality.spike(series(sites), Settings("spike", {"gt": 6.5}, {}, **DATES), chunk)
    assert values(dated, "_failed") == [v if 2 <= k <= 4 else F for s in "AB" for k, v in enumerate(expected[s])]


def test_time_of_day(series, values):
    result = run(series(ONE_TO_SEVEN), "hfp_removal", time_ge="01:00:00", time_le="03:00:00")
    assert values(result, "_failed") == [F, T, T, T, F, F, F]


@pytest.mark.parametrize(
    ("name", "key", "params", "expected"),
    [
        ("battery_v", "battv", {"lt": 3}, [T, T, F, F, F, F, F]),
        ("samples", "scans", {"lt": 3}, [T, T, F, F, F, F, F]),
        ("snowd_signal", "signal_quality", {"lt": 3}, [T, T, F, F, F, F, F]),
        ("tdt_tsoil", "soil_ta", {"lt": 3}, [T, T, F, F, F, F, F]),
        ("pluvio_diag", "sensor_diag", {"gt": 5}, [F, F, F, F, F, T, T]),
        ("nr01_temp", "sensor_ta", {"lt": 3, "gt": 5}, [T, T, F, F, F, T, T]),
        ("flux_qc_flag", "qc_flag", {}, [F, T, F, F, F, F, F]),
    ],
)
def test_companion_checks(series, values, name, key, params, expected):
    inputs = {key: series(ONE_TO_SEVEN, "other")}
    assert values(run(series([10] * 7), name, inputs, **params), "_failed") == expected
    if name != "flux_qc_flag":
        dated = values(run(series([10] * 7), name, inputs, dates=True, **params), "_failed")
        assert dated == [e and 2 <= n <= 4 for n, e in enumerate(expected)]


def test_companion_is_lined_up_by_time(series, values):
    late = series([1, 5, 1, 1], "battv", start=dt.datetime(2025, 1, 1, 1))
    assert values(run(series([1, 2, 3, 4]), "battery_v", {"battv": late}, lt=3), "_failed") == [N, T, F, T]


def test_manual_removal(spark, series, values):
    listed = spark.createDataFrame(
        [
            (" a ", "value; other ;", "2025-01-01 01:00:00", "2025-01-01 02:00:00"),
            ("A", "all", "2025-01-01 02:00:00", "2025-01-01 03:00:00"),
            ("A", "OTHER", "2025-01-01 00:00:00", None),
            ("B", "VALUE", "2025-01-01 05:00:00", None),
        ],
        "SITE_ID string, VARIABLES_AFFECTED string, START_DATETIME string, END_DATETIME string",
    )
    periods = parse_manual_flags(listed)
    assert sorted((r["site"], r["variable"]) for r in periods.collect()) == [
        ("A", "ALL"),
        ("A", "OTHER"),
        ("A", "OTHER"),
        ("A", "VALUE"),
        ("B", "VALUE"),
    ]
    frame = series({"A": ONE_TO_SEVEN, "b": ONE_TO_SEVEN, "C": [1]})
    result = run(frame, "manual_removal", {"periods": Frame(periods, frame.spec)})
    assert values(result, "_failed") == [F, T, T, T, F, F, F] + [F] + [F, F, F, F, F, T, T]


FLAGS = FlagColumns({"core": "core", "quality_control": "qc"}, {"quality_control": {"range": 1, "error_code": 2}})


def test_step_removes_what_failed(series, values):
    frame = series([10, 200, 30, 300])
    loaded = runner.load(frame, frame.spec, FLAGS)
    result = runner.check(loaded, [Settings("range", {"lt": 0, "gt": 100})])
    assert values(result.df) == [10, None, 30, None]
    assert values(result.df, "qc") == [0, 1, 0, 1]
    assert values(result.df, "core") == [0, 8, 0, 8]


def test_only_removed_values_get_the_removed_flag(spark, values):
    rows = [("A", dt.datetime(2025, 1, 1, h), v, q, c) for h, (v, q, c) in enumerate(
        [(10.0, 0, 0), (200.0, 1, 1), (None, 1, 4), (float("nan"), 1, 4)])]
    df = spark.createDataFrame(rows, "site string, time timestamp_ntz, value double, qc int, core int")
    result = flagging.remove_flagged(df, "value", "qc", "core")
    assert values(result) == [10, None, None, None]
    assert values(result, "core") == [0, 9, 4, 4]


def test_removal_waits_for_the_last_block(series, values):
    frame = series([10, 200, 30])
    checks = [Settings("range", {"lt": 0, "gt": 100}), Settings("error_code", {"value": [200]})]
    steps = (runner.Step("load", source="raw"), *(runner.Step("quality_control", (c,)) for c in checks))
    result = runner.run_plan(runner.DatasetPlan(frame.spec, steps, FLAGS), {"raw": frame})
    # The second block still sees 200, which the first failed.
    assert values(result.df, "qc") == [0, 3, 0]
    assert values(result.df) == [10, None, 30]


def test_without_qc_flag_column_nothing_is_removed(series, values):
    frame = series([10, 200])
    result = runner.check(runner.Series(frame.df, frame.spec), [Settings("range", {"lt": 0, "gt": 100})])
    assert values(result.df) == [10, 200]
    assert result.df.columns == ["site", "time", "value"]
