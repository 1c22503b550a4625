import datetime as dt
import math
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from tidemark.functions.flagbits import CORE_FLAGS
from tidemark.operators import aggregate
from tidemark.operators.chunks import moving_sums, own_rows, with_halo, with_slot
from tidemark.operators.flagging import FlagColumns
from tidemark.plans import runner
from tidemark.plans.methods import Frame, Settings, get_method
from tidemark.spec import Period, SeriesSpec

DAY = list(range(24))


def run(frame, name, period="P1D", **params):
    return get_method("aggregation", name)(frame, Settings(name, {"aggregation_period": period} | params))


@pytest.mark.parametrize(
    ("name", "expected"), [("sum", 276), ("mean", 11.5), ("min", 0), ("max", 23), ("mean_rad", 0.9936), ("mean_sum", 276)]
)
def test_simple(series, values, name, expected):
    result = run(series(DAY), name)
    assert values(result) == pytest.approx([expected])
    assert values(result, "time") == [dt.datetime(2025, 1, 1)]
    assert values(result, "count_value") == [24] and values(result, "expected_count_time") == [24]


def test_series_stay_apart(series, values):
    assert values(run(series({"A": DAY, "B": [7] * 30}), "mean")) == pytest.approx([11.5, 7, 7])


def test_angular_mean(series, values):
    assert values(run(series(list(range(72))), "angular_mean")) == pytest.approx([11.5, 35.5, 59.5])
    assert values(run(series([350, 10, 20, 340]), "angular_mean"))[0] % 360 == pytest.approx(0, abs=1e-9)
    assert values(run(series([270, 280]), "angular_mean")) == pytest.approx([275])


def test_time_window(series, values):
    window = {"start_time": "10:30:00", "end_time": "14:00:00"}
    assert values(run(series(DAY), "mean", **window)) == pytest.approx([12.5])
    deviation = run(series(DAY), "stdev", threshold=7, **window)
    assert values(deviation) == pytest.approx([1.290994], abs=1e-6)
    assert values(deviation, "expected_count_time") == [4] and values(deviation, "valid_value") == [False]
    # No row in the window, no bucket.
    early = series(list(range(9)))
    assert values(run(early, "stdev", **window)) == []


@pytest.mark.parametrize("threshold", [1, 24, 42])
def test_threshold_keeps_the_value_in_the_method(series, values, threshold):
    result = run(series(DAY), "sum", threshold=threshold)
    assert values(result) == [276]
    assert values(result, "valid_value") == [threshold <= 24]


def test_nan_is_skipped(series, values):
    result = run(series([1, float("nan"), 3, None]), "mean")
    assert values(result) == [2] and values(result, "count_value") == [2]


def test_point_estimate(series, values):
    result = run(series(list(range(48))), "point_estimate", n=12)
    assert values(result) == [12, 36]
    assert values(result, "time_of_nth_value") == [dt.datetime(2025, 1, 1, 12), dt.datetime(2025, 1, 2, 12)]


def test_point_estimate_of_end_anchored_series(series, values):
    result = run(series(list(range(48)), anchor="end"), "point_estimate", n=12)
    assert values(result) == [None, 13, 37]
    assert values(result, "time_of_nth_value")[1:] == [dt.datetime(2025, 1, 1, 13), dt.datetime(2025, 1, 2, 13)]


def test_label_at_the_end(series, values):
    result = run(series(list(range(25)), anchor="end"), "sum", aggregation_time_anchor="end")
    assert values(result, "time") == [dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)]
    assert values(result) == [0, 300]


def test_months(series, values):
    frame = series([1.0] * 60, period="P1D")
    result = run(frame, "sum", "P1M")
    assert values(result, "time") == [dt.datetime(2025, 1, 1), dt.datetime(2025, 2, 1), dt.datetime(2025, 3, 1)]
    assert values(result) == [31, 28, 1] and values(result, "expected_count_time") == [31, 28, 31]
    yearly = run(frame, "sum", "P1Y")
    assert values(yearly) == [60] and values(yearly, "expected_count_time") == [365]


def test_step_flags_and_nulls(spark, values):
    """Three days with 4, 2 and 2 half hours; at least 3 of the 48 are wanted."""
    start = dt.datetime(2025, 1, 1)
    times = [start + dt.timedelta(days=d, minutes=30 * n) for d, many in enumerate((4, 2, 2)) for n in range(many)]
    df = spark.createDataFrame([("A", t, 10.0) for t in times], "site string, t timestamp_ntz, raw double")
    source = Frame(df, SeriesSpec.of("PT30M", time="t", value="raw"))
    target = SeriesSpec.of("P1D", value="mean")
    flags = FlagColumns({"core": "core", "infill": "filled"}, {"core": CORE_FLAGS})
    result = runner.aggregate_to(source, target, Settings("mean", {"threshold": 3}), flags)
    assert result.df.columns == ["site", "time", "mean", "core", "filled"]
    assert values(result.df, "mean") == [10, None, None]
    assert values(result.df, "core") == [2, 8, 8]


def test_empty_bucket_is_missing(series, values):
    frame = series([None] * 24 + [1] * 24)
    result = runner.aggregate_to(
        frame, SeriesSpec.of("P1D"), Settings("sum"), FlagColumns({"core": "core"}, {"core": CORE_FLAGS})
    )
    assert values(result.df) == [None, 24] and values(result.df, "core") == [4 + 2, 0]


# --- Rolling -----------------------------------------------------------------------------------------------------

@pytest.mark.parametrize(("window", "alignment"), [(6, "center"), (6, "trailing"), (7, "leading"), (40, "center")])
def test_rolling_against_plain_lists(series, values, window, alignment):
    chance = random.Random(window)
    numbers = [chance.choice([None, float(chance.randint(0, 50))]) for _ in range(70)]
    params = {"window_size": f"PT{window}H", "threshold": 2, "alignment": alignment}
    result = aggregate.rolling_mean(series(numbers), Settings("rolling_mean_for_counts", params), 8)
    before = {"center": window // 2, "trailing": window - 1, "leading": 0}[alignment]
    masked_end = {"center": window // 2, "trailing": 0, "leading": window - 1}[alignment]
    expected = []
    for n in range(len(numbers)):
        part = [v for v in numbers[max(n - before, 0) : n - before + window] if v is not None]
        whole = n >= before and n < len(numbers) - masked_end
        expected.append(statistics.fmean(part) if whole and len(part) >= 2 else None)
    got = values(result)
    assert [v is None for v in got] == [v is None for v in expected]
    assert [v for v in got if v is not None] == pytest.approx([v for v in expected if v is not None])


@pytest.mark.parametrize("chunk", [None, 8])
@pytest.mark.parametrize("size", [1, 2, 5, 13, 90])
def test_moving_sums_against_plain_lists(series, size, chunk):
    chance = random.Random(size)
    numbers = {s: [chance.choice([None, 10.0 ** chance.randint(-8, 12)]) for _ in range(n)] for s, n in (("A", 60), ("B", 3), ("C", 1))}
    frame = series(numbers)
    rows = with_halo(with_slot(frame.df, frame.spec), "_slot", size - 1, size - 1, chunk or 16_384)
    got = own_rows(moving_sums(rows, frame.spec, {"x": F.col("value"), "n": F.when(F.col("value").isNotNull(), 1)}, size))
    found = {}
    for row in got.orderBy("time").collect():
        found.setdefault(row["site"], []).append(row)
    for site, own in numbers.items():
        for k, row in enumerate(found[site]):
            for name, part in (("back", own[max(0, k - size + 1) : k + 1]), ("ahead", own[k : k + size])):
                held = [v for v in part if v is not None]
                assert row[f"n_{name}"] == len(held) and row[f"x_{name}"] == pytest.approx(math.fsum(held), rel=1e-12)


def test_work_for_a_row_does_not_depend_on_the_window(series):
    """No frame but running ones and single rows at a distance, whatever the window; the plans differ in numbers alone."""
    plans = []
    for hours in (10, 10_000):
        settings = Settings("rolling_mean_for_counts", {"window_size": f"PT{hours}H", "threshold": 1, "alignment": "trailing"})
        rolled = aggregate.rolling_mean(series([1.0, 2.0]), settings)
        plan = rolled._jdf.queryExecution().optimizedPlan().toString()
        frames = re.findall(r"specifiedwindowframe\((\w+), ([^,]+), ([^)]+)\)", plan)
        assert frames and all(low == high or "unbounded" in low for _, low, high in frames)
        plans.append(len(plan.splitlines()))
    assert plans[0] == plans[1]


def test_rolling_needs_a_fixed_number_of_rows(series):
    for frame, size in ((series([1, 2, 3]), "P1M"), (series([1, 2, 3]), "PT90M")):
        params = {"window_size": size, "threshold": 1, "alignment": "center"}
        with pytest.raises(ValueError):
            aggregate.rolling_mean(frame, Settings("rolling_mean_for_counts", params))
    monthly = Frame(series([1]).df, SeriesSpec(Period(months=1)))
    with pytest.raises(ValueError):
        aggregate.rolling_mean(monthly, Settings("rolling_mean_for_counts", {"window_size": "P2M"}))


def test_mean_rad_needs_a_fixed_period(series):
    with pytest.raises(ValueError):
        run(series(DAY), "mean_rad", "P1M")
    assert math.isclose(Period.parse("P1D").seconds, 86400)


def test_expected_count_in_a_window_that_cuts_buckets(series, values):
    """Half past ten to two o'clock, on quarter hours: 2 in the first hour, 1 in the last, 4 in between, else none."""
    frame = series([1.0] * 96, period="PT15M")
    params = {"aggregation_period": "PT1H", "start_time": "10:30:00", "end_time": "14:00:00"}
    result = get_method("aggregation", "mean")(frame, Settings("mean", params))
    assert values(result, "expected_count_time") == [2, 4, 4, 4, 1] == values(result, "count_value")
    ends = series([1.0] * 96, period="PT15M", anchor="end")
    result = get_method("aggregation", "mean")(ends, Settings("mean", params))
    assert values(result, "expected_count_time") == values(result, "count_value")
