import datetime as dt
import random

import pytest

from tidemark.operators import align, intervals as spans
from tidemark.operators.chunks import number_rows, running_max_since, with_slot
from tidemark.sources import ancillary
from tidemark.spec import SeriesSpec
from pyspark.sql import functions as F

HOURLY = SeriesSpec.of("PT1H")


def at(hour, day=1):
    return dt.datetime(2025, 1, day, hour)


def intervals(spark, *rows):
    return spark.createDataFrame(list(rows), "site string, start timestamp_ntz, end timestamp_ntz, height double")


# --- Padding -----------------------------------------------------------------------------------------------------


def test_pad_per_series(spark, values):
    rows = [("A", at(0), 1.0), ("A", at(3), 4.0), ("B", at(5), 9.0)]
    df = spark.createDataFrame(rows, "site string, time timestamp_ntz, value double")
    padded = align.pad(df, HOURLY)
    assert values(padded) == [1, None, None, 4, 9]
    assert values(padded, "time") == [at(0), at(1), at(2), at(3), at(5)]


def test_pad_keeps_the_offset_of_the_grid(spark, values):
    rows = [("A", dt.datetime(2025, 1, 1, 0, 10), 1.0), ("A", dt.datetime(2025, 1, 1, 2, 10), 3.0)]
    df = spark.createDataFrame(rows, "site string, time timestamp_ntz, value double")
    assert values(align.pad(df, HOURLY)) == [1, None, 3]


def test_rows_off_the_grid_are_not_lost_silently(spark, values):
    rows = [("A", at(0), 1.0, 1.0), ("A", at(2), 3.0, None), ("A", dt.datetime(2025, 1, 1, 1, 10), 2.0, None), ("B", at(5), 1.0, 1.0)]
    df = spark.createDataFrame(rows, "site string, time timestamp_ntz, value double, other double")
    with pytest.raises(Exception, match="off the grid of series"):
        align.pad(df, HOURLY).collect()
    padded, lost = align.pad_together(df, HOURLY, ["other", "value"])
    assert lost == ["value"] and values(padded, "other") == [1, None, None, 1]
    months = spark.createDataFrame([("A", dt.datetime(2025, 1, 1), 1.0), ("A", dt.datetime(2025, 2, 3), 1.0)], "site string, time timestamp_ntz, value double")
    with pytest.raises(Exception, match="off the grid"):
        align.pad(months, SeriesSpec.of("P1M")).collect()
    assert align.pad_together(months, SeriesSpec.of("P1M"), ["value"])[1] == ["value"]
    none, lost = align.pad_together(df.where("false"), HOURLY, ["value"])
    assert none.count() == 0 and lost == []


def test_pad_months(spark, values):
    rows = [("A", dt.datetime(2024, 11, 1), 1.0), ("A", dt.datetime(2025, 2, 1), 2.0)]
    df = spark.createDataFrame(rows, "site string, time timestamp_ntz, value double")
    padded = align.pad(df, SeriesSpec.of("P1M"))
    assert [t.month for t in values(padded, "time")] == [11, 12, 1, 2]
    assert values(padded) == [1, None, None, 2]


def test_pad_range(spark, values):
    df = spark.createDataFrame([("A", at(1), 1.0)], "site string, time timestamp_ntz, value double")
    assert values(align.pad_range(df, HOURLY, at(0), at(3))) == [None, 1, None, None]


def test_long_grid_spans_blocks(spark):
    df = spark.createDataFrame([("A", dt.datetime(2000, 1, 1)), ("A", dt.datetime(2010, 1, 1))], "site string, time timestamp_ntz")
    padded = align.pad(df, HOURLY)
    assert padded.count() == padded.distinct().count() == 3653 * 24 + 1


# --- Joins -------------------------------------------------------------------------------------------------------


def test_merge_three_series(spark, series, values):
    frames = [
        series([1, 2, 3], "a").pair(),
        series([20, 30], "b", start=at(1)).pair(),
        series([300, 400], "c", start=at(2), anchor="end").pair(),
    ]
    merged = align.merge_series(frames)
    assert values(merged, "a") == [1, 2, 3, None]
    assert values(merged, "b") == [None, 20, 30, None]
    assert values(merged, "c") == [None, None, 300, 400]
    with pytest.raises(ValueError):
        align.merge_series([series([1], "a").pair(), series([1], "a").pair()])
    with pytest.raises(ValueError):
        align.merge_series([series([1], "a").pair(), series([1], "b", period="P1D").pair()])


def test_upsert(spark):
    old = spark.createDataFrame([(1, 10, 0, "x"), (2, 20, 0, "y"), (3, 30, 0, "z")], "id int, value int, flag int, old string")
    new = spark.createDataFrame([(2, None, 8, 2.0), (4, 40, 0, 4.0)], "id int, value int, flag int, fresh double")
    rows = {r["id"]: r for r in align.upsert(old, new, ["id"]).collect()}
    assert [rows[n]["value"] for n in (1, 2, 3, 4)] == [10, None, 30, 40]
    assert [rows[n]["flag"] for n in (1, 2, 3, 4)] == [0, 8, 0, 0]
    assert [rows[n]["old"] for n in (1, 2, 3, 4)] == ["x", "y", "z", None]
    assert [rows[n]["fresh"] for n in (1, 2, 3, 4)] == [None, 2.0, None, 4.0]


def test_daily_onto_hourly(series, values):
    hourly = series([1000.0] * 72)
    daily = series([True, False, True], "snow", "P1D", kind="boolean")
    joined = align.daily_onto_hourly(hourly.df, hourly.spec, daily.df, daily.spec, "snow")
    assert values(joined, "snow") == [True] * 24 + [False] * 24 + [True] * 24
    for wrong in ((daily, daily), (hourly, hourly)):
        with pytest.raises(ValueError):
            align.daily_onto_hourly(wrong[0].df, wrong[0].spec, wrong[1].df, wrong[1].spec, "snow")


# --- Intervals ---------------------------------------------------------------------------------------------------


def test_join_intervals(spark, series, values):
    frame = series({"A": [0] * 8, "B": [0] * 2})
    held = intervals(
        spark, ("A", at(1), at(3), 1.0), ("A", at(5), None, 2.0), ("B", dt.datetime(1700, 1, 1), at(1), 9.0)
    )
    joined = spans.join_intervals(frame.df, frame.spec, held, "height")
    assert values(joined, "height") == [None, 1, 1, None, None, 2, 2, 2] + [9, None]


def test_unknown_start_is_open(spark, series, values):
    frame = series([0] * 3)
    held = intervals(spark, ("A", None, at(1), 1.0), ("A", at(1), None, 2.0))
    assert values(spans.join_intervals(frame.df, frame.spec, held, "height"), "height") == [1, 2, 2]


def test_interval_open_at_both_ends(spark, series, values):
    frame = series({"A": [0] * 2, "B": [0]})
    held = intervals(spark, ("A", None, None, 4.0))
    assert values(spans.join_intervals(frame.df, frame.spec, held, "height"), "height") == [4, 4, None]


def test_far_times_find_open_intervals(spark, values):
    df = spark.createDataFrame([("A", dt.datetime(2500, 1, 1)), ("A", dt.datetime(1500, 1, 1))], "site string, time timestamp_ntz")
    held = intervals(spark, ("A", dt.datetime(2200, 1, 1), None, 2.0), ("A", None, dt.datetime(1600, 1, 1), 1.0))
    assert values(spans.join_intervals(df, HOURLY, held, "height"), "height") == [1, 2]


@pytest.mark.parametrize(
    ("rows", "reason"),
    [
        ([("A", at(3), at(1), 1.0)], "end not after start"),
        ([("A", at(1), at(1), 1.0)], "end not after start"),
        ([("A", at(1), at(4), 1.0), ("A", at(3), at(5), 1.0)], "overlap"),
        ([("A", at(1), at(4), 1.0), ("A", at(1), at(5), 1.0)], "overlap"),
        ([("A", at(1), None, 1.0), ("A", at(3), None, 1.0)], "more than one open end"),
        ([("A", at(1), None, 1.0), ("A", at(3), at(5), 1.0)], "open end is not last"),
    ],
)
def test_invalid_intervals(spark, series, rows, reason):
    frame = series([0])
    with pytest.raises(ValueError, match=reason):
        spans.join_intervals(frame.df, frame.spec, intervals(spark, *rows), "height")


def test_intervals_of_other_series_do_not_matter(spark, series):
    frame = series([0])
    held = intervals(spark, ("A", at(1), None, 1.0), ("B", at(0), None, 1.0), ("A", at(0), at(1), 1.0))
    spans.join_intervals(frame.df, frame.spec, held, "height")


def test_intervals_against_every_pair(spark, values):
    """Random rows and intervals, compared with looking at all intervals for each row."""
    chance = random.Random(11)
    base = dt.datetime(1998, 6, 1)
    held = []
    for site in "ABC":
        cursor = base
        for n in range(20):
            start = cursor + dt.timedelta(days=chance.randint(0, 40))
            cursor = start + dt.timedelta(days=chance.randint(1, 300))
            held.append((site, start, None if n == 19 else cursor, float(n)))
    rows = sorted({(chance.choice("ABCD"), base + dt.timedelta(hours=chance.randint(-500, 90_000))) for _ in range(300)})
    df = spark.createDataFrame(rows, "site string, time timestamp_ntz")
    joined = spans.join_intervals(df, HOURLY, intervals(spark, *held), "height")
    expected = [
        next((v for s, a, b, v in held if s == site and a <= t and (b is None or t < b)), None) for site, t in rows
    ]
    assert values(joined, "height") == expected


def test_periods_never_multiply_rows(spark, values):
    chance = random.Random(5)
    base = dt.datetime(2001, 11, 1)
    periods = [
        (site, base + dt.timedelta(hours=a), None if chance.random() < 0.05 else base + dt.timedelta(hours=a + chance.randint(-2, 300)))
        for site in "AB"
        for a in (chance.randint(0, 4000) for _ in range(25))
    ]
    periods += periods[:10]
    rows = sorted({(chance.choice("ABC"), base + dt.timedelta(hours=chance.randint(-100, 4500))) for _ in range(400)})
    df = spark.createDataFrame(rows, "site string, time timestamp_ntz")
    listed = spark.createDataFrame(periods, "site string, start timestamp_ntz, end timestamp_ntz")
    marked = spans.mark_in_periods(df, HOURLY, listed, "bad")
    expected = [any(s == site and a <= t and (b is None or t <= b) for s, a, b in periods) for site, t in rows]
    assert values(marked, "bad") == expected


def test_lengths_of_all_kinds_against_every_pair(spark, values):
    """Minutes to centuries, open ends and dates that stand for never, in one table."""
    chance = random.Random(21)
    held, rows = [], []
    for site in "ABCD":
        cursor = dt.datetime(1, 1, 1) if site == "B" else dt.datetime(1850, 1, 1)
        for n in range(25):
            minutes = chance.choice([1, 30, 1440, 50_000, 5_000_000, 60_000_000])
            start, cursor = cursor, min(cursor + dt.timedelta(minutes=minutes), dt.datetime(9000, 1, 1))
            if start < cursor:
                held.append([site, start, cursor, float(n)])
                rows += [(site, start), (site, cursor), (site, start + (cursor - start) / 2)]
                cursor += dt.timedelta(minutes=chance.choice([0, 0, 7]))
        held[-1][2] = {"A": None, "B": dt.datetime(9999, 12, 31, 23, 59, 59), "C": None}.get(site, held[-1][2])
        rows.append((site, dt.datetime(9500, 1, 1)))
    rows = sorted({(site, time.replace(microsecond=0)) for site, time in rows} | {("E", at(1))})
    df = spark.createDataFrame(rows, "site string, time timestamp_ntz")
    joined = spans.join_intervals(df, HOURLY, intervals(spark, *held), "height")
    expected = [next((v for s, a, b, v in held if s == site and a <= t and (b is None or t < b)), None) for site, t in rows]
    assert values(joined, "height") == expected and joined.columns == ["site", "time", "height"]
    periods = [(s, None if chance.random() < 0.1 else a, b) for s, a, b, _ in held for _ in range(2)]
    listed = spark.createDataFrame(periods[::3], "site string, start timestamp_ntz, end timestamp_ntz")
    marked = [any(s == site and (a is None or a <= t) and (b is None or t <= b) for s, a, b in periods[::3]) for site, t in rows]
    assert values(spans.mark_in_periods(df, HOURLY, listed, "bad"), "bad") == marked
    none = listed.where("false")
    assert set(values(spans.mark_in_periods(df, HOURLY, none, "bad"), "bad")) == {False}


def test_cells_follow_the_lengths_and_spread_a_series(spark):
    """Few copies of all intervals together, and many cells of the one interval that holds most rows."""
    day = dt.timedelta(days=1)
    start = dt.datetime(2000, 1, 1)
    for rows in (
        [("A", start, start + 3650 * day, 1.0)],
        [("A", start, start + 3650 * day, 1.0)] + [("B", start + k * day, start + (k + 1) * day, 1.0) for k in range(2000)],
        [("B", start + k * day / 24, start + (k + 1) * day / 24, 1.0) for k in range(500)],
    ):
        held = intervals(spark, *rows)
        exponent, far = spans._survey(held)
        cells = spans._near_place(held, exponent).groupBy("site").count().collect()
        assert not far and sum(row["count"] for row in cells) <= (spans.COPIES + 2) * len(rows)
        if rows[0][0] == "A":
            assert next(row["count"] for row in cells if row["site"] == "A") >= 9
    assert spans._survey(intervals(spark, ("A", None, None, 1.0), ("A", start, dt.datetime(9999, 1, 1), 1.0))) == (None, True)


def test_interval_joins_take_few_exchanges(spark):
    """With nothing broadcast: the rows once for each kind of interval, and the intervals."""
    held = intervals(spark, ("A", at(1), at(3), 1.0), ("A", at(5), None, 2.0))
    df = spark.createDataFrame([("A", at(k)) for k in range(9)], "site string, time timestamp_ntz")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for made in (
            spans.join_intervals(df, HOURLY, held, "height", check=False),
            spans.mark_in_periods(df, HOURLY, held.drop("height"), "bad"),
        ):
            plan = made._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange hashpartitioning") <= 6
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_deployments(spark, series):
    rows = [("A", "A-anem-1", at(0), at(2), 2.0), ("A", "A-rain-1", at(0), None, 9.0), ("A", "A-anem-2", at(2), None, 3.0)]
    deployments = spark.createDataFrame(
        rows, "site string, deployment_id string, start timestamp_ntz, end timestamp_ntz, height double"
    )
    found = align.deployment_intervals(deployments, "anem", "height", ["site"])
    assert sorted(r["height"] for r in found.collect()) == [2, 3]
    with pytest.raises(ValueError):
        align.deployment_intervals(deployments, "buoy", "height", ["site"])


# --- Scans over chunks -------------------------------------------------------------------------------------------


def test_number_rows_over_irregular_times(spark):
    chance = random.Random(2)
    rows = [(site, dt.datetime(2000, 1, 1) + dt.timedelta(hours=h)) for site in "AB" for h in chance.sample(range(200_000), 300)]
    df = with_slot(spark.createDataFrame(rows, "site string, time timestamp_ntz"), HOURLY)
    for newest_first in (False, True):
        got = {(r["site"], r["time"]): (r["_row"], r["_rows"]) for r in number_rows(df, HOURLY, newest_first).collect()}
        for site in "AB":
            ordered = sorted((t for s, t in rows if s == site), reverse=newest_first)
            assert [got[site, t] for t in ordered] == [(n, 300) for n in range(300)]


@pytest.mark.parametrize("chunk", [1, 4, 1000])
def test_running_max_since(series, values, chunk):
    chance = random.Random(chunk)
    numbers = {s: [chance.choice([None, float(chance.randint(0, 99))]) for _ in range(40)] for s in "AB"}
    frame = series(numbers)
    # Low numbers restart.
    rows = running_max_since(
        with_slot(frame.df, frame.spec), frame.spec, F.coalesce(F.col("value") < 30, F.lit(False)), F.col("value"), chunk
    )
    expected = []
    for site in "AB":
        best = None
        for v in numbers[site]:
            if v is not None and v < 30:
                best = v
            elif best is not None and v is not None:
                best = max(best, v)
            expected.append(best)
    assert values(rows, "_running_max") == expected


# --- Tables for a flux run ---------------------------------------------------------------------------------------


def test_biomet_table_wants_complete_rows(series):
    frames = [series([1.234, 2.0, 3.0], "RH").pair(), series([5.0, None, 6.0], "AirTemp_C").pair(), series([1], "x").pair()]
    table = ancillary.biomet_table(frames)
    assert table.columns == ["site", "time", "AirTemp_C", "RH"]
    assert sorted((r["AirTemp_C"], r["RH"]) for r in table.collect()) == [(5.0, 1.23), (6.0, 3.0)]
    with pytest.raises(ValueError):
        ancillary.biomet_table([series([1], "x").pair()])


def test_instrument_table_keeps_partial_rows(series):
    frames = [series([1, None, None], "height_canopy").pair(), series([None, 7, None], "sonic_azimuth").pair()]
    table = ancillary.instrument_table(frames)
    assert table.columns == ["site", "time", "sonic_azimuth", "height_canopy"]
    assert table.count() == 2
    assert ancillary.instrument_table([series([1], "x").pair()]) is None
