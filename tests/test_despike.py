import datetime as dt
import random

import numpy as np
import pytest

from tidemark.operators import despike
from tidemark.spec import SeriesSpec

HALF_HOURLY = SeriesSpec.of("PT30M", value="H")
START = dt.datetime(2026, 1, 1)


def plain_despike(numbers, light, block, sensitivity):
    """The rule on one whole series, with arrays."""
    out = np.array([np.nan if v is None else v for v in numbers], dtype=float)
    radiation = np.array([np.nan if v is None else v for v in light], dtype=float)
    whole = len(out) // block * block
    tail, sun = out[len(out) - whole :], radiation[len(out) - whole :]
    if not whole:
        return out
    before = np.concatenate([tail[:1], tail[:-1]])
    after = np.concatenate([tail[1:], tail[-1:]])
    before[-1] = tail[-1]
    diff = (tail - before) - (after - tail)
    spiky = np.zeros(whole, dtype=bool)
    for first in range(0, whole, block):
        rows = np.arange(first, first + block)
        for part in (~(sun[rows] < 20), ~(sun[rows] >= 20)):
            some = diff[rows][part]
            some = some[~np.isnan(some)]
            if not len(some):
                continue
            middle = np.median(some)
            limit = sensitivity * np.median(np.abs(some - middle)) / 0.6745
            with np.errstate(invalid="ignore"):
                spiky[rows[part]] |= (diff[rows][part] < middle - limit) | (diff[rows][part] > middle + limit)
    tail[spiky] = np.nan
    return out


def random_series(chance, n):
    return [
        (None if chance.random() < 0.1 else chance.gauss(0, 1) * (30 if chance.random() < 0.08 else 1),
         None if chance.random() < 0.1 else chance.uniform(0, 60))
        for _ in range(n)
    ]


@pytest.mark.parametrize("iterations", [0, 1, 2])
def test_against_arrays(spark, iterations):
    """Several sites of different length, with missing times, values and radiation; blocks of one day."""
    chance = random.Random(iterations)
    rows, expected = [], {}
    for site, n in (("A", 250), ("B", 48), ("C", 47), ("D", 130)):
        times = sorted(chance.sample(range(n * 2), n))
        data = random_series(chance, n)
        rows += [(site, START + dt.timedelta(minutes=30 * t), h, sun) for t, (h, sun) in zip(times, data)]
        clean = [h for h, _ in data]
        for _ in range(iterations):
            clean = plain_despike([None if v is None or v != v else v for v in clean], [s for _, s in data], 48, 3.0)
        for t, v in zip(times, clean):
            expected[site, START + dt.timedelta(minutes=30 * t)] = None if v is None or v != v else v
    df = spark.createDataFrame(rows, "site string, time timestamp_ntz, H double, light double")
    result = despike.remove_spikes(df, HALF_HOURLY, ["H"], "light", 1, 3.0, iterations)
    got = {(r["site"], r["time"]): r["H"] for r in result.collect()}
    assert got == expected
    if iterations:
        assert sum(v is None for v in got.values()) > sum(h is None for _, _, h, _ in rows)


def frames(spark, heat, history_days=13, sites=("A",)):
    rows = [("A", START + dt.timedelta(minutes=30 * n), h, 0.1, 100.0) for n, h in enumerate(heat)]
    rows += [(s, t, h, u, x) for s in sites[1:] for _, t, h, u, x in rows]
    past = [("A", START - dt.timedelta(minutes=30 * n), 50.0 + n % 3, 0.1, 100.0) for n in range(1, history_days * 48 + 1)]
    schema = "site string, time timestamp_ntz, H double, Tau double, light double"
    return spark.createDataFrame(rows, schema), spark.createDataFrame(past, schema)


def test_new_columns_for_current_rows_only(spark, values):
    heat = [50.0 + n % 3 for n in range(48)]
    heat[20] = 10_000.0
    current, history = frames(spark, heat)
    result = despike.despike_current(
        current, history, HALF_HOURLY, ["H", "Tau"], "light", {"H": "H_despiked", "Tau": "Tau_L2"}
    )
    assert result.columns == ["site", "time", "H", "Tau", "light", "H_despiked", "Tau_L2", "H_L2"]
    assert values(result, "H") == heat
    cleaned = values(result, "H_despiked")
    assert len(cleaned) == 48 and cleaned[20] is None
    assert values(result, "Tau_L2") == [0.1] * 48


def test_heat_range(spark, values):
    heat = [50.0] * 48
    heat[10], heat[20] = 700.0, -250.0
    current, history = frames(spark, heat)
    result = despike.despike_current(current, history, HALF_HOURLY, ["H", "Tau"], "light", iterations=0)
    in_range = values(result, "H_L2")
    assert in_range[10] is None and in_range[20] is None
    assert sum(v is None for v in in_range) == 2


def test_sites_without_history_are_skipped(spark, values):
    current, history = frames(spark, [50.0] * 48, sites=("A", "B"))
    result = despike.despike_current(current, history, HALF_HOURLY, ["H"], "light", {"H": "H_despiked"})
    assert values(result, "H_despiked") == [50.0] * 48 + [None] * 48
    assert values(result, "H") == [50.0] * 96


def test_lookback_takes_the_days_before(spark):
    current, history = frames(spark, [50.0] * 48, history_days=20)
    result = despike.despike_with_lookback(
        current.unionByName(history), HALF_HOURLY, START, START, ["H", "Tau"], "light", output_names={"H": "h", "Tau": "t"}
    )
    assert result.count() == 48
