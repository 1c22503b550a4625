import datetime as dt
import random

import pytest

from tidemark.operators import infill
from tidemark.operators.flagging import FlagColumns
from tidemark.plans import runner
from tidemark.plans.methods import Settings

CHANCE = random.Random(31)
OTHER = [round(CHANCE.uniform(2, 40), 2) for _ in range(12)]
# Gaps of one, two and three rows, and one at either end.
OWN = [None if k in (0, 2, 4, 5, 7, 8, 9, 11) else round(CHANCE.uniform(1, 9), 2) for k in range(12)]
DATED = range(2, 6)
DATES = {"start": dt.datetime(2025, 1, 1, DATED[0]), "end": dt.datetime(2025, 1, 1, DATED[-1], 59)}


def in_dates(filled, own=OWN):
    return [value if k in DATED else old for k, (old, value) in enumerate(zip(own, filled))]


def plain_alternative(own, other, factor=1.0, max_gap=None):
    known = [k for k, v in enumerate(own) if v is not None]

    def fits(k):
        if max_gap is None:
            return True
        before, after = [n for n in known if n < k], [n for n in known if n > k]
        return bool(before and after) and after[0] - before[-1] - 1 <= max_gap

    return [other[k] * factor if v is None and other[k] is not None and fits(k) else v for k, v in enumerate(own)]


def same(got, expected):
    assert [v is None for v in got] == [v is None for v in expected]
    assert [v for v in got if v is not None] == pytest.approx([v for v in expected if v is not None])


@pytest.mark.parametrize("max_gap", [None, 1, 2])
def test_linear(series, values, max_gap):
    params = {} if max_gap is None else {"max_gap_size": max_gap}
    expected = plain_linear(OWN, max_gap)
    assert expected[0] is None and expected[-1] is None  # the ends are left alone
    same(values(infill.linear(series(OWN), Settings("linear_interp", params))), expected)
    same(values(infill.linear(series(OWN), Settings("linear_interp", params, **DATES))), in_dates(expected))


def test_linear_treats_nan_as_missing(series, values):
    holes = [float("nan") if v is None else v for v in OWN[1:-1]]
    same(values(infill.linear(series(holes), Settings("linear_interp"))), plain_linear(OWN[1:-1], None))


def plain_linear(numbers, max_gap):
    out = list(numbers)
    known = [n for n, v in enumerate(numbers) if v is not None]
    for low, high in zip(known, known[1:]):
        if max_gap is None or high - low - 1 <= max_gap:
            for n in range(low + 1, high):
                out[n] = numbers[low] + (numbers[high] - numbers[low]) * (n - low) / (high - low)
    return out


@pytest.mark.parametrize("max_gap", [None, 1, 3, 50])
@pytest.mark.parametrize("chunk", [2, 7, 1000])
def test_linear_across_chunks(series, values, max_gap, chunk):
    chance = random.Random(7)
    sites = {
        site: [chance.choice([None, None, float(chance.randint(0, 99))]) for _ in range(60)] for site in "ABC"
    }
    sites["D"] = [None] * 5
    settings = Settings("linear_interp", {} if max_gap is None else {"max_gap_size": max_gap})
    result = values(infill.linear(series(sites), settings, chunk))
    expected = [v for site in "ABCD" for v in plain_linear(sites[site], max_gap)]
    same(result, expected)


@pytest.mark.parametrize("name", ["alt", "value"])
@pytest.mark.parametrize("max_gap", [None, 1, 2])
def test_alternative(series, values, name, max_gap):
    inputs = {"alt_data_source": series(OTHER, name)}
    params = {"correction_factor": 0.75} | ({} if max_gap is None else {"max_gap_size": max_gap})
    expected = plain_alternative(OWN, OTHER, 0.75, max_gap)
    same(values(infill.alternative(series(OWN), Settings("alt_data", params, inputs))), expected)
    same(values(infill.alternative(series(OWN), Settings("alt_data", params, inputs, **DATES))), in_dates(expected))
    plain = Settings("alt_data", {}, {"alt_data_source": series(OTHER[:5], name)})
    same(values(infill.alternative(series(OWN), plain)), plain_alternative(OWN, OTHER[:5] + [None] * 7))


@pytest.mark.parametrize("most", [None, 2])
def test_dynamic(series, values, most):
    inputs = {"alt_data_source": series(OTHER, "alt")}
    extra = {} if most is None else {"max_threshold": most}
    for hours, least in ((1, 0), (3, 2)):
        params = {"window": f"PT{hours}H", "min_threshold": least} | extra
        expected = plain_dynamic(OWN, OTHER, hours, least, most)
        same(values(infill.alternative_scaled(series(OWN), Settings("alt_data_dynamic", params, inputs))), expected)
        dated = Settings("alt_data_dynamic", params, inputs, **DATES)
        same(values(infill.alternative_scaled(series(OWN), dated)), in_dates(expected))


def test_lists_of_pairs_are_made_for_gap_edges_alone(series):
    settings = Settings("alt_data_dynamic", {"window": "PT9H", "max_threshold": 2}, {"alt_data_source": series(OTHER, "alt")})
    plan = infill.alternative_scaled(series(OWN), settings)._jdf.queryExecution().optimizedPlan().toString()
    lists = [line for line in plan.splitlines() if "collect_list" in line]
    assert lists and all("Aggregate [" in line and "_slot" in line for line in lists)
    assert "specifiedwindowframe(RowFrame, -" not in plan.replace("-1, -1", "")


def test_dynamic_needs_a_window(series):
    settings = Settings("alt_data_dynamic", {}, {"alt_data_source": series(OTHER, "alt")})
    with pytest.raises(ValueError):
        infill.alternative_scaled(series(OWN), settings)


def plain_dynamic(own, other, window, least, most):
    out, n = list(own), len(own)
    known = [i for i, v in enumerate(own) if v is not None]
    for i in range(n):
        if own[i] is not None or other[i] is None:
            continue
        before = max((k for k in known if k < i), default=None)
        after = min((k for k in known if k > i), default=None)
        near = []
        for k in known:
            if other[k] is None:
                continue
            if before is not None and k <= before and before - k < window:
                near.append((before - k, k))
            elif after is not None and k >= after and k - after < window:
                near.append((k - after, k))
        near = sorted(near)[:most]
        if len(near) >= max(least, 1):
            out[i] = other[i] * sum(own[k] for _, k in near) / sum(other[k] for _, k in near)
    return out


@pytest.mark.parametrize("most", [None, 3])
@pytest.mark.parametrize("chunk", [9, 1000])
def test_dynamic_across_chunks(series, values, most, chunk):
    chance = random.Random(3)
    own = {s: [chance.choice([None, float(chance.randint(1, 99))]) for _ in range(50)] for s in "AB"}
    other = {s: [chance.choice([None, float(chance.randint(1, 99)), 5.0]) for _ in range(50)] for s in "AB"}
    params = {"window": "PT4H", "min_threshold": 2} | ({} if most is None else {"max_threshold": most})
    settings = Settings("alt_data_dynamic", params, {"alt_data_source": series(other, "alt")})
    result = values(infill.alternative_scaled(series(own), settings, chunk))
    expected = [v for s in "AB" for v in plain_dynamic(own[s], other[s], 4, 2, most)]
    same(result, expected)


def test_step_flags(series, values):
    flags = FlagColumns({"core": "core", "infill": "infill"}, {"infill": {"linear_interp": 1, "alt_data": 2}})
    own = [2.5, None, None, 4.0, 8.0, None, None]
    frame = series(own)
    loaded = runner.load(frame, frame.spec, flags)
    inputs = {"alt_data_source": series([6.5] * 6, "alt")}
    result = runner.fill(loaded, [Settings("linear_interp"), Settings("alt_data", {}, inputs)])
    same(values(result.df), plain_alternative(plain_linear(own, None), [6.5] * 6 + [None]))
    assert values(result.df, "infill") == [0, 1, 1, 0, 0, 2, 0]
    assert values(result.df, "core") == [32, 38, 38, 32, 32, 38, 36]
