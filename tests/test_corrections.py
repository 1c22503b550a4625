import datetime as dt
import math
import random

import pytest

from tidemark.plans.methods import Settings, get_method

ONE_TO_SEVEN = [1, 2, 3, 4, 5, 6, 7]
DATES = {"start": dt.datetime(2025, 1, 1, 2), "end": dt.datetime(2025, 1, 1, 4, 59)}


def run(frame, name, inputs=None, dates=False, **params):
    return get_method("correction", name)(frame, Settings(name, params, inputs or {}, **(DATES if dates else {})))


@pytest.mark.parametrize(
    ("name", "factor", "everywhere", "dated"),
    [
        ("add", 2, [3, 4, 5, 6, 7, 8, 9], [1, 2, 5, 6, 7, 6, 7]),
        ("scalar", 2, [2, 4, 6, 8, 10, 12, 14], [1, 2, 6, 8, 10, 6, 7]),
        ("power", 2, [1, 4, 9, 16, 25, 36, 49], [1, 2, 9, 16, 25, 6, 7]),
    ],
)
def test_arithmetic(series, values, name, factor, everywhere, dated):
    frame = series(ONE_TO_SEVEN)
    assert values(run(frame, name, correction_factor=factor)) == everywhere
    assert values(run(frame, name, dates=True, correction_factor=factor)) == dated


def test_absolute(series, values):
    frame = series([-1, -2, -3, 4, -5, -6, None])
    assert values(run(frame, "absolute")) == [1, 2, 3, 4, 5, 6, None]
    assert values(run(frame, "absolute", dates=True)) == [-1, -2, 3, 4, 5, -6, None]


def test_clip(series, values):
    frame = series([-1, 0, 5, None, 12])
    assert values(run(frame, "clip", min=0)) == [0, 0, 5, None, 12]
    assert values(run(frame, "clip", max=10)) == [-1, 0, 5, None, 10]
    assert values(run(frame, "clip", min=0, max=10)) == [0, 0, 5, None, 10]
    with pytest.raises(ValueError):
        run(frame, "clip")
    nan = values(run(series([float("nan"), 99]), "clip", max=10))
    assert nan[0] != nan[0] and nan[1] == 10


def numbers(seed, low, high, count=7):
    chance = random.Random(seed)
    return [round(chance.uniform(low, high), 2) for _ in range(count)]


DOWN, RAW, AIR = numbers(1, 250, 420), numbers(2, -90, -20), numbers(3, -5, 30)
STEFAN_BOLTZMANN = 5.67e-8


def black_body(raw, celsius, factor):
    """Raw reading times a factor, and what a body of the sensor's temperature radiates."""
    return raw * factor + STEFAN_BOLTZMANN * (celsius + 273.15) ** 4


@pytest.mark.parametrize(("unit", "offset"), [("http://example.org/unit/degc", 0.0), ("unit/kel", 273.15)])
def test_longwave(series, values, unit, offset):
    inputs = {"lw_unc": series(RAW, "lw_unc"), "ta": series([t + offset for t in AIR], "ta", unit=unit)}
    result = run(series(DOWN, "lw"), "lw_corr", inputs, correction_factor=1.02)
    assert values(result, "lw") == pytest.approx([black_body(r, t, 1.02) for r, t in zip(RAW, AIR)], rel=1e-4)


def test_longwave_input_with_the_same_column_name(series, values):
    inputs = {"lw_unc": series(RAW, "reading"), "ta": series([t + 273.15 for t in AIR], "T", unit="unit/kel")}
    result = run(series(DOWN, "reading"), "lw_corr", inputs, dates=True, correction_factor=1.0)
    assert result.columns == ["site", "time", "reading"]
    inside = [black_body(r, t, 1.0) for r, t in zip(RAW, AIR)]
    assert values(result, "reading") == pytest.approx(DOWN[:2] + inside[2:5] + DOWN[5:], rel=1e-4)


def test_longwave_matches_by_time_and_rejects_other_units(series, values):
    inputs = {"lw_unc": series(RAW, "u"), "ta": series(AIR[:2], "ta", unit="degc")}
    result = values(run(series(DOWN[:3], "lw"), "lw_corr", inputs, correction_factor=1.02), "lw")
    assert result[:2] == pytest.approx([black_body(r, t, 1.02) for r, t in zip(RAW[:2], AIR)], rel=1e-4)
    assert result[2] is None
    inputs["ta"] = series(AIR, "ta", unit="unit/degf")
    with pytest.raises(ValueError):
        run(series(DOWN, "lw"), "lw_corr", inputs, correction_factor=1.0)


def test_pressure(series, values):
    """The offset applies at sea level; a lapse rate of 0.0065 K/m leads there and back."""
    readings, altitude, offset = numbers(4, 960, 1030), 210.0, 3.4

    def corrected(pressure, celsius):
        drop = altitude * 0.0065
        ratio = (1 - drop / (celsius + drop + 273.15)) ** 5.257
        return pressure + offset * ratio

    inputs = {"ta": series(AIR, "ta")}
    expected = [corrected(p, t) for p, t in zip(readings, AIR)]
    result = run(series(readings, "pa"), "pa_corr", inputs, correction_factor=offset, altitude=altitude)
    assert values(result, "pa") == pytest.approx(expected, abs=1e-2)
    dated = run(series(readings, "pa"), "pa_corr", inputs, dates=True, correction_factor=offset, altitude=altitude)
    assert values(dated, "pa") == pytest.approx(readings[:2] + expected[2:5] + readings[5:], abs=1e-2)


def test_wind_direction(series, values):
    """The direction turns with the two components: along each axis it is a quarter turn on."""
    ux, uy = numbers(5, -4, 4, 4), numbers(6, -4, 4, 4)
    first = values(run(series([10, 20, 30, 40], "wd"), "wd", {"ux": series(ux, "ux"), "uy": series(uy, "uy")}), "wd")
    turned = {"ux": series([-v for v in uy], "ux"), "uy": series(ux, "uy")}
    second = values(run(series([10, 20, 30, 40], "wd"), "wd", turned), "wd")
    assert all(0 <= wd <= 360 for wd in first)
    steps = {round((b - a) % 360, 6) for a, b in zip(first, second)}
    assert steps in ({90.0}, {270.0})
    late = dt.datetime(2025, 1, 1, 1)
    shifted = {"ux": series(ux[:3], "ux", start=late), "uy": series(uy[:3], "uy", start=late)}
    result = values(run(series([10, 20, 30], "wd"), "wd", shifted, dates=True), "wd")
    assert result[0] is None and result[1:] == pytest.approx(first[:2])


def test_albedo_on_slope(series, values):
    """Under an overcast sky only the angle between the sun and the slope counts."""
    albedo, zenith = [None, *numbers(8, 0.1, 0.3, 5), None], numbers(9, 0.4, 0.9)
    inputs = {"swin": series([1.0] * 7, "swin"), "solar_zenith": series(zenith, "z")}
    for slope in (0.0, 0.3):
        got = values(run(series(albedo, "albedo"), "albedo_south_slope_correction", inputs, theta_g=slope), "albedo")
        assert got[0] is None and got[-1] is None
        expected = [a / math.cos(z - slope) for a, z in zip(albedo[1:-1], zenith[1:-1])]
        assert got[1:-1] == pytest.approx(expected)


def test_missing_input_and_parameter_are_errors(series):
    with pytest.raises(ValueError):
        run(series([1]), "pa_corr", altitude=1, correction_factor=1)
    with pytest.raises(ValueError):
        run(series([1]), "add")
    with pytest.raises(KeyError):
        get_method("correction", "no_such_method")
