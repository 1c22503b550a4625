import pytest

from tidemark.functions.times import grid_times_per_day
from tidemark.spec import Period, SeriesSpec, anchor_from_code, check_same_cadence


def test_parse_periods():
    assert Period.parse("PT30M").seconds == 1800
    assert Period.parse("P1D").micros == 86_400_000_000
    assert Period.parse("P1Y").months == 12
    assert Period.parse("P1W") == Period.parse("P7D")
    assert Period.parse("PT0.5S").micros == 500_000


@pytest.mark.parametrize("text", ["", "P", "PT", "30M", "P1M1D", "PT-1H"])
def test_bad_periods(text):
    with pytest.raises(ValueError):
        Period.parse(text)


def test_count():
    assert Period.parse("PT30M").count(Period.parse("P1D")) == 48
    assert Period.parse("PT1H").count(Period.parse("PT90M")) is None
    assert Period.parse("P1D").count(Period.parse("P1M")) is None
    assert Period.parse("P1M").count(Period.parse("P1Y")) == 12
    with pytest.raises(ValueError):
        Period.parse("P1M").seconds


def test_anchors():
    assert [anchor_from_code(code) for code in ("proc", "prec", "inst")] == ["start", "end", "point"]
    with pytest.raises(ValueError):
        anchor_from_code("other")
    with pytest.raises(ValueError):
        SeriesSpec.of("PT1H", anchor="middle")


def test_cadence_must_agree_but_anchor_need_not():
    hourly = SeriesSpec.of("PT1H")
    check_same_cadence(hourly, hourly.with_(anchor="end"))
    for other in (SeriesSpec.of("P1D"), hourly.with_(time="t"), hourly.with_(resolution=Period.parse("PT1M"))):
        with pytest.raises(ValueError):
            check_same_cadence(hourly, other)


def test_grid_times_in_window():
    assert grid_times_per_day(Period.parse("PT1H"), "10:30:00", "14:00:00") == 4
    assert grid_times_per_day(Period.parse("PT30M"), "00:00:00", "23:59:59") == 48
