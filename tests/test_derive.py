import datetime as dt
import math

import pytest

from tidemark.functions.flagbits import CORE_FLAGS
from tidemark.operators import derive
from tidemark.operators.flagging import FlagColumns
from tidemark.plans import runner
from tidemark.plans.methods import Frame, Settings, get_method, method, method_names
from tidemark.spec import SeriesSpec
from pyspark.sql import functions as F

TARGET = SeriesSpec.of("PT1H", value="out")


def run(name, inputs, **params):
    return get_method("derivation", name)(Settings(name, params, inputs), TARGET)


def test_inputs_are_joined_on_time(series, values):
    late = dt.datetime(2025, 1, 1, 1)
    inputs = {"rn": series([10, 20, 30], "a"), "g": series([1, 2, 3], "a", start=late), "h": series([0, 0, 0], "c")}
    assert values(run("calc_flux_le_l1", inputs), "out") == [None, 19, 28, None]


def test_no_inputs_is_an_error():
    with pytest.raises(ValueError):
        run("calc_mean_g", {})


def test_simple_formulas(series, values):
    one = series([100.0], "x")

    def value(name, inputs, **params):
        return values(run(name, {k: series([v], "x") for k, v in inputs.items()}, **params), "out")[0]

    assert value("calculate_rn", {"swin": 500, "swout": 100, "lwin": 300, "lwout": 350}) == 350
    assert value("calc_mean_g", {"g1": 4, "g2": 6}) == 5
    assert value("calc_flux_mean_shf", {"g1": 4, "g2": None}) is None
    assert value("distance_to_level", {"dist_to_water": 1.25}, sensor_height=3) == 1.75
    assert value("correct_counts", {"cts_mod": 1000, "cosmosfactor_inten": 1.1, "cosmosfactor_pa": 0.9,
                                    "cosmosfactor_q": 1.0}) == pytest.approx(990)
    assert value("calc_factor_q", {"q": 10}, ref_q0=5) == pytest.approx(1.027)
    assert value("calc_factor_PA", {"pa": 1013.25}, l=130) == pytest.approx(1)
    assert value("calc_factor_inten", {"crns_count": 200}, ref_c0=200, gamma=1) == pytest.approx(1)
    assert value("calculate_mslp", {"pa": 1000, "ta": 10}, altitude=0) == pytest.approx(1000)
    assert value("latent_heat_to_et", {"le": 2.45e6 / 1800, "ta": 21.6}) == pytest.approx(1.0, abs=1e-3)
    # Allen et al. 1998: 1.2274 kPa at 10 degrees; saturated air holds about 9.4 g per cubic metre.
    assert value("calculate_q", {"ta": 10, "rh": 100}) == pytest.approx(9.39, abs=0.02)
    assert value("calc_albedo", {"swin": 100, "swout": 20, "solar_zenith": 1.0}) == pytest.approx(0.2)
    assert value("calc_albedo", {"swin": 100, "swout": 20, "solar_zenith": 1.618}) is None
    assert value("calculate_crns_swe", {"cts_smo": 1500, "cts_est": 1500}, n0_mod=2700) == pytest.approx(0)
    assert value("calculate_snowfox_swe", {"cts_smo": 900, "cts_est": 900}) == pytest.approx(0)
    assert value("calculate_smi", {"cosmos_vwc": 20}, vwc_wilting_point=10, vwc_field_capacity=30,
                 vwc_saturation=50) == pytest.approx(0.5)
    assert one.spec.value == "x"


def test_penman_monteith_by_hand(series, values):
    inputs = {k: series([v], k) for k, v in dict(rn=400, g=40, ta=20, rh=50, ws=2, pa=1000).items()}
    got = values(run("calculate_pe", inputs, wind_height=2.0), "out")[0]
    es = 0.6108 * math.exp(17.27 * 20 / 257.3)
    slope, gamma = 4098 * es / 257.3**2, 0.0665
    wind = 2 * 4.87 / math.log(67.8 * 2 - 5.42)
    expected = (0.408 * slope * 360 * 0.0018 + gamma * 18.5 / 293 * wind * es * 0.5) / (slope + gamma * (1 + 0.34 * wind))
    assert got == pytest.approx(expected)


def test_water_content_and_snow_counts(series, values):
    site = dict(n0_mod=2710.16689, ref_bulkdensity=1.06, ref_latticewater=0.025, ref_soc=0.032, n_min=1204.5, n_max=2281.3)
    measured = series([1000, 1300, 1500, 1800], "m")
    estimated = series([None, 1500, None, 2000], "e")
    with_snow = values(run("calculate_vwc_with_snow", {"cts_mod_corr": measured, "cts_est": estimated}, **site), "out")
    plain = values(run("calculate_vwc", {"cts_mod_corr": series([1000, 1500, 1500, 2000], "m")}, **site), "out")
    assert with_snow == plain and plain[0] is None and plain[1] > plain[3] > 0


def test_largest_gauge(series, values):
    inputs = {"precip_tipping_a": series([1, None, 3, None], "a"), "precip_tipping_b": series([2, 5, None, None], "b")}
    assert values(run("get_precip_tipping", inputs), "out") == [2, 5, 3, None]


def test_attribute_that_changes_in_time(spark, series, values):
    rows = [("A", dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 1, 2), 2.0), ("A", dt.datetime(2025, 1, 1, 2), None, 3.0)]
    held = spark.createDataFrame(rows, "site string, start timestamp_ntz, end timestamp_ntz, height double")
    attribute = Frame(held, TARGET.with_(value="height"))
    result = run("distance_to_level", {"dist_to_water": series([1, 1, 1], "d")}, sensor_height=attribute)
    assert values(result, "out") == [1, 1, 2]


def test_solar_zenith_covers_the_window(spark, series, values):
    places = spark.createDataFrame([("A", 54.110665), ("B", 0.0)], "site string, lat double")
    params = {"sites": Frame(places, TARGET.with_(value="lat")), "load_start": "2026-01-01", "load_end": "2026-01-02"}
    with_input = {"swin": series([0, 0, 0])}
    plain = get_method("derivation", "solar_zenith")(Settings("solar_zenith", params), TARGET)
    times = values(plain.where("site = 'A'"), "time")
    assert times == [dt.datetime(2026, 1, 1) + dt.timedelta(hours=n) for n in range(25)]
    angles = values(plain.where("site = 'A'"), "out")
    assert min(angles) == angles[12] and angles[0] > math.pi / 2 and None not in angles
    ignored = get_method("derivation", "solar_zenith")(Settings("solar_zenith", params, with_input), TARGET)
    assert values(ignored, "out") == values(plain, "out")


@pytest.mark.parametrize("chunk", [5, 1000])
def test_snow_estimated_counts(series, values, chunk):
    counts = [100.0 + n % 24 for n in range(24 * 4)]
    counts[24 + 5] = 500.0
    counts[23] = None
    inputs = {"cts_smo": series(counts, "c"), "snow": series([False, True, True, False], "s", "P1D", kind="boolean")}
    result = values(derive.snow_estimated_counts(Settings("x", {}, inputs), TARGET, chunk), "out")
    assert result[:24] == [None] * 24 and result[72:] == [None] * 24
    # The last count before was 122; it is passed by 123 once and by the 500.
    assert result[24:29] == [122] * 5 and result[29:72] == [500] * 43


def test_step_flags_missing(series, values):
    inputs = {"g1": series([1, None], "a"), "g2": series([3, 4], "b")}
    flags = FlagColumns({"core": "core"}, {"core": CORE_FLAGS})
    result = runner.derive_to(Settings("calc_mean_g", {"round": 0}, inputs), TARGET, flags)
    assert values(result.df, "out") == [2, None] and values(result.df, "core") == [0, 4]


def test_users_can_add_methods(series, values):
    @method("derivation", "twice")
    def twice(settings, target):
        return derive.result(derive.gather(settings, target), target, F.col("x") * 2)

    assert values(run("twice", {"x": series([1, 2])}), "out") == [2, 4]
    assert "twice" in method_names("derivation")
    with pytest.raises(ValueError):
        method("dance", "x")
