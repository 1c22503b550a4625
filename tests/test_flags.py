import datetime as dt

import pytest

from tidemark.functions.flagbits import appeared_or_vanished, changed, clear_bit, has_bit, set_bit
from tidemark.operators import flagging
from tidemark.operators.flagging import FlagColumns
from tidemark.plans import runner
from tidemark.plans.methods import Settings
from pyspark.sql import functions as F

NAN = float("nan")


@pytest.fixture(scope="module")
def rows(spark):
    def make(columns, *data):
        named = [("A", dt.datetime(2025, 1, 1, n), *row) for n, row in enumerate(data)]
        return spark.createDataFrame(named, f"site string, time timestamp_ntz, {columns}")

    return make


def test_columns_are_created_or_kept(rows, values):
    df = flagging.ensure_flag_columns(rows("a int", (5,), (6,)), ["a", "b"])
    assert values(df, "a") == [5, 6] and values(df, "b") == [0, 0]


def test_initial_core(rows, values):
    df = flagging.set_initial_core(rows("value double, core int", (1.0, 0), (None, 0), (NAN, 0)), "value", "core")
    assert values(df, "core") == [32, 36, 36]


def test_core_after_correction(rows, values):
    data = rows("value double, corr int, core int", (1.0, 0, 32), (2.0, 1, 32), (None, 2, 36))
    assert values(flagging.set_core_after_correction(data, "value", "core", "corr"), "core") == [32, 33, 100]


def test_core_after_qc(rows, values):
    data = rows("qc int, core int", (0, 32), (3, 36), (None, 36), (0, 4))
    assert values(flagging.set_core_after_qc(data, "core", "qc"), "core") == [0, 4, 36, 4]


def test_core_after_infill_and_derivation(rows, values):
    data = rows("fill int, core int", (0, 4), (2, 4))
    assert values(flagging.set_core_after_infill(data, "core", "fill"), "core") == [4, 6]
    data = rows("value double, core int", (1.0, 0), (None, 0), (NAN, 0))
    assert values(flagging.set_core_after_derivation(data, "value", "core"), "core") == [0, 4, 4]


def test_bits(rows, values):
    df = rows("f int, m boolean", (1, True), (2, False), (3, None), (4, True)).select(
        "site", "time", set_bit("f", 4, F.col("m")).alias("s"), clear_bit("f", 1, F.col("m")).alias("c"),
        has_bit("f", 2).alias("h"),
    )
    assert values(df, "s") == [5, 2, 3, 4]
    assert values(df, "c") == [0, 2, 3, 4]
    assert values(df, "h") == [False, True, True, False]


def test_masks(rows, values):
    data = rows("b double, a double", (1.0, 1.0), (1.0, 2.0), (1.0, None), (None, 1.0), (None, NAN), (NAN, None), (NAN, 2.0))
    assert values(data.withColumn("m", changed(data, "b", "a")), "m") == [False, True, True, True, False, False, True]
    assert values(data.withColumn("m", appeared_or_vanished(data, "b", "a")), "m") == [
        False, False, True, True, False, False, True,
    ]


def test_roles(spark):
    with pytest.raises(ValueError):
        FlagColumns({"other": "x"})
    good = spark.createDataFrame([("d", "a", "core"), ("d", "b", "infill")], "dataset string, column_name string, role string")
    flagging.check_flag_roles(good)
    for row in (("d", "c", "core"), ("d", "c", "colour")):
        with pytest.raises(ValueError):
            flagging.check_flag_roles(good.union(spark.createDataFrame([row], good.schema)))


def test_correction_step(series, values):
    flags = FlagColumns({"core": "core", "correction": "corr"}, {"correction": {"clip": 1, "scalar": 2}})
    frame = series([1, 20, None, 0])
    loaded = runner.load(frame, frame.spec, flags)
    result = runner.correct(loaded, [Settings("clip", {"max": 10}), Settings("scalar", {"correction_factor": 3})])
    assert values(result.df) == [3, 30, None, 0]
    assert values(result.df, "corr") == [2, 3, 0, 0]
    assert values(result.df, "core") == [33, 33, 36, 32]


def test_unsuccessful_correction(series, values):
    flags = FlagColumns({"core": "core", "correction": "corr"}, {"correction": {"pa_corr": 1}})
    frame, short = series([1000, 1000], "pa"), series([10], "ta")
    result = runner.correct(
        runner.load(frame, frame.spec, flags),
        [Settings("pa_corr", {"correction_factor": 1, "altitude": 10}, {"ta": short})],
    )
    assert values(result.df, "corr") == [1, 1]
    assert values(result.df, "core") == [33, 96]


def test_rounding_comes_after_the_flags(series, values):
    flags = FlagColumns({"correction": "corr"}, {"correction": {"add": 1}})
    frame = series([1.04, 2.06])
    result = runner.correct(
        runner.load(frame, frame.spec, flags), [Settings("add", {"correction_factor": 0.0, "round": 1})]
    )
    assert values(result.df) == [1.0, 2.1] and values(result.df, "corr") == [0, 0]
    half = runner.correct(runner.load(series([0.5, 1.5, 2.5]), frame.spec), [Settings("add", {"correction_factor": 0, "round": 0})])
    assert values(half.df) == [0, 2, 2]
