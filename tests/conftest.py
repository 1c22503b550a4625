import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark.plans.methods import Frame  # noqa: E402
from tidemark.session import local_session  # noqa: E402
from tidemark.spec import SeriesSpec  # noqa: E402

START = dt.datetime(2025, 1, 1)


@pytest.fixture(scope="session")
def spark():
    return local_session("*", 4, "6g")


@pytest.fixture(scope="session")
def series(spark):
    """Make a Frame from a list of values, one per hour from the start of 2025, for one or more sites."""

    def make(values, value="value", period="PT1H", start=START, kind="double", **fields):
        spec = SeriesSpec.of(period, value=value, **fields)
        step = dt.timedelta(microseconds=spec.period.micros)
        by_site = values if isinstance(values, dict) else {"A": values}
        rows = [
            (site, start + step * n, number if kind != "double" or number is None else float(number))
            for site, numbers in by_site.items()
            for n, number in enumerate(numbers)
        ]
        return Frame(spark.createDataFrame(rows, f"site string, time timestamp_ntz, {value} {kind}"), spec)

    return make


@pytest.fixture(scope="session")
def values():
    """The values of a column, in order of site and time."""

    def take(df, column="value"):
        return [row[column] for row in df.orderBy("site", "time").select(column).collect()]

    return take
