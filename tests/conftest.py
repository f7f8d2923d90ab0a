import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sluice.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, partitions=4, app="sluice-tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def series(spark):
    """series([("2024-01-01 00:15", 1.0), ...]) -> frame (station, time, value)."""

    def make(rows, station="a"):
        data = [(station, dt.datetime.fromisoformat(t) if isinstance(t, str) else t, None if v is None else float(v)) for t, v in rows]
        return spark.createDataFrame(data, "station string, time timestamp_ntz, value double")

    return make


@pytest.fixture
def slotted(spark):
    """slotted([1, None, 3], step=900) -> gridded frame (station, time, value, slot)."""

    def make(values, step=900, station="a", start="2024-01-01 00:00"):
        t0 = dt.datetime.fromisoformat(start)
        data = [(station, t0 + dt.timedelta(seconds=step * i), None if v is None else float(v), i) for i, v in enumerate(values)]
        return spark.createDataFrame(data, "station string, time timestamp_ntz, value double, slot bigint")

    return make


def column(df, name="value", order="time"):
    return [r[name] for r in df.orderBy(order).collect()]
