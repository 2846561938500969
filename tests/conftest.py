import datetime as dt

import pytest

from slotstream.session import build_session


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="6g",
        spark__sql__sources__parallelPartitionDiscovery__parallelism="8",
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Rows of a DataFrame as sorted tuples."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple(str(v) for v in r))

    return collect


@pytest.fixture
def ts():
    return lambda text: dt.datetime.fromisoformat(text)
