import datetime as dt
import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent))

from tickloom.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def trades_of(spark):
    """Build trades from (symbol, price, volume, seconds after 2024-01-01 09:00) rows."""

    def build(rows):
        start = dt.datetime(2024, 1, 1, 9, tzinfo=dt.timezone.utc)
        full = [
            (s, p, v, start + dt.timedelta(seconds=t), "0", start + dt.timedelta(seconds=t + 60), i)
            for i, (s, p, v, t) in enumerate(rows)
        ]
        return spark.createDataFrame(
            full,
            "symbol string, price double, volume bigint, event_time timestamp, exchange string, "
            "loaded_at timestamp, seq bigint",
        )

    return build
