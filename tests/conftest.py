import datetime as dt

import pytest
from pyspark.sql import SparkSession

from tickforge.schemas import RECOS

TRADE_SCHEMA = (
    "symbol string, event_date date, price double, size double, exchange string, "
    "conditions array<string>, tape string, id long, timestamp_parsed timestamp"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def utc(text):
    return dt.datetime.fromisoformat(text).replace(tzinfo=dt.timezone.utc)


@pytest.fixture(scope="session")
def make_trades(spark):
    """Trades from dicts; whatever is left out gets a plain value."""

    def build(*rows):
        full = []
        for number, row in enumerate(rows, 1):
            ts = utc(row.get("ts", f"2025-05-02T13:30:{number % 60:02d}"))
            full.append(
                (
                    row.get("symbol", "AAPL"),
                    ts.date(),
                    float(row.get("price", 10.0)),
                    float(row.get("size", 1.0)),
                    row.get("exchange", "V"),
                    row.get("conditions", ["@"]),
                    row.get("tape", "C"),
                    row.get("id", number),
                    ts,
                )
            )
        return spark.createDataFrame(full, TRADE_SCHEMA)

    return build


@pytest.fixture(scope="session")
def make_recos(spark):
    """Recommendations from (symbol, date text, buy); the other counts are 1 to 4."""

    def build(*rows):
        full = [(s, dt.date.fromisoformat(d), b, 1, 2, 3, 4) for s, d, b in rows]
        return spark.createDataFrame(full, RECOS)

    return build
