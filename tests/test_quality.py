import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickforge.functions import calendar
from tickforge.operators import quality
from tickforge.operators.documents import typed_documents
from tickforge.plans.completeness import require_complete
from tickforge.schemas import KEYS
from tickforge.sinks.files import write_table
from tickforge.sources.files import read_parquet_file


def test_completeness_counts_rows_and_files(spark, make_trades, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        make_trades({"symbol": "A"}, {"symbol": "A"}, {"symbol": "B"}).coalesce(1).write.mode(
            "append"
        ).partitionBy(*KEYS).parquet(path)
    scan = quality.with_source_file(read_parquet_file(spark, path))
    got = quality.completeness(scan, ["A", "B", "C"], "2025-05-02").collect()
    assert {(r.symbol, r.n_rows, r.n_files) for r in got} == {("A", 4, 2), ("B", 2, 2), ("C", 0, 0)}
    every = quality.completeness(scan, ["A", "B", "C"]).collect()
    assert sorted(map(str, every)) == sorted(map(str, got))


def test_missing_symbols_and_requirement(make_trades):
    trades = make_trades({"symbol": "A"}, {"symbol": "B", "ts": "2025-05-03T10:00:00"})
    missing = quality.missing_symbols(trades, ["A", "B"]).collect()
    assert {(r.symbol, r.event_date.day) for r in missing} == {("B", 2), ("A", 3)}
    require_complete(trades, ["A"], "2025-05-02")
    with pytest.raises(ValueError, match="B, C"):
        require_complete(trades, ["C", "A", "B"], "2025-05-02")
    with pytest.raises(ValueError):
        require_complete(trades, ["A"], "1999-01-01")


def test_profile(make_trades):
    trades = make_trades({"conditions": None}, {"exchange": None}, {})
    got = {r.column_name: (r.data_type, r.non_null_count) for r in quality.profile(trades).collect()}
    assert list(got) == trades.columns
    assert got["conditions"] == ("array<string>", 2) and got["exchange"] == ("string", 2)
    assert got["price"] == ("double", 3)


def test_value_counts(make_trades):
    trades = make_trades(*[{"exchange": e} for e in ("B", "A", "C", "C", None)])
    got = [tuple(r) for r in quality.value_counts(trades, "exchange").collect()]
    assert got == [("C", 2), ("A", 1), ("B", 1)]


def test_preview(make_trades):
    trades = make_trades({"id": 3}, {"id": 1}, {"id": 2})
    assert [r.id for r in quality.preview(trades, 2, ["id"]).collect()] == [1, 2]
    assert quality.preview(trades).count() == 3


@pytest.mark.parametrize(
    "day, market_day",
    [
        ("2025-05-05", "2025-05-02"),  # Monday
        ("2025-05-04", "2025-05-02"),  # Sunday
        ("2025-05-03", "2025-05-02"),  # Saturday
        ("2025-05-06", "2025-05-05"),
    ],
)
def test_previous_market_day(spark, day, market_day):
    got = spark.range(1).select(calendar.previous_market_day(calendar.date_literal(day))).first()[0]
    assert got.isoformat() == market_day


def test_month_start_and_shift(spark):
    day = calendar.date_literal("2025-03-01")
    row = spark.range(1).select(calendar.month_start(day), calendar.shift_days(day, -1)).first()
    assert tuple(row) == (dt.date(2025, 3, 1), dt.date(2025, 2, 28))


def test_typed_documents(spark):
    names = ["price", "size", "rolling_avg_price", "rolling_std_price", "cumulative_volume"]
    names += ["exchange_index", "tape_index", "condition_at", "condition_i", "condition_t"]
    names += ["hour", "minute", "second", "day_of_week", "timestamp_epoch"]
    text = spark.range(1).select(
        F.lit("AAPL").alias("symbol"), *[F.lit("3.7").alias(n) for n in names]
    )
    text = text.withColumns({"hour": F.lit("late"), "timestamp_epoch": F.lit("1746192600")})
    row = typed_documents(text).first()
    assert row.price == 3.7 and row.minute == 3 and row.hour is None and row.symbol == "AAPL"
    assert row.timestamp == dt.datetime(2025, 5, 2, 13, 30)


def test_whole_write_keeps_rows(spark, make_trades, tmp_path):
    path = str(tmp_path / "whole")
    write_table(make_trades({"symbol": "A"}, {"symbol": "B"}), path)
    assert read_parquet_file(spark, path).count() == 2
