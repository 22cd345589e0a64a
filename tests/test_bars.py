import datetime as dt
import math

from pyspark.sql import functions as F

from tickforge.operators.bars import BAR_COLUMNS, price_bars


def test_one_trade_bar(make_trades):
    bar = price_bars(make_trades({"price": 7.0, "ts": "2025-05-02T13:30:59.999999"})).first()
    assert bar.open_price == bar.close_price == 7.0
    assert bar.volatility_price is None
    assert bar.window.start == dt.datetime(2025, 5, 2, 13, 30)
    assert bar.window.end == dt.datetime(2025, 5, 2, 13, 31)


def test_zero_volume_gives_null_vwap(make_trades):
    bar = price_bars(make_trades({"size": 0}, {"size": 0})).first()
    assert bar.vwap is None and bar.volume_sum == 0 and bar.trade_count == 2


def test_open_and_close_by_time_then_id(make_trades):
    same = "2025-05-02T14:00:00"
    big = 2**63 - 1
    bar = price_bars(
        make_trades(
            {"ts": same, "id": big, "price": 3.0},
            {"ts": same, "id": -big, "price": 1.0},
            {"ts": same, "id": 0, "price": 9.0},
        )
    ).first()
    assert (bar.open_price, bar.close_price) == (1.0, 3.0)


def test_earlier_time_beats_smaller_id(make_trades):
    big = 2**63 - 1
    bar = price_bars(
        make_trades(
            {"ts": "2025-05-02T14:00:00.000001", "id": -big, "price": 2.0},
            {"ts": "2025-05-02T14:00:00", "id": big, "price": 1.0},
        )
    ).first()
    assert (bar.open_price, bar.close_price) == (1.0, 2.0)


def test_window_sizes_and_columns(make_trades):
    trades = make_trades(
        {"ts": "2025-05-02T13:34:59", "price": 1, "size": 3},
        {"ts": "2025-05-02T13:35:00", "price": 2, "size": 1},
        {"ts": "2025-05-02T13:39:59", "price": 5, "size": 2},
    )
    bars = price_bars(trades, "5 minutes").orderBy("window.start")
    assert bars.columns == BAR_COLUMNS
    first, second = bars.collect()
    assert (first.trade_count, second.trade_count) == (1, 2)
    assert (second.low_price, second.high_price) == (2.0, 5.0)
    assert math.isclose(second.vwap, 12 / 3)


def test_timestamp_is_rebuilt_from_the_epoch(make_trades):
    trades = make_trades({"ts": "2025-05-02T13:30:01.7", "price": 2}, {"ts": "2025-05-02T13:30:01"})
    plain = trades.withColumn("timestamp_epoch", F.unix_timestamp("timestamp_parsed")).drop(
        "timestamp_parsed", "id"
    )
    bar = price_bars(plain).first()
    assert bar.trade_count == 2
    assert (bar.open_price, bar.close_price) == (2.0, 10.0)  # same second: by price


def test_bars_aggregate_by_hash_before_one_shuffle(make_trades):
    plan = price_bars(make_trades({}))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    assert plan.count("Exchange") == 1
    assert "partial_min_by" in plan
