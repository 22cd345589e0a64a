import datetime as dt

import pytest

from tickforge.operators.bars import price_bars
from tickforge.operators.enrich import enrich_asof, enrich_day, recos_as_of
from tickforge.operators.recos import flatten_recos, latest_as_of, latest_if_current, reco_periods
from tickforge.plans.market import enrich_market
from tickforge.schemas import ENRICHED_COLUMNS, RECO_MESSAGE


def test_flatten(spark):
    raw = [
        ("A", "2025-05-01", "RECO", ("2025-05-01", 1, 2, 3, 4, 5)),
        ("B", "2025-05-01", "RECO", ("2025-05-01", 9, 9, 9, 9, 9)),
    ]
    flat = flatten_recos(spark.createDataFrame(raw, RECO_MESSAGE), "A")
    assert [tuple(r) for r in flat.collect()] == [("A", dt.date(2025, 5, 1), 1, 2, 3, 4, 5)]
    assert reco_periods(flat).count() == 1


def test_later_data_tells_the_two_latest_apart(make_recos):
    recos = make_recos(("A", "2025-04-01", 1), ("A", "2025-05-01", 2), ("A", "2025-06-01", 3))
    assert latest_if_current(recos, "2025-05-02").count() == 0
    assert [r.buy for r in latest_as_of(recos, "2025-05-02").collect()] == [2]
    assert [r.buy for r in latest_if_current(recos, "2025-06-01").collect()] == [3]


def test_ties(make_recos):
    recos = make_recos(("A", "2025-05-01", 1), ("A", "2025-05-01", 2), ("A", "2025-04-01", 9))
    assert sorted(r.buy for r in latest_if_current(recos, "2025-05-02").collect()) == [1, 2]
    assert [r.buy for r in latest_as_of(recos, "2025-05-02").collect()] == [2]


def test_latest_as_of_limits_groups_before_the_shuffle(make_recos):
    plan = latest_as_of(make_recos(("A", "2025-05-01", 1)), "2025-05-02")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in text


@pytest.fixture
def market_inputs(make_trades, make_recos):
    trades = make_trades(
        {"symbol": "A", "ts": "2025-04-30T10:00:00"},
        {"symbol": "A", "ts": "2025-05-01T10:00:00"},
        {"symbol": "A", "ts": "2025-05-03T10:00:00"},
        {"symbol": "A", "ts": "2025-05-03T10:01:00"},
        {"symbol": "NONE", "ts": "2025-05-03T10:01:00"},
    )
    recos = make_recos(
        ("A", "2025-05-01", 1),
        ("A", "2025-05-02", 2),
        ("A", "2025-05-02", 1),
        ("A", "2025-05-04", 3),
        ("OTHER", "2025-01-01", 7),
    )
    return trades, recos


def test_asof_equals_each_day_on_its_own(market_inputs):
    trades, recos = market_inputs
    bars = price_bars(trades)
    found = enrich_asof(bars, recos)
    assert found.columns == [*ENRICHED_COLUMNS, "bar_start"]
    rows = {(r.symbol, r.bar_start): r.buy_score for r in found.collect()}
    assert rows == {
        ("A", dt.datetime(2025, 4, 30, 10)): None,
        ("A", dt.datetime(2025, 5, 1, 10)): 1,
        ("A", dt.datetime(2025, 5, 3, 10)): 2,
        ("A", dt.datetime(2025, 5, 3, 10, 1)): 2,
        ("NONE", dt.datetime(2025, 5, 3, 10, 1)): None,
    }
    for day in ("2025-04-30", "2025-05-01", "2025-05-03"):
        one = enrich_day(bars, recos, day).collect()
        assert sorted(map(str, one)) == sorted(
            str(r) for r in found.collect() if str(r.event_date) == day
        )


def test_market_is_bars_then_asof(market_inputs):
    trades, recos = market_inputs
    whole = enrich_market(trades, recos)
    assert sorted(map(str, whole.collect())) == sorted(
        map(str, enrich_asof(price_bars(trades), recos).collect())
    )
    only = enrich_market(trades, recos, symbols=["NONE"])
    assert [r.symbol for r in only.collect()] == ["NONE"]


def test_asof_forms_no_pairs(market_inputs):
    trades, recos = market_inputs
    plan = recos_as_of(trades, recos)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
