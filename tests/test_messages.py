import json

import pytest
from pyspark.sql import functions as F

from conftest import utc
from tickforge.operators import filters, messages
from tickforge.operators.quality import message_counts


def test_trade_message_fields(make_trades):
    trades = make_trades({"ts": "2025-05-02T13:30:00.123456", "id": 42, "conditions": None})
    record = messages.as_records(messages.trade_messages(trades), keyed=True).first()
    assert record.key == "AAPL"
    assert json.loads(record.value) == {
        "symbol": "AAPL",
        "price": 10.0,
        "size": 1.0,
        "exchange": "V",
        "conditions": None,
        "tape": "C",
        "id": 42,
        "timestamp": "2025-05-02T13:30:00.123456+00:00",
        "event_date": "2025-05-02",
    }


def test_reco_envelope(make_recos):
    record = messages.as_records(
        messages.reco_messages(make_recos(("A", "2025-05-01", 9))), keyed=False
    ).first()
    assert record.key is None
    value = json.loads(record.value)
    assert value["event_date"] == value["payload"]["period"] == "2025-05-01"
    assert value["type"] == "RECO" and value["payload"]["buy"] == 9


def test_news_envelope(spark):
    news = spark.createDataFrame(
        [("A", (1746230399, "late"))], "symbol string, payload struct<datetime:long,headline:string>"
    )
    row = messages.news_messages(news).first()
    assert (row.event_date, row.type, row.payload.headline) == ("2025-05-02", "NEWS", "late")


RECORDS = {
    '{"symbol":"A","event_date":"2025-05-01","type":"RECO"}': (None, None, None),
    '{"symbol":"A","event_date":"2025-05-01"}': (None, "wrong type", None),
    '{"symbol":"A","event_date":"2025-05-01","type":"NEWS"}': (None, "wrong type", None),
    '{"symbol":"","event_date":"2025-05-01","type":"RECO"}': (None, "missing key", "missing key"),
    '{"symbol":null,"event_date":"2025-05-01","type":"RECO"}': ("missing key",) * 3,
    '{"event_date":"2025-05-01","type":"RECO"}': ("missing key",) * 3,
    '{"symbol":"A","event_date":"","type":"RECO"}': (None, "missing key", "missing key"),
    "{bad": ("malformed",) * 3,
    "[1, 2]": ("malformed",) * 3,
    '"text"': ("malformed",) * 3,
    None: ("malformed",) * 3,
}


@pytest.mark.parametrize("position, feed", list(enumerate(["trades", "recos", "news"])))
def test_reject_reasons(spark, position, feed):
    records = spark.createDataFrame([(value,) for value in RECORDS], "value string")
    classified = messages.classify(messages.read_envelopes(records), feed)
    got = {row.value: row.reason for row in classified.collect()}
    assert got == {value: reasons[position] for value, reasons in RECORDS.items()}
    good, bad = messages.accepted(classified), messages.rejected(classified)
    assert good.count() + bad.count() == len(RECORDS)


def test_mixed_topic_is_split_by_type(spark):
    values = ['{"symbol":"A","event_date":"2025-05-02","type":"%s"}' % t for t in ("RECO", "NEWS", "X")]
    values.append('{"symbol":"A","event_date":"2025-05-02"}')
    records = spark.createDataFrame([(v,) for v in values], "value string")
    classified = messages.classify(messages.read_envelopes(records))
    assert [r.feed for r in classified.collect()] == ["recos", "news", "trades", "trades"]
    counts = {(r.type, r.status): r.n_messages for r in message_counts(classified).collect()}
    assert counts == {(t, "accepted"): 1 for t in ("RECO", "NEWS", "X", None)}


def test_session_bounds(make_trades):
    trades = make_trades(
        *[
            {"ts": f"2025-05-02T{t}"}
            for t in ("13:29:59.999999", "13:30:00", "20:00:00", "20:00:00.000001")
        ],
        {"ts": "2025-05-01T15:00:00"},
    )
    kept = filters.in_session(trades, "2025-05-02").select("id").collect()
    assert sorted(r.id for r in kept) == [2, 3]


def test_session_by_local_clock_in_winter(make_trades):
    trades = make_trades(
        *[{"ts": f"2025-01-10T{t}"} for t in ("14:29:59", "14:30:00", "21:00:00", "21:00:01")]
    )
    kept = filters.in_session(trades, "2025-01-10", local=True).select("timestamp_parsed")
    stamps = sorted(r[0].replace(tzinfo=utc("2025-01-10").tzinfo) for r in kept.collect())
    assert stamps == [utc("2025-01-10T14:30:00"), utc("2025-01-10T21:00:00")]


def test_universe_by_list_or_table(spark, make_trades):
    trades = make_trades({"symbol": "A"}, {"symbol": "B"}, {"symbol": "C"})
    table = spark.createDataFrame([("A",), ("C",), ("D",)], "symbol string")
    by_list = filters.in_universe(trades, ["A", "C", "D"])
    by_table = filters.in_universe(trades, table).select(*trades.columns)
    assert sorted(by_list.collect()) == sorted(by_table.collect())
    assert by_list.count() == 2


def test_on_day(spark):
    news = spark.createDataFrame([("2025-05-02",), ("2025-05-03",)], "event_date string")
    assert filters.on_day(news, "2025-05-02").count() == 1
    dated = news.select(F.to_date("event_date").alias("event_date"))
    assert filters.on_day(dated, "2025-05-02").count() == 1
