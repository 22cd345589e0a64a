import json
import re

import pytest

from tickforge.sources.streams import folder_stream, topic_records, topic_stream
from tickforge.streaming.landing import (
    landed_text,
    landing_query,
    read_landed,
    read_misfits,
    read_rejected,
    routed,
)


def message(number, **more):
    base = {"symbol": f"S{number % 3}", "event_date": "2025-05-02", "id": number}
    return json.dumps({**base, **more})


def send(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def land(spark, tmp_path, feed=None, **options):
    stream = folder_stream(spark, str(tmp_path / "in"), 1)
    writer = landing_query(stream, str(tmp_path / "raw"), str(tmp_path / "cp"), feed, **options)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def test_restart_adds_only_new_messages(spark, tmp_path):
    root = str(tmp_path / "raw")
    send(tmp_path / "in", "1", [message(n) for n in range(10)])
    send(tmp_path / "in", "2", [message(n) for n in range(10, 15)] + ["{bad", message(99, symbol=None)])
    land(spark, tmp_path, "trades")
    assert sorted(r.id for r in read_landed(spark, root, "trades").collect()) == list(range(15))
    land(spark, tmp_path, "trades")
    assert read_landed(spark, root, "trades").count() == 15
    send(tmp_path / "in", "3", [message(15)])
    land(spark, tmp_path, "trades")
    assert sorted(r.id for r in read_landed(spark, root, "trades").collect()) == list(range(16))
    reasons = [r.reason for r in read_rejected(spark, root).collect()]
    assert sorted(reasons) == ["malformed", "missing key"]


def test_mixed_topic_lands_by_type_and_equals_batch(spark, tmp_path):
    lines = [
        message(1, type="RECO", payload={"period": "2025-05-02", "buy": 3}),
        message(2, type="NEWS", payload={"datetime": 1746192600, "headline": "x"}),
        message(3, price=1.5),
        message(4, type="RECO", symbol=""),
    ]
    send(tmp_path / "in", "1", lines)
    root = str(tmp_path / "raw")
    query = land(spark, tmp_path)
    assert read_landed(spark, root, "recos").first().payload.buy == 3
    news = read_landed(spark, root, "news").first()
    assert json.loads(news.payload)["headline"] == "x"
    assert read_landed(spark, root, "trades").first().price == 1.5
    assert [r.reason for r in read_rejected(spark, root).collect()] == ["missing key"]
    batch = routed(spark.read.text(str(tmp_path / "in")))
    columns = ["value", "reason", "feed", "symbol", "event_date"]
    assert sorted(map(str, landed_text(spark, root).select(columns).collect())) == sorted(
        map(str, batch.select(columns).collect())
    )
    seen = query.lastProgress["observedMetrics"]["messages"]
    assert (seen["received"], seen["rejected"]) == (4, 1)


def test_files_are_bounded(spark, tmp_path):
    send(tmp_path / "in", "1", [message(0) for _ in range(10)])
    land(spark, tmp_path, "trades", records_per_file=4)
    files = list((tmp_path / "raw").glob("feed=trades/symbol=S0/event_date=2025-05-02/*.json"))
    assert sorted(len(f.read_text().splitlines()) for f in files) == [2, 4, 4]


def test_landed_folders_are_pruned(spark, tmp_path):
    send(tmp_path / "in", "1", [message(0)])
    land(spark, tmp_path, "trades")
    table = read_landed(spark, str(tmp_path / "raw"), "trades")
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(feed" in plan


def test_one_symbol_and_day_is_read_alone(spark, tmp_path):
    send(tmp_path / "in", "1", [message(0), "\n\t " + message(1), message(2).replace("2025-05-02", "n/a")])
    land(spark, tmp_path, "trades")
    root = str(tmp_path / "raw")
    table = read_landed(spark, root, "trades", "S0", "2025-05-02")
    filters = re.search(r"PartitionFilters: \[(.*?)\], ", plan_of(table))[1]
    assert all(name in filters for name in ("feed", "symbol", "event_date"))
    assert sorted(r.id for r in table.collect()) == sorted({0, 1} if message(1).count("S0") else {0})
    assert "bad date" in {r.reason for r in read_rejected(spark, root).collect()}


def test_wrongly_typed_fields_are_listed(spark, tmp_path):
    bad = json.dumps(json.loads(message(0)) | {"price": "twelve"})
    send(tmp_path / "in", "1", [message(0), bad])
    land(spark, tmp_path, "trades")
    misfits = read_misfits(spark, str(tmp_path / "raw"), "trades").collect()
    assert [r.reason for r in misfits] == ["bad field"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_topic_records_keep_the_order_of_arrival(spark):
    row = (b"k", b"v", "t", 1, 7, None)
    loaded = spark.createDataFrame(
        [row], "key binary, value binary, topic string, partition int, offset long, timestamp timestamp"
    )
    assert topic_records(loaded).first() == ("k", "v", "t", 1, 7, None)


def test_topic_source_needs_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        topic_stream(spark, "nowhere:9092", "trades", 10)
