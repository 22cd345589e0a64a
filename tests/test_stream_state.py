"""What outlives a trigger: waiting messages, positions, running counts, open bars."""

import json

import pytest
from pyspark.sql import functions as F

from tickforge.operators.chunks import latest_by_position
from tickforge.sources.streams import folder_stream, record_stream
from tickforge.streaming import bars, chunks, totals
from tickforge.streaming.landing import (
    landed_text,
    landing_query,
    landing_steps,
    read_landed,
    read_misfits,
    read_rejected,
    redrive_query,
)
from tickforge.streaming.steps import Steps

FIELDS = "symbol string, event_date string, id long"


def send(spark, folder, rows, schema=FIELDS):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(folder / "in"))


def run(writer):
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


@pytest.fixture
def schema(spark):
    return spark.createDataFrame([], FIELDS).schema


def fill(spark, folder, schema, size=4, wait="1 day", target_rows=2_000_000):
    stream = spark.readStream.schema(schema).json(str(folder / "in"))
    return run(
        chunks.chunk_query(
            stream, str(folder / "out"), str(folder / "cp"), ["id"], size, wait, target_rows=target_rows
        )
    )


def arrays(spark, folder, schema):
    """Ids of each array by key, in order."""
    rows = chunks.read_chunks(spark, str(folder / "out"), schema).orderBy("symbol", "step", "chunk").collect()
    return [(r.symbol, [m["id"] for m in json.loads(r.messages)]) for r in rows]


def waiting(spark, folder, schema):
    rows = chunks.waiting_messages(spark, str(folder / "out"), schema).collect()
    return sorted((r.symbol or "", r.id) for r in rows)


def test_chunks_fill_across_triggers_and_restarts(spark, tmp_path, schema):
    send(spark, tmp_path, [("A", "d", n) for n in range(6)] + [("B", "d", 0), (None, "d", 7)])
    fill(spark, tmp_path, schema)
    assert arrays(spark, tmp_path, schema) == [("A", [0, 1, 2, 3])]
    assert waiting(spark, tmp_path, schema) == [("", 7), ("A", 4), ("A", 5), ("B", 0)]
    # A smaller id that comes later stands behind those that wait.
    send(spark, tmp_path, [("A", "d", n) for n in (1, 9, 8)] + [("B", "d", 1)])
    fill(spark, tmp_path, schema)
    fill(spark, tmp_path, schema)
    assert arrays(spark, tmp_path, schema) == [("A", [0, 1, 2, 3]), ("A", [4, 5, 1, 8])]
    chunks.flush_chunks(spark, str(tmp_path / "out"), schema, ["id"], size=4)
    found = arrays(spark, tmp_path, schema)
    assert found[3:] == [("A", [9]), ("B", [0, 1])] and found[0] == (None, [7])
    assert waiting(spark, tmp_path, schema) == []


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path, schema):
    steps = Steps(spark, str(tmp_path / "out"))
    rows = spark.createDataFrame([("A", "d", n) for n in range(5)], FIELDS)
    args = (["id"], 4, "1 day", ["symbol", "event_date"], 100)
    chunks._advance(steps, rows, 7, *args)
    before = arrays(spark, tmp_path, schema), waiting(spark, tmp_path, schema)
    # The next batch was written, and its writer died before the marker.
    half = rows.limit(2).withColumn("full", F.lit(True))
    half.write.partitionBy("full").parquet(steps.path(1))
    assert (arrays(spark, tmp_path, schema), waiting(spark, tmp_path, schema)) == before
    chunks._advance(steps, rows, 8, *args)
    assert arrays(spark, tmp_path, schema) == [("A", [0, 1, 2, 3]), ("A", [4, 0, 1, 2])]
    assert waiting(spark, tmp_path, schema) == [("A", 3), ("A", 4)]
    assert steps.last == (1, 8) and len(list((tmp_path / "out" / "_markers").glob("0*"))) == 1


def test_short_chunks_leave_after_their_wait(spark, tmp_path, schema):
    send(spark, tmp_path, [("A", "d", 0)])
    fill(spark, tmp_path, schema, wait="0 seconds")
    assert arrays(spark, tmp_path, schema) == [("A", [0])] and waiting(spark, tmp_path, schema) == []


def test_hot_keys_are_numbered_in_slices(spark, tmp_path, schema):
    for part in range(3):
        send(spark, tmp_path, [("A", "d", 1000 * part + n) for n in range(210)] + [("B", "d", part)])
        fill(spark, tmp_path, schema, size=50, target_rows=20)
    found = arrays(spark, tmp_path, schema)
    assert [len(ids) for _, ids in found] == [50] * 12
    whole = [i for _, ids in found for i in ids] + [i for s, i in waiting(spark, tmp_path, schema) if s == "A"]
    assert whole == [1000 * part + n for part in range(3) for n in range(210)]


def test_totals_go_on_after_restarts(spark, tmp_path):
    def count():
        stream = folder_stream(spark, str(tmp_path / "in"))
        run(totals.totals_query(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "trades"))
        rows = totals.message_totals(spark, str(tmp_path / "out")).collect()
        return {(r.feed, r.status): r.n_messages for r in rows}

    send(spark, tmp_path, [("A", "2025-05-02", n) for n in range(5)])
    assert count() == {("trades", "accepted"): 5}
    send(spark, tmp_path, [("A", "2025-05-02", 1), ("A", "never", 2)])
    want = {("trades", "accepted"): 6, ("trades", "bad date"): 1}
    assert count() == want and count() == want
    assert totals.message_totals(spark, str(tmp_path / "none")).count() == 0


def record(partition, offset, symbol, number, day="2025-05-02", micros=0):
    value = json.dumps({"symbol": symbol, "event_date": day, "id": number})
    return (None, value, "t", partition, offset, micros)


RECORD = "key string, value string, topic string, partition int, offset long, broker_micros long"


def test_positions_survive_landing_and_tell_repeats(spark, tmp_path):
    rows = [record(0, 5, "A", 50), record(0, 6, "A", 40), record(1, 1, "A", 60, micros=-9), record(0, 7, "B", 1)]
    send(spark, tmp_path, rows, RECORD)
    roots = [str(tmp_path / "raw"), str(tmp_path / "again")]
    stream = record_stream(spark, str(tmp_path / "in"))
    for root in roots:  # a lost checkpoint reads the topic again
        run(landing_query(stream, root, f"{root}-cp", "trades"))
    with pytest.raises(ValueError, match="another checkpoint"):
        landing_query(stream, roots[0], str(tmp_path / "new-cp"), "trades")
    assert read_landed(spark, roots, "trades").count() == 8
    once = read_landed(spark, roots, "trades", positions=True)
    assert sorted((r.partition, r.offset, r.id) for r in once.collect()) == [
        (0, 5, 50), (0, 6, 40), (0, 7, 1), (1, 1, 60)
    ]
    newest = {r.symbol: r.id for r in latest_by_position(once, "symbol").collect()}
    assert newest == {"A": 40, "B": 1}


def test_messages_without_positions_all_stay(spark, tmp_path):
    send(spark, tmp_path, [("A", "2025-05-02", 1), ("A", "2025-05-02", 1)])
    run(landing_query(folder_stream(spark, str(tmp_path / "in")), str(tmp_path / "raw"), str(tmp_path / "cp"), "trades"))
    rows = read_landed(spark, str(tmp_path / "raw"), "trades", positions=True).collect()
    assert [(r.id, r.offset) for r in rows] == [(1, None)] * 2


def test_refused_messages_are_redriven_once(spark, tmp_path):
    lines = [
        '{"symbol":"A","event_date":"2025/05/02","id":1}', '{"symbol":"A","event_date":"2025-05-02","id":2}',
        '{"symbol":"A","event_date":"soon","id":3}', '{"symbol":"A"', None, '{"symbol":"A","event_date":"2025-05-02","id":"x"}',
    ]
    rows = [(None, line, "t", 0, n, 0) for n, line in enumerate(lines)]
    send(spark, tmp_path, rows, RECORD)
    raw, mended = str(tmp_path / "raw"), str(tmp_path / "mended")
    run(landing_query(record_stream(spark, str(tmp_path / "in")), raw, str(tmp_path / "cp"), "trades"))
    assert sorted(r.reason for r in read_rejected(spark, raw).collect()) == ["bad date"] * 2 + ["malformed"] * 2
    assert read_misfits(spark, raw, "trades").count() == 1
    slashes = lambda value: F.translate(value, "/", "-")
    for _ in range(2):
        run(redrive_query(spark, raw, mended, str(tmp_path / "redrive"), slashes, "trades"))
    back = read_landed(spark, mended, "trades", positions=True).collect()
    assert [(r.id, r.event_date, r.offset) for r in back] == [(1, "2025-05-02", 0)]
    assert sorted(r.reason for r in read_rejected(spark, mended).collect()) == ["bad date", "malformed", "malformed"]
    assert landed_text(spark, mended).count() == 4


def test_late_trades_change_no_bar_and_are_counted(spark, make_trades, tmp_path):
    def take(*rows):
        make_trades(*rows).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(make_trades().schema).parquet(str(tmp_path / "in"))
        return run(bars.bars_query(stream, str(tmp_path / "out"), str(tmp_path / "cp"), "1 minute", "2 minutes"))

    at = "2025-05-02T13:{}:00".format
    take({"ts": at(30), "id": 1, "price": 5.0}, {"ts": at(30), "id": 1, "price": 5.0}, {"ts": at(31), "id": 2})
    # In time: the watermark stands at 13:29.
    take({"ts": at(30), "id": 3, "price": 7.0}, {"ts": at(40), "id": 4})
    late = take({"ts": at(30), "id": 5, "price": 99.0}, {"ts": at(35), "id": 6}, {"ts": at(50), "id": 7})
    assert bars.late_trades(late) == 2
    found = bars.read_bars(spark, str(tmp_path / "out")).orderBy("window.start").collect()
    assert [(r.window.start.minute, r.trade_count, r.high_price) for r in found][:2] == [(30, 2, 7.0), (31, 1, 10.0)]
    assert [r.window.start.minute for r in found] == [30, 31, 40]


def test_long_landing_has_bounded_files_and_log(spark, tmp_path):
    """Thirty triggers over four folders, gathered by threes, with a restart after each ten."""
    root, sent = tmp_path / "raw", []
    for part in range(30):
        rows = [(f"S{n % 3}", "2025-05-02", 10 * part + n) for n in range(6)] + [("", "2025-05-02", -part)]
        sent += [r[2] for r in rows]
        send(spark, tmp_path, rows)
        if part % 10 == 9:
            stream = folder_stream(spark, str(tmp_path / "in"), 1)
            query = landing_steps(stream, str(root), str(tmp_path / "cp"), gather_after=3)
            run(query)
            assert sorted(_ids(spark, root)) == sorted(sent)
    steps = Steps(spark, str(root), "json")
    assert steps.last[1] == 29 and sum(steps.visible.values()) == 30 and len(steps.visible) <= 6
    there = [p for p in root.glob("step=*/*/*/*/*.json")]
    assert len({p.relative_to(root).parts[0] for p in there}) <= 12 and len(there) <= 12 * 4
    assert len(list((root / "_markers").glob("[0-9]*"))) == 1
    one = read_landed(spark, str(root), "trades", "S1", "2025-05-02")
    assert one.count() == 60 and "PartitionFilters: [isnotnull(feed" in one._jdf.queryExecution().executedPlan().toString()


def _ids(spark, root):
    texts = landed_text(spark, str(root)).select("value").collect()
    return [json.loads(r.value)["id"] for r in texts]


def test_a_gathering_that_died_is_not_seen(spark, tmp_path):
    steps = Steps(spark, str(tmp_path))
    rows = spark.range(3).selectExpr("id", "id % 2 as part")
    for step in range(2):
        rows.write.partitionBy("part").parquet(steps.path(step))
        steps.commit(step, step)
    rows.write.partitionBy("part").parquet(steps.path(2))
    assert steps.read(rows.schema).count() == 6
    steps.gather(rows.schema, ["part"], 2)
    assert steps.visible == {2: 2} and steps.read(rows.schema).count() == 6
    assert (tmp_path / "step=0").exists()  # until the next gathering
    for step in (3, 4):
        rows.write.partitionBy("part").parquet(steps.path(step))
        steps.commit(step, step)
    steps.gather(rows.schema, ["part"], 2)
    assert steps.visible == {2: 2, 5: 2} and not (tmp_path / "step=0").exists()
