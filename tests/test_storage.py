import json
from pathlib import Path

import pytest

from tickforge.sources import files
from tickforge.plans.completeness import table_completeness
from tickforge.session import session_conf
from tickforge.schemas import KEYS
from tickforge.operators.bars import price_bars
from tickforge.operators.enrich import enrich_day
from tickforge.schemas import BARS, RECOS, TRADE_MESSAGE
from tickforge.session import build_session, object_store_conf, require_utc, stage, staged
from tickforge.sinks.files import export_json_lines, write_table
from tickforge.sources.files import read_json_arrays, read_json_lines, read_table


def test_json_arrays_in_any_folder_layout(spark, tmp_path):
    rows = [{"symbol": "A", "price": 1, "id": n, "event_date": "2025-05-02"} for n in range(3)]
    for folder, part in (("A/event_date=2025-05-02", rows[:2]), ("", rows[2:])):
        target = tmp_path / "raw" / folder
        target.mkdir(parents=True, exist_ok=True)
        (target / "x.json").write_text(json.dumps(part, indent=2))
    (tmp_path / "raw" / "notes.txt").write_text("not data")
    table = read_json_arrays(spark, str(tmp_path / "raw"), TRADE_MESSAGE)
    assert table.columns == TRADE_MESSAGE.names
    assert sorted(r.id for r in table.collect()) == [0, 1, 2]


def test_missing_input_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_json_arrays(spark, str(tmp_path / "nothing"), TRADE_MESSAGE).count()


def test_overwrite_leaves_other_partitions(spark, make_recos, tmp_path):
    path = str(tmp_path / "recos")
    write_table(make_recos(("A", "2025-05-01", 1), ("A", "2025-06-01", 2)), path)
    write_table(make_recos(("B", "2025-05-01", 3)), path)
    write_table(make_recos(("A", "2025-05-01", 4)), path)
    got = {(r.symbol, str(r.event_date), r.buy) for r in read_table(spark, path, RECOS).collect()}
    assert got == {("A", "2025-05-01", 4), ("A", "2025-06-01", 2), ("B", "2025-05-01", 3)}
    write_table(make_recos(("A", "2025-05-01", 1)).limit(0), path)
    assert read_table(spark, path, RECOS).count() == 3


def test_numeric_symbols_stay_text(spark, make_recos, tmp_path):
    path = str(tmp_path / "numbers")
    write_table(make_recos(("0700", "2025-05-01", 1)), path)
    assert read_table(spark, path, RECOS, symbol="0700").first().symbol == "0700"


def test_filters_prune_partitions(spark, make_recos, tmp_path):
    path = str(tmp_path / "pruned")
    write_table(make_recos(("A", "2025-05-01", 1), ("A", "2025-06-01", 2)), path)
    part = read_table(spark, path, RECOS, symbol="A", until="2025-05-31")
    plan = part._jdf.queryExecution().executedPlan().toString()
    pruned = plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "symbol" in pruned and "event_date" in pruned
    assert [r.buy for r in part.collect()] == [1]


def test_enrich_day_prunes_both_tables(spark, make_trades, make_recos, tmp_path):
    recos, bars = str(tmp_path / "r"), str(tmp_path / "b")
    write_table(make_recos(("A", "2025-05-01", 1)), recos)
    write_table(price_bars(make_trades({"symbol": "A"})), bars)
    joined = enrich_day(read_table(spark, bars, BARS), read_table(spark, recos, RECOS), "2025-05-02")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") >= 2 and "PartitionFilters: []" not in plan
    assert "BroadcastHashJoin" in plan
    assert joined.first().buy_score == 1


def test_hot_partition_is_written_by_many_tasks(spark, tmp_path):
    path = tmp_path / "hot"
    rows = spark.range(0, 200_000, 1, 8).selectExpr("'A' as symbol", "date'2025-05-02' as event_date", "id")
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "100KB")
    try:
        write_table(rows, str(path))
    finally:
        spark.conf.unset(size)
    files = list((path / "symbol=A" / "event_date=2025-05-02").glob("*.parquet"))
    assert len(files) > 1
    assert spark.read.parquet(str(path)).count() == 200_000


def test_json_export_keeps_nulls_and_microseconds(spark, make_trades, tmp_path):
    path = str(tmp_path / "export")
    trades = make_trades({"ts": "2025-05-02T13:30:00.123456", "conditions": None})
    export_json_lines(trades, path)
    line = json.loads(spark.read.text(path).first().value)
    assert line["conditions"] is None
    assert line["timestamp_parsed"].startswith("2025-05-02T13:30:00.123456")
    assert line["symbol"] == "AAPL" and line["event_date"] == "2025-05-02"
    assert read_json_lines(spark, path, trades.schema).collect() == trades.collect()


def test_stage_keeps_rows_and_schema(spark, make_trades):
    trades = make_trades({}, {})
    kept = stage(trades, "test")
    assert kept.schema == trades.schema and kept.count() == 2


def test_staged_files_are_deleted(spark, make_trades):
    with staged(make_trades({}), "test") as table:
        assert table.count() == 1
        path = Path(table.inputFiles()[0].removeprefix("file://")).parent
        assert path.exists()
    assert not path.exists()


def test_session_settings(spark, monkeypatch):
    monkeypatch.setenv("AWS_ENDPOINT_URL", "http://store:9000")
    monkeypatch.setenv("AWS_ACCESS_KEY_ID", "k")
    monkeypatch.setenv("AWS_SECRET_ACCESS_KEY", "s")
    conf = object_store_conf()
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://store:9000"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.access.key"] == "k"
    require_utc(build_session("tests"))
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        with pytest.raises(ValueError, match="UTC"):
            require_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_inventory_counts_files_and_footers(spark, make_trades, tmp_path):
    root = str(tmp_path / "t")
    for _ in range(2):
        rows = make_trades({"symbol": "007"}, {"symbol": "007"}, {"symbol": "B", "ts": "2025-05-03T10:00:00"})
        rows.coalesce(1).write.mode("append").partitionBy(*KEYS).parquet(root)
    before = {r.key: r.value for r in spark.sql("SET").collect()}
    found = files.table_inventory(spark, root).collect()
    assert {(r.symbol, str(r.event_date), r.n_rows, r.n_files) for r in found} == {
        ("007", "2025-05-02", 4, 2), ("B", "2025-05-03", 2, 2)
    }
    assert {r.key: r.value for r in spark.sql("SET").collect()} == before
    with session_conf(spark, files._FOOTERS):
        plan = files.footer_counts(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "PushedGroupBy: [symbol, event_date]" in plan
    symbols = spark.createDataFrame([("007",), ("B",), ("C",)], "symbol string")
    rows = table_completeness(spark, root, symbols, "2025-05-03").collect()
    assert {(r.symbol, r.n_rows, r.n_files) for r in rows} == {("007", 0, 0), ("B", 2, 2), ("C", 0, 0)}


def test_an_absent_part_of_an_array_layout_is_empty(spark, tmp_path):
    part = tmp_path / "symbol=A" / "event_date=2025-05-02"
    part.mkdir(parents=True)
    (part / "x.json").write_text('[{"symbol": "A", "id": 1}]')
    read = lambda *key: files.read_json_arrays(spark, str(tmp_path), TRADE_MESSAGE, *key)
    assert read("A", "2025-05-02").count() == 1 and read(None, "2025-05-02").count() == 1
    absent = read("B", "2025-05-02")
    assert absent.count() == 0 and not absent.inputFiles()
