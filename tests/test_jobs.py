import json

import pytest

from tickforge.plans.jobs import main, parse
from tickforge.schemas import ENRICHED, FEATURE_COLUMNS, SYMBOLS
from tickforge.sources.files import read_table


def trade(symbol, number, day="2025-05-02"):
    return {
        "symbol": symbol,
        "price": 10.0 + number,
        "size": 2.0,
        "exchange": "VQ"[number % 2],
        "conditions": ["@", "I"] if number % 2 else None,
        "tape": "C",
        "id": number,
        "timestamp": f"{day}T13:30:{number:02d}.25+00:00",
        "event_date": day,
    }


def reco(symbol, period, buy):
    counts = {"buy": buy, "hold": 1, "sell": 1, "strongBuy": 1, "strongSell": 1, "symbol": symbol}
    return {
        "symbol": symbol,
        "event_date": period,
        "type": "RECO",
        "payload": {"period": period, **counts},
    }


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """Both raw feeds as JSON-array files, and every batch table built from them."""
    root = tmp_path_factory.mktemp("lake")

    def put(folder, rows):
        (root / folder).mkdir(parents=True)
        (root / folder / "a.json").write_text(json.dumps(rows, indent=2))

    put("raw/trades/A/event_date=2025-05-02", [trade("A", n) for n in range(12)])
    put("raw/trades/B/event_date=2025-05-02", [trade("B", n) for n in range(3)])
    put("raw/recos/A", [reco("A", "2025-05-01", 7), reco("A", "2025-06-01", 8)])
    paths = {name: str(root / name) for name in ("features", "bars", "recos", "latest", "enriched")}
    arrays = ["--raw_layout", "arrays"]

    def run(*argv):
        main(list(argv), spark)

    run("features", "--input_path", f"{root}/raw/trades", "--output_path", paths["features"], *arrays)
    run("bars", "--input_path", paths["features"], "--output_path", paths["bars"])
    run("recos", "--input_path", f"{root}/raw/recos", "--output_path", paths["recos"], *arrays)
    run(
        *("latest-recos", "--input_path", paths["recos"], "--output_path", paths["latest"]),
        *("--event_date", "2025-05-02"),
    )
    run(
        *("enrich", "--bars_path", paths["bars"], "--recos_path", paths["recos"]),
        *("--output_path", paths["enriched"]),
    )
    return root, paths, run


def test_feature_and_bar_tables(spark, lake):
    _, paths, _ = lake
    features = spark.read.parquet(paths["features"])
    assert features.count() == 15 and set(FEATURE_COLUMNS) <= set(features.columns)
    bars = spark.read.parquet(paths["bars"]).orderBy("symbol").collect()
    assert [(b.symbol, b.open_price, b.close_price) for b in bars] == [
        ("A", 10.0, 21.0),
        ("B", 10.0, 12.0),
    ]


def test_enriched_table(spark, lake):
    _, paths, _ = lake
    rows = read_table(spark, paths["enriched"], ENRICHED).orderBy("symbol").collect()
    assert [(r.symbol, r.buy_score, str(r.reco_event_date)) for r in rows] == [
        ("A", 7, "2025-05-01"),
        ("B", None, "None"),
    ]
    assert spark.read.parquet(paths["latest"]).count() == 1


def test_market_job_equals_the_steps(spark, lake):
    root, paths, run = lake
    out = f"{root}/market"
    run(
        *("market", "--input_path", paths["features"], "--recos_path", paths["recos"]),
        *("--output_path", out),
    )
    both = [read_table(spark, p, ENRICHED).collect() for p in (out, paths["enriched"])]
    assert sorted(map(str, both[0])) == sorted(map(str, both[1]))


def test_one_symbol_run_keeps_the_others(spark, lake):
    root, paths, run = lake
    run(
        *("features", "--input_path", f"{root}/raw/trades", "--output_path", paths["features"]),
        *("--raw_layout", "arrays", "--symbol", "B", "--event_date", "2025-05-02"),
        *("--code_scope", "day", "--debug"),
    )
    assert spark.read.parquet(paths["features"]).groupBy("symbol").count().count() == 2


def test_missing_symbols_stop_the_feature_job(lake):
    root, paths, run = lake
    with pytest.raises(ValueError, match="MSFT"):
        run(
            *("features", "--input_path", f"{root}/raw/trades"),
            *("--output_path", paths["features"], "--raw_layout", "arrays"),
            *("--event_date", "2025-05-02", "--require_symbols"),
        )


def test_documents_and_landing_jobs(spark, lake):
    root, paths, run = lake
    run("documents", "--input_path", paths["features"], "--output_path", f"{root}/documents")
    document = json.loads(spark.read.text(f"{root}/documents").first().value)
    assert {*FEATURE_COLUMNS, "timestamp"} == set(document)
    (root / "topic").mkdir()
    lines = [json.dumps(trade("A", n)) for n in range(4)]
    (root / "topic" / "1").write_text("\n".join(lines))
    run(
        *("land", "--input_path", f"{root}/topic", "--output_path", f"{root}/landed"),
        *("--checkpoint", f"{root}/landed-state", "--feed", "trades", "--once"),
    )
    run("features", "--input_path", f"{root}/landed", "--output_path", f"{root}/features2")
    assert spark.read.parquet(f"{root}/features2").count() == 4


def test_feature_job_keeps_labels_and_counts_what_it_wrote(spark, lake):
    root, _, run = lake
    (root / "more").mkdir()
    lines = [json.dumps(trade("A", n) | {"exchange": "VQ"[n > 0]}) for n in range(4)]
    (root / "more" / "1").write_text("\n".join([*lines, json.dumps(trade("B", 1) | {"timestamp": "noon"})]))
    run(
        *("land", "--input_path", f"{root}/more", "--output_path", f"{root}/more-landed", "--once"),
        *("--checkpoint", f"{root}/more-state", "--feed", "trades", "--gather_after", "2"),
    )
    run(
        *("features", "--input_path", f"{root}/more-landed", "--output_path", f"{root}/features3"),
        *("--labels_path", f"{root}/labels", "--completeness_path", f"{root}/complete"),
        *("--rejects_path", f"{root}/rejects"),
    )
    rows = spark.read.parquet(f"{root}/features3").where("symbol = 'A'").collect()
    assert {r.exchange_index for r in rows} == {0.0, 1.0} and len(rows) == 4
    counts = {(r.column, r.label): r.n for r in spark.read.parquet(f"{root}/labels").collect()}
    assert counts[("exchange", "Q")] == 4 and counts[("tape", "C")] == 5
    complete = {r.symbol: (r.n_rows, r.n_files) for r in spark.read.json(f"{root}/complete").collect()}
    assert set(complete) == set(SYMBOLS) and complete["MSFT"] == (0, 0)
    assert [r.reason for r in spark.read.json(f"{root}/rejects").collect()] == ["bad time"]


def test_streaming_jobs(spark, lake):
    root, _, run = lake
    (root / "day").mkdir()
    lines = [json.dumps(trade("A", n)) for n in range(7)] + [json.dumps(trade("A", 8) | {"event_date": "8/5"})]
    (root / "day" / "1").write_text("\n".join([*lines, json.dumps(trade("A", 9, "2025-05-03"))]))

    def stream(job, *more):
        run(job, "--input_path", f"{root}/day", "--output_path", f"{root}/{job}", "--checkpoint", f"{root}/{job}-state", "--once", *more)

    stream("chunk", "--size", "3", "--flush")
    chunks = spark.read.parquet(f"{root}/chunk").where("full = 'true'").groupBy("symbol", "event_date").sum("n_messages").collect()
    assert {(r.event_date, r[2]) for r in chunks} == {("2025-05-02", 7), ("8/5", 1), ("2025-05-03", 1)}
    stream("total", "--feed", "trades")
    totals = {r.status: r.n_messages for r in spark.read.parquet(f"{root}/total").collect()}
    assert totals == {"accepted": 8, "bad date": 1}
    stream("stream-bars", "--window_size", "1 hour", "--delay", "1 hour")
    bars = spark.read.parquet(f"{root}/stream-bars").collect()
    assert [b.trade_count for b in bars if b.event_date is not None] == [7]
    stream("land", "--feed", "trades")
    run(
        *("redrive", "--input_path", f"{root}/land", "--output_path", f"{root}/mended", "--once"),
        *("--checkpoint", f"{root}/redrive-state", "--feed", "trades"),
        *("--repair", "replace(value, '8/5', '2025-05-08')"),
    )
    run("publish", "--input_path", f"{root}/mended", "--output_path", f"{root}/records")
    record = spark.read.json(f"{root}/records").first()
    assert record.key == "A" and json.loads(record.value)["event_date"] == "2025-05-02"
    run("watch", "--input_path", f"{root}/day", "--once")


def test_arguments():
    args = parse(
        "features --input_path a --output_path b --require_symbols --event_date 2025-05-02".split()
    )
    assert args.require_symbols == SYMBOLS
    for wrong in (
        "latest-recos --input_path a --output_path b",
        "land --output_path b --checkpoint c",
        "features --input_path a --output_path b --require_symbols A",
        "features --input_path a --output_path b --labels_path c --symbol A",
        "publish --input_path a",
        "redrive --output_path b --checkpoint c --repair value",
    ):
        with pytest.raises(SystemExit):
            parse(wrong.split())
