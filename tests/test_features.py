import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickforge.functions import clock
from tickforge.functions.columns import array_flag
from tickforge.operators import labels, rolling, slices
from tickforge.plans.features import feature_columns, trade_features, typed_trades
from tickforge.schemas import FEATURE_COLUMNS, KEYS, ORDER_COLUMNS, TRADE_MESSAGE


def test_time_parts_and_epoch(spark):
    df = spark.createDataFrame([("2025-05-04T13:30:59.987654+02:00",)], "t string")
    row = (
        df.select(clock.parse_timestamp("t").alias("ts"))
        .select(*[c.alias(n) for n, c in clock.time_parts("ts").items()])
        .first()
    )
    assert row.asDict() == {
        "hour": 11,
        "minute": 30,
        "second": 59,
        "day_of_week": 1,  # a Sunday
        "timestamp_epoch": 1746358259,
    }


def test_unreadable_timestamp_is_null(spark):
    df = spark.createDataFrame([("yesterday",)], "t string")
    assert df.select(clock.parse_timestamp("t").alias("t")).first().t is None


def test_condition_flags_keep_null(spark):
    df = spark.createDataFrame([(["@", "I"],), ([],), (None,)], "c array<string>")
    got = [tuple(r) for r in df.select(array_flag("c", "I"), array_flag("c", "T")).collect()]
    assert got == [(1, 0), (0, 0), (None, None)]


def test_frame_is_eleven_rows_and_first_std_is_null(make_trades):
    trades = make_trades(*[{"price": p, "size": p} for p in range(1, 13)])
    rows = rolling.rolling_features(trades).orderBy("id").collect()
    assert rows[0].rolling_std_price is None
    assert rows[0].rolling_avg_price == 1.0
    assert rows[11].rolling_avg_price == statistics.mean(range(2, 13))
    assert rows[11].rolling_std_price == pytest.approx(statistics.stdev(range(2, 13)))
    assert rows[11].cumulative_volume == sum(range(2, 13))


def test_ties_in_time_are_ordered_by_id(make_trades):
    same = "2025-05-02T14:00:00"
    trades = make_trades(
        {"ts": same, "id": 2, "price": 20.0}, {"ts": same, "id": 1, "price": 10.0}
    )
    got = {r.id: r.rolling_avg_price for r in rolling.rolling_features(trades).collect()}
    assert got == {1: 10.0, 2: 15.0}


def _random_trades(make_trades, seed, spread, hot):
    rng = random.Random(seed)
    start = dt.datetime(2025, 5, 2, 13, 30)
    rows = []
    for number in range(400):
        symbol = hot if number % 3 else rng.choice(["A", "B"])
        ts = start + dt.timedelta(seconds=rng.choice(spread))
        rows.append(
            {"symbol": symbol, "ts": ts.isoformat(), "price": rng.random(), "size": number}
        )
    return make_trades(*rows)


@pytest.mark.parametrize(
    "target, spread, hot",
    [
        (3, range(20_000), "HOT"),
        (17, range(20_000), "HOT"),
        (17, [0, 1, 19_999], "HOT"),
        (17, [5], "HOT"),
        (17, [*range(50), 20_000], "HOT"),
        (100, [*range(50), 20_000], "HOT"),
        (17, range(20_000), None),
    ],
    ids=["tiny slices", "even", "clumped", "one instant", "burst", "large slices", "NULL key"],
)
def test_hot_keys_cut_into_slices_give_the_same_rows(make_trades, target, spread, hot):
    trades = _random_trades(make_trades, target, list(spread), hot)
    points = slices.split_points(trades, KEYS, ORDER_COLUMNS, target)
    cut_up = slices.with_slices(trades, points, KEYS, ORDER_COLUMNS).where(
        F.col("symbol").eqNullSafe(F.lit(hot))
    )
    per_slice = [r["count"] for r in cut_up.groupBy(slices.SLICE).count().collect()]
    assert len(per_slice) > 1 and max(per_slice) <= 2 * target
    whole = rolling.rolling_features(trades).orderBy("id").collect()
    cut = rolling.rolling_features(trades, target_rows=target).orderBy("id").collect()
    assert cut == whole


@pytest.mark.parametrize("instant", [5, None], ids=["one instant", "NULL"])
def test_no_slice_of_a_burst_exceeds_twice_the_target(spark, instant):
    rows = [("A", "2025-05-02", n if n < 10 else instant, n * 7919 % 1000) for n in range(1000)]
    data = spark.createDataFrame(rows, "symbol string, event_date string, t bigint, id bigint")
    points = slices.split_points(data, KEYS, ["t", "id"], 50)
    cut = slices.with_slices(data, points, KEYS, ["t", "id"])
    per_slice = [r["count"] for r in cut.groupBy(slices.SLICE).count().collect()]
    assert max(per_slice) <= 100
    numbered = slices.number_rows(data, KEYS, ["t", "id"], "n", target_rows=50)
    order = sorted(rows, key=lambda r: (r[2] is not None, r[2] or 0, r[3]))
    got = [(r.t, r.id) for r in numbered.orderBy("n").collect()]
    assert got == [r[2:] for r in order]


def test_codes_by_frequency_then_label(make_trades):
    trades = make_trades(
        {"exchange": "Q"}, {"exchange": "P"}, {"exchange": "Z"}, {"exchange": "Z"}
    )
    index = labels.fit_labels(trades, ["exchange"])
    got = {r.label: r.label_index for r in index.table.collect()}
    assert got == {"Z": 0.0, "P": 1.0, "Q": 2.0}


def test_many_labels_are_ranked_in_slices(make_trades):
    trades = make_trades(*[{"exchange": e} for e in "QPZZYXWVVV"])
    whole = labels.fit_labels(trades, ["exchange", "tape"])
    cut = labels.fit_labels(trades, ["exchange", "tape"], target_rows=2)
    assert sorted(whole.table.collect()) == sorted(cut.table.collect())
    columns = {"exchange": "exchange_index", "tape": "tape_index"}
    applied = [labels.apply_labels(trades, index, columns) for index in (whole, cut)]
    assert sorted(applied[0].collect()) == sorted(applied[1].collect())


def _shuffles(df, column):
    """Exchanges in the initial plan whose keys hold the column."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    return [line for line in lines if f"{column}#" in line.split("),")[0]]


def test_trades_are_shuffled_once_and_never_by_label(spark, make_trades, tmp_path):
    make_trades(*[{"exchange": "QV"[n % 2], "id": n} for n in range(50)]).write.parquet(str(tmp_path / "t"))
    trades = spark.read.parquet(str(tmp_path / "t"))
    index = labels.fit_labels(trades, ["exchange"])
    coded = labels.apply_labels(trades, index, {"exchange": "code"})
    assert not _shuffles(coded, "exchange") and not _shuffles(coded, "label")
    table = trade_features(trades)
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert not _shuffles(table, "exchange") and not _shuffles(table, "tape")
    # Codes are ranked from their counts; trades are exchanged by symbol and day.
    assert len(_shuffles(table, "symbol")) == 1 and plan.count("FileScan") == 3
    cut = trade_features(trades, target_rows=10)
    assert not _shuffles(cut, "exchange") and len(_shuffles(cut, "_slice")) == 2


def test_saved_counts_are_refitted_by_day(spark, make_trades, tmp_path):
    days = [f"2025-05-0{d}T10:00:00" for d in (1, 2, 3)]
    parts = [make_trades(*[{"ts": ts, "exchange": e} for e in x]) for ts, x in zip(days, ("QQPP", "PZ", "Z"))]
    root = str(tmp_path / "labels")
    for part in parts[:2]:
        labels.save_label_counts(part, root, ["exchange"])
    codes = lambda **k: {r.label: r.label_index for r in labels.saved_labels(spark, root, **k).table.collect()}
    assert codes() == {"P": 0.0, "Q": 1.0, "Z": 2.0}
    labels.save_label_counts(parts[2].union(parts[2]), root, ["exchange"])
    labels.save_label_counts(parts[1], root, ["exchange"])  # a day that comes again counts once
    assert codes() == {"P": 0.0, "Z": 1.0, "Q": 2.0}
    assert codes(until="2025-05-02") == {"P": 0.0, "Q": 1.0, "Z": 2.0}


def test_codes_match_sparks_own_indexer(spark, make_trades):
    from pyspark.ml.feature import StringIndexer

    rng = random.Random(5)
    trades = make_trades(*[{"exchange": rng.choice("ABCDEFG")} for _ in range(60)])
    model = StringIndexer(inputCol="exchange", outputCol="theirs").fit(trades)
    index = labels.fit_labels(trades, ["exchange"])
    both = labels.apply_labels(model.transform(trades), index, {"exchange": "ours"})
    assert both.where("ours <> theirs").count() == 0


def test_codes_per_day(make_trades):
    trades = make_trades(
        {"symbol": "A", "exchange": "Q"},
        {"symbol": "B", "exchange": "P"},
        {"symbol": "B", "exchange": "P"},
    )
    index = labels.fit_labels(trades, ["exchange"], scope=KEYS)
    coded = labels.apply_labels(trades, index, {"exchange": "code"})
    assert {r.code for r in coded.collect()} == {0.0}


def test_null_label_fails_or_is_kept(make_trades):
    trades = make_trades({"exchange": None}, {"exchange": "Q"})
    index = labels.fit_labels(trades, ["exchange"])
    with pytest.raises(Exception, match="exchange is NULL"):
        labels.apply_labels(trades, index, {"exchange": "code"}).collect()
    kept = labels.apply_labels(trades, index, {"exchange": "code"}, on_null="keep")
    assert sorted((r.exchange or "", r.code) for r in kept.collect()) == [("", None), ("Q", 0.0)]


def test_feature_table_from_raw_messages(spark):
    raw = spark.createDataFrame(
        [
            ("AAPL", 10.0, 5.0, "V", ["@", "T"], "C", 1, "2025-05-02T13:30:00.5+00:00", "2025-05-02"),
            ("AAPL", 12.0, 5.0, "Q", None, "C", 2, "2025-05-02T13:30:01+00:00", "2025-05-02"),
        ],
        TRADE_MESSAGE,
    )
    table = trade_features(typed_trades(raw))
    assert table.columns == [*FEATURE_COLUMNS, "timestamp_parsed", "id"]
    first, second = feature_columns(table).orderBy("timestamp_epoch").collect()
    assert first.asDict() == {
        "symbol": "AAPL",
        "event_date": dt.date(2025, 5, 2),
        "price": 10.0,
        "size": 5.0,
        "exchange_index": 1.0,
        "tape_index": 0.0,
        "condition_at": 1,
        "condition_i": 0,
        "condition_t": 1,
        "hour": 13,
        "minute": 30,
        "second": 0,
        "day_of_week": 6,
        "timestamp_epoch": 1746192600,
        "rolling_avg_price": 10.0,
        "rolling_std_price": None,
        "cumulative_volume": 5.0,
    }
    assert second.condition_at is None and second.cumulative_volume == 10.0


@pytest.mark.parametrize("target", [15, 2_000_000])
def test_increments_equal_the_whole_day(spark, make_trades, target):
    trades = _random_trades(make_trades, 21, range(900), "HOT")
    whole = rolling.rolling_features(trades).orderBy("id").collect()
    order = trades.withColumn("n", F.ntile(4).over(Window.orderBy(*ORDER_COLUMNS)))
    last, got = rolling.last_trades(trades.limit(0)), []
    for part in range(1, 5):
        new = order.where(F.col("n") == part).drop("n")
        assert rolling.overtaken_keys(new, last).count() == 0
        rolled, following = rolling.rolling_increment(new, last, target)
        got += rolled.select(whole[0].__fields__).collect()
        last = spark.createDataFrame(following.collect(), following.schema)
    assert sorted(got, key=lambda r: r.id) == whole
    assert {r["count"] for r in last.groupBy(*KEYS).count().collect()} <= set(range(1, 11))
    early = trades.limit(1).withColumn("timestamp_parsed", F.lit(None).cast("timestamp"))
    assert rolling.overtaken_keys(early, last).count() == 1


def test_without_hot_keys_there_is_one_exchange(make_trades):
    plan = rolling.rolling_features(make_trades({}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    numbered = slices.number_rows(make_trades({}), KEYS, ORDER_COLUMNS, "n")
    assert numbered._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_rolling_columns_share_one_window(make_trades):
    trades = make_trades(*[{"id": n} for n in range(30)])
    plan = rolling.rolling_features(trades, 10).select(F.col("rolling_avg_price"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    # Trades themselves are exchanged only once.
    assert text.count("_borrowed") > 0
    assert "BroadcastHashJoin" in text and "NestedLoop" not in text
    main = [line for line in text.splitlines() if "Exchange hashpartitioning" in line]
    assert sum("_slice" in line for line in main) == 2  # trades, and the borrowed rows' tails
