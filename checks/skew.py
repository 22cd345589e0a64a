"""Skew trial: ``python -m checks.skew [copies]``.

Copies the sf0.1 trades many times and moves a third of all rows to one symbol and
day, then times the ordered operators with and without splitting that key, and
checks that both give the same rows.
"""

import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import adapters as given
from tickforge.operators.bars import price_bars
from tickforge.operators.chunks import message_chunks
from tickforge.operators.rolling import rolling_features
from tickforge.operators.slices import number_rows
from tickforge.plans.features import trade_features
from tickforge.schemas import KEYS
from tickforge.session import stage

WHOLE = 2**62  # a target no key exceeds: nothing is split


def skewed_trades(spark: SparkSession, sf_dir: str, copies: int) -> DataFrame:
    trades = given.trades(spark, sf_dir).repartition(32)
    many = trades.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    many = many.withColumn("hot", F.col("id") % 3 == 0)
    hot = F.col("hot")
    # The hot day keeps the original spread of times, folded into one day.
    clock = F.unix_micros("timestamp_parsed") % 86_400_000_000
    moved = F.timestamp_micros(F.lit(1_704_844_800_000_000) + clock)
    shift = F.make_dt_interval(secs=F.col("copy") * 0.013)
    return (
        many.withColumn("timestamp_parsed", F.when(hot, moved).otherwise(F.col("timestamp_parsed")))
        .withColumn("timestamp_parsed", F.col("timestamp_parsed") + shift)
        .withColumn("id", F.col("id") * copies + F.col("copy"))
        .withColumn("symbol", F.when(hot, "S0").otherwise(F.concat("symbol", F.col("copy") % 100)))
        .withColumn("event_date", F.to_date("timestamp_parsed"))
        .drop("copy", "hot")
    )


def timed(name: str, df: DataFrame) -> None:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    print(f"{name:28s} {time.perf_counter() - start:7.1f} s", flush=True)


def fingerprint(df: DataFrame):
    row = F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)")
    return df.agg(F.count("*"), F.sum(row)).first()


def main(copies: str = "100") -> None:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    trades = stage(skewed_trades(spark, "/root/testdata/sf0.1", int(copies)), "skew")
    sizes = trades.groupBy(*KEYS).count().agg(F.max("count"), F.sum("count")).first()
    print(f"largest key {sizes[0]:,} of {sizes[1]:,} rows")
    narrow = trades.select(*KEYS, "id", "price", "size", "timestamp_parsed")
    split = 250_000
    timed("(warm-up)", rolling_features(narrow, split))
    for name, target in (("whole keys", WHOLE), ("split keys", split)):
        timed(f"rolling, {name}", rolling_features(narrow, target))
        timed(f"row numbers, {name}", number_rows(narrow, KEYS, ["id"], "n", target))
    timed("trade features, split keys", trade_features(trades, target_rows=split))
    timed("chunks of 1000, split keys", message_chunks(narrow, ["id"], target_rows=split))
    timed("one-minute bars", price_bars(trades))
    for make in (rolling_features, lambda df, t: number_rows(df, KEYS, ["id"], "n", t)):
        same = fingerprint(make(narrow, WHOLE)) == fingerprint(make(narrow, split))
        print("same rows" if same else "DIFFERENT ROWS", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])
