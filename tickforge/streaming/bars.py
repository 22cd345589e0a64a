"""Price bars over a stream, final when written.

Event time drives everything: the watermark trails the newest trade by ``delay``. A trade
older than the watermark is late; it changes no bar, and is counted. Trades repeated within
the delay, as topics deliver them, count once. A bar is written when the watermark passes its
end, once, so the table holds only final bars. State is what the delay spans: open bars, and
the keys of recent trades.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickforge.operators.bars import price_bars
from tickforge.schemas import BARS, KEYS

#: What makes two trades the same message.
IDENTITY = [*KEYS, "id", "timestamp_parsed", "price", "size"]


def bars_query(
    trades: DataFrame,
    root: str,
    checkpoint: str,
    window_size: str = "1 minute",
    delay: str = "10 minutes",
) -> DataStreamWriter:
    """The configured writer; choose a trigger and start it.

    Bars are those of ``price_bars`` over all trades that were not late. The last bars of a
    stream that falls silent stay open until a later trade moves the watermark.
    """
    fresh = trades.withWatermark("timestamp_parsed", delay).dropDuplicatesWithinWatermark(IDENTITY)
    return (
        price_bars(fresh, window_size)
        .writeStream.format("parquet")
        .outputMode("append")
        .partitionBy(*KEYS)
        .option("path", root)
        .option("checkpointLocation", checkpoint)
    )


def late_trades(query: StreamingQuery) -> int:
    """Late trades in the triggers whose progress the query still holds, a hundred by default."""
    states = [state for progress in query.recentProgress for state in progress["stateOperators"]]
    return sum(
        state["numRowsDroppedByWatermark"] for state in states if "dedupe" in state["operatorName"].lower()
    )


def read_bars(spark: SparkSession, root: str) -> DataFrame:
    """Final bars; only those of committed triggers are seen."""
    return spark.read.schema(BARS).parquet(root)
