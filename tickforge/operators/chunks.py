"""Grouping keyed messages into fixed-size arrays, and newest value per key."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.codec import FAITHFUL
from tickforge.operators.slices import TARGET_ROWS, number_rows
from tickforge.schemas import KEYS

# Fixed value: messages per landed array of trades (the other feeds use 1).
TRADES_PER_CHUNK = 1000


def message_chunks(
    messages: DataFrame,
    order_by,
    size: int = TRADES_PER_CHUNK,
    keys=KEYS,
    target_rows: int = TARGET_ROWS,
) -> DataFrame:
    """Arrays of up to ``size`` messages per key, in arrival order.

    Gives the keys, ``chunk`` (0-based), ``n_messages``, the first and last value of
    the leading order column, and ``messages``, a JSON array. The last, short chunk
    of a key is given too. Numbering splits hot keys, and a chunk never holds more
    than ``size`` messages.
    """
    keys, order_by = list(keys), list(order_by)
    body = [F.col(name) for name in messages.columns if name != "_number"]
    numbered = number_rows(messages, keys, order_by, "_number", target_rows)
    item = F.struct(F.col("_number"), F.struct(*body).alias("message"))
    in_order = F.array_sort(F.collect_list(item))
    array_text = F.to_json(F.transform(in_order, lambda x: x["message"]), FAITHFUL)
    return (
        numbered.withColumn("chunk", F.floor((F.col("_number") - 1) / size))
        .groupBy(*keys, "chunk")
        .agg(
            F.count("*").alias("n_messages"),
            F.min(order_by[0]).alias("first_order"),
            F.max(order_by[0]).alias("last_order"),
            array_text.alias("messages"),
        )
    )


def latest_per_key(messages: DataFrame, key: str, order_by) -> DataFrame:
    """The newest record of each key, as a compacted topic would keep.

    Trades are append-only and must not be passed through this.
    """
    newest_first = Window.partitionBy(key).orderBy(*[F.desc(c) for c in order_by])
    return (
        messages.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def latest_by_position(messages: DataFrame, key: str) -> DataFrame:
    """The record of each key that arrived last, as a compacted topic would keep.

    Within a partition of a topic the larger offset came later, whatever the messages' own
    times say. A key that lies in several partitions keeps the one the broker took last. The
    first aggregate is by key and partition, so little is left to compare across partitions;
    both are combined before they are shuffled. NULL keys are no key.
    """
    row = F.struct(*[F.col(f"`{name}`") for name in messages.columns])
    by_partition = (
        messages.where(F.col(key).isNotNull())
        .groupBy(key, "topic", "partition")
        .agg(F.max_by(row, "offset").alias("row"))
    )
    last = F.struct("row.broker_micros", "topic", "partition")
    return by_partition.groupBy(key).agg(F.max_by("row", last).alias("row")).select("row.*")
