"""Arrays of a fixed number of messages per key, filled across triggers.

A key rarely has a full array's messages in one trigger. What is left over waits in the table
itself, one short array for each key, and is taken up by the next trigger, before the new
messages. Every trigger is one step of the table: full arrays, which stay, and waiting ones,
which the following step replaces. A waiting array that has waited for long enough leaves as
it is. State is bounded by keys times the size of an array, lies in the table, and survives
restarts and lost executors; no message is lost or doubled, since a step is seen whole.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import ArrayType, BooleanType, LongType, StructField, StructType

from tickforge.functions.codec import FAITHFUL
from tickforge.operators.chunks import TRADES_PER_CHUNK
from tickforge.operators.slices import TARGET_ROWS, number_rows
from tickforge.schemas import KEYS
from tickforge.streaming.steps import Steps

_ARRIVED, _SINCE = "_arrived", "_since"


def _table_schema(messages: StructType, keys) -> StructType:
    stamps = [StructField(_ARRIVED, LongType()), StructField(_SINCE, LongType())]
    item = StructType([*stamps, *messages.fields])
    whole = [StructField(name, LongType()) for name in ("chunk", "n_messages")]
    return StructType(
        [
            *[messages[key] for key in keys],
            *whole,
            StructField("messages", ArrayType(item)),
            StructField("step", LongType()),
            StructField("full", BooleanType()),
        ]
    )


def chunk_query(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    order_by,
    size: int = TRADES_PER_CHUNK,
    wait: str = "10 minutes",
    keys=KEYS,
    target_rows: int = TARGET_ROWS,
) -> DataStreamWriter:
    """The configured writer; choose a trigger and start it.

    Messages of one trigger are put in the order of ``order_by`` (its first column is a
    number or a time) behind those that wait. A short array leaves with the first trigger
    that finds its oldest message ``wait`` old; ``flush_chunks`` lets it go when no trigger
    comes any more. A hot key is numbered in slices, so an array is all one task holds.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        steps = Steps(batch.sparkSession, root)
        if steps.last[1] < batch_id:
            _advance(steps, batch, batch_id, list(order_by), size, wait, list(keys), target_rows)

    return messages.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)


def flush_chunks(
    spark: SparkSession, root: str, messages: StructType, order_by, wait: str = "0 seconds",
    size: int = TRADES_PER_CHUNK, keys=KEYS,
) -> None:
    """Let waiting arrays go whose oldest message is ``wait`` old. Not beside a running query."""
    steps = Steps(spark, root)
    if steps.last[0] >= 0:
        none = spark.createDataFrame([], messages)
        order_by = list(order_by)
        _advance(steps, none, steps.last[1], order_by, size, wait, list(keys), TARGET_ROWS)


def _advance(steps, new, batch_id, order_by, size, wait, keys, target_rows) -> None:
    spark, columns = new.sparkSession, new.columns
    now = F.unix_micros(F.current_timestamp())
    step = steps.last[0] + 1
    arriving = new.withColumn(_ARRIVED, F.lit(step).cast("long")).withColumn(_SINCE, now)
    before = [step - 1] if step else []
    waiting = steps.read(_table_schema(new.schema, keys), before).where("not full")
    held = waiting.select(F.explode("messages").alias("m")).select("m.*")
    rows = held.unionByName(arriving).persist()
    try:
        numbered = number_rows(rows, keys, [_ARRIVED, *order_by], "_number", target_rows)
        item = F.struct("_number", F.struct(_ARRIVED, _SINCE, *columns).alias("m"))
        made = (
            numbered.withColumn("chunk", F.floor((F.col("_number") - 1) / size))
            .groupBy(*keys, "chunk")
            .agg(
                F.count("*").alias("n_messages"),
                F.min(_SINCE).alias(_SINCE),
                F.transform(F.array_sort(F.collect_list(item)), lambda x: x["m"]).alias("messages"),
            )
        )
        old = F.col(_SINCE) <= F.unix_micros(F.current_timestamp() - F.expr(f"interval {wait}"))
        marked = made.withColumn("full", (F.col("n_messages") == size) | old).drop(_SINCE)
        marked.write.mode("overwrite").partitionBy("full").parquet(steps.path(step))
    finally:
        rows.unpersist()
    steps.commit(step, batch_id)
    # Taken up by the step that has just become visible.
    steps.delete(f"{steps.path(step - 1)}/full=false")


def read_chunks(spark: SparkSession, root: str, messages: StructType, keys=KEYS) -> DataFrame:
    """Arrays that are full or have waited long enough: the keys, step, chunk (within a step),
    n_messages, and messages as a JSON array. In the order of step and chunk they hold every
    message of a key once, in order of arrival."""
    table = Steps(spark, root).read(_table_schema(messages, keys)).where("full")
    plain = F.transform("messages", lambda m: F.struct(*[m[c].alias(c) for c in messages.names]))
    return table.select(
        *keys, "step", "chunk", "n_messages", F.to_json(plain, FAITHFUL).alias("messages")
    )


def waiting_messages(spark: SparkSession, root: str, messages: StructType, keys=KEYS) -> DataFrame:
    """Messages that wait for more of their key, in the keys' and their own columns."""
    steps = Steps(spark, root)
    newest = [step for step in (steps.last[0],) if step >= 0]
    table = steps.read(_table_schema(messages, keys), newest)
    items = table.where("not full").select(F.explode("messages").alias("m"))
    return items.select(*[F.col(f"m.{c}").alias(c) for c in messages.names])
