"""Continuous landing of a message stream into the raw zone.

One query per topic. Every message is written once, as it came, under
``feed=<feed>/symbol=<symbol>/event_date=<day>``; refused ones go under
``feed=rejected`` with their reason, next to the others and in the same commit.
Spark's file sink and checkpoint make this exactly-once across restarts, and each
trigger commits all it read, so no tail waits for a full buffer.

Messages from a topic keep their position (topic, partition, offset and the broker's time
in microseconds), which alone gives their order of arrival and tells repeats apart.
``redrive_query`` takes refused messages up again once it is known how to mend them.
"""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StringType, StructField, StructType

from tickforge.functions.codec import decode, json_text
from tickforge.operators.messages import classify, once_per_position, read_envelopes
from tickforge.schemas import NEWS_MESSAGE, POSITION, RECO_MESSAGE, TRADE_MESSAGE
from tickforge.streaming.steps import Steps

REJECTED = "rejected"
FOLDERS = ["feed", "symbol", "event_date"]

#: Opening a file costs more than filling it, so a small trigger with many folders
#: is spread over more tasks than its bytes alone would ask for.
LANDING_CONF = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB"}
MESSAGE_SCHEMAS = {"trades": TRADE_MESSAGE, "recos": RECO_MESSAGE, "news": NEWS_MESSAGE}
_LANDED = StructType(
    [
        StructField(name, StringType(), True)
        for name in ("value", "reason", "feed", "symbol", "event_date")
    ]
    + POSITION.fields
)


def routed(records: DataFrame, feed: str | None = None) -> DataFrame:
    """value, reason, the three folder columns, and the position if the records have one;
    works on streams and batches."""
    at = [name for name in POSITION.names if name in records.columns]
    classified = classify(read_envelopes(records, at), feed)
    ok = F.col("reason").isNull()
    return classified.select(
        json_text("value").alias("value"),
        "reason",
        F.when(ok, F.col("feed")).otherwise(REJECTED).alias("feed"),
        # Refused messages share one folder, whatever their keys contain.
        F.when(ok, F.col("symbol")).alias("symbol"),
        F.when(ok, F.col("event_date")).alias("event_date"),
        *at,
    )


def landing_query(
    records: DataFrame,
    root: str,
    checkpoint: str,
    feed: str | None = None,
    records_per_file: int | None = None,
) -> DataStreamWriter:
    """The configured writer; choose a trigger and start it.

    Rows are gathered by folder before the write, so that many tasks do not each open a
    file in every folder; the gathering is adaptive, splits a hot symbol over several tasks
    and so sizes the files. ``records_per_file`` bounds them further, if given.
    The observed metric ``messages`` counts accepted and refused messages of every
    trigger. A lost checkpoint needs a new ``root``, too: batches would be numbered from 0
    again, and the sink passes over numbers that its log holds. Read both roots together,
    with positions, and what was landed twice comes once.
    """
    spark = records.sparkSession
    if _exists(spark, f"{root}/_spark_metadata") and not _exists(spark, f"{checkpoint}/metadata"):
        raise ValueError(f"{root} was written with another checkpoint; land into a new folder")
    watched = routed(records, feed).observe(
        "messages",
        F.count(F.lit(1)).alias("received"),
        F.count("reason").alias("rejected"),
    )
    writer = (
        watched.hint("rebalance", *FOLDERS)
        .writeStream.format("json")
        .outputMode("append")
        .partitionBy(*FOLDERS)
        .option("path", root)
        .option("checkpointLocation", checkpoint)
    )
    return writer.option("maxRecordsPerFile", records_per_file) if records_per_file else writer


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def console_query(records: DataFrame, rows: int = 20) -> DataStreamWriter:
    """Print the first rows of every trigger; for debugging."""
    return records.writeStream.format("console").option("numRows", rows).option("truncate", False)


def landed_text(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """Landed messages as they came: value, reason, the position and the folder columns.

    Only files of committed triggers are seen. ``root`` may be several folders.
    """
    roots = [root] if isinstance(root, str) else root
    return reduce(DataFrame.union, [_landed(spark, one) for one in roots])


def _landed(spark: SparkSession, root: str) -> DataFrame:
    if _exists(spark, f"{root}/_markers"):
        return Steps(spark, root, "json").read(_LANDED).select(*_LANDED.names)
    return spark.read.schema(_LANDED).json(root).select(*_LANDED.names)


def _landed_part(spark, root, feed, symbol, event_date, until) -> DataFrame:
    """Landed text of one feed; conditions on folders, so that the others are not read."""
    landed = landed_text(spark, root).where(F.col("feed") == feed)
    if symbol is not None:
        landed = landed.where(F.col("symbol") == symbol)
    if event_date is not None:
        landed = landed.where(F.col("event_date") == event_date)
    if until is not None:
        landed = landed.where(F.col("event_date") <= until)
    return landed


def read_landed(
    spark: SparkSession, root: str | list[str], feed: str, symbol=None, event_date=None, until=None,
    positions: bool = False,
) -> DataFrame:
    """Decoded messages of one feed, optionally one symbol, one day, or all days up to one.

    All of these are folders: what is not asked for is neither read nor parsed. With
    ``positions`` the position follows, and a position that was landed twice gives one row.
    """
    landed = _landed_part(spark, root, feed, symbol, event_date, until)
    if not positions:
        return landed.select(decode("value", MESSAGE_SCHEMAS[feed]))
    landed = once_per_position(landed.select("value", *POSITION.names))
    return landed.select(*POSITION.names, decode("value", MESSAGE_SCHEMAS[feed])).select(
        *MESSAGE_SCHEMAS[feed].names, *POSITION.names
    )


def read_misfits(
    spark: SparkSession, root: str | list[str], feed: str, symbol=None, event_date=None, until=None
) -> DataFrame:
    """Landed messages with a field of another type than the feed has: value, reason.

    ``read_landed`` gives them with NULL in such fields.
    """
    landed = _landed_part(spark, root, feed, symbol, event_date, until)
    checked = landed.select("value", decode("value", MESSAGE_SCHEMAS[feed], "_bad"))
    return checked.where("_bad is not null").select("value", F.lit("bad field").alias("reason"))


def read_rejected(spark: SparkSession, root: str) -> DataFrame:
    """Refused messages with their reason."""
    return landed_text(spark, root).where(F.col("feed") == REJECTED).select("value", "reason")


def landing_steps(
    records: DataFrame, root: str, checkpoint: str, feed: str | None = None, gather_after: int = 100
) -> DataStreamWriter:
    """``landing_query`` for streams that run for months: the same rows, files gathered.

    A trigger is one step of the table below ``root``. Every ``gather_after`` of them are
    written again as one, with each folder's rows together, and so are as many gathered
    ones: files and log grow with the data, not with the number of triggers. Readers are
    those of ``landing_query``, and see a step whole or not at all.
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        steps = Steps(batch.sparkSession, root, "json")
        step, done = steps.last
        if done < batch_id:
            rows = routed(batch, feed).hint("rebalance", *FOLDERS)
            rows.write.mode("overwrite").partitionBy(*FOLDERS).json(steps.path(step + 1))
            steps.commit(step + 1, batch_id)
        steps.gather(_LANDED, FOLDERS, gather_after)

    return records.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)


def redrive_query(
    spark: SparkSession,
    rejects_root: str,
    root: str,
    checkpoint: str,
    repair: Callable[[Column], Column],
    feed: str | None = None,
) -> DataStreamWriter:
    """Land the refused messages of ``rejects_root`` again in ``root``, mended by ``repair``.

    ``repair`` is an expression over the text of a message, for example one that turns
    another way of writing a day into a date. A checkpoint for each repair makes every
    refused message come once, also those refused after its first run; what is refused again
    lies under ``root`` with its new reason, so a next repair can start from there. ``root``
    is another folder than ``rejects_root``, since a folder has one writer.
    """
    landed = spark.readStream.schema(_LANDED).json(rejects_root)
    refused = landed.where(F.col("feed") == REJECTED)
    mended = refused.select(repair(F.col("value")).alias("value"), *POSITION.names)
    return landing_query(mended, root, checkpoint, feed)
