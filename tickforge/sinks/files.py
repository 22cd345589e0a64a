"""Partition-safe table writes and JSON export."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions.codec import TIMESTAMP_FORMAT
from tickforge.schemas import KEYS



def write_table(df: DataFrame, root: str, keys=KEYS, rebalance: bool = True) -> None:
    """Replace exactly the partitions present in ``df``; all others stay.

    ``rebalance`` gathers each partition's rows into few files. Unlike a plain
    repartition by key it is adaptive: a partition larger than the advisory size is
    split over several tasks. Leave it off when rows already come out of a shuffle
    on the same keys.
    """
    if rebalance:
        df = df.hint("rebalance", *keys)
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(root)
    )


def export_json_lines(df: DataFrame, path: str, keys=()) -> None:
    """One JSON record per row, NULL fields written, microseconds kept.

    With ``keys`` the export lies in folders ``part_<key>=...`` and only the folders present
    in ``df`` are replaced; records keep their keys. Without, the whole export is replaced.
    """
    parts = {f"part_{key}": F.col(key) for key in keys}
    writer = df.withColumns(parts).hint("rebalance", *parts).write if keys else df.write
    if keys:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*parts)
    (
        writer.mode("overwrite")
        .option("ignoreNullFields", "false")
        .option("timestampFormat", TIMESTAMP_FORMAT)
        .json(path)
    )


def write_json_arrays(chunks: DataFrame, path: str) -> None:
    """Message chunks to files of one JSON array each, by key; ``read_json_arrays`` reads them."""
    writer = chunks.select(*KEYS, "messages").write.mode("append").partitionBy(*KEYS)
    # One text column as it is, in files whose names end in .json.
    plain = {"extension": "json", "sep": "\u0001", "quote": "", "maxRecordsPerFile": "1"}
    writer.options(**plain).csv(path)


def write_topic(records: DataFrame, brokers: str, topic: str) -> None:
    """Key/value records to a Kafka topic; needs the Spark Kafka connector."""
    (
        records.write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .save()
    )


def show_rows(df: DataFrame, n: int = 5, truncate: bool = True) -> None:
    """Console preview; an extra job, so only for debugging."""
    df.show(n, truncate)
