"""Message streams: a broker topic, or a folder of JSON-lines files.

Both give a DataFrame with a text column ``value``, so everything after them is
the same code.
"""

from pyspark.sql import DataFrame, SparkSession

from tickforge.schemas import RECORD


def topic_stream(
    spark: SparkSession,
    brokers: str,
    topic: str,
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> DataFrame:
    """Kafka topic from its earliest record; afterwards from the checkpoint.

    ``min_partitions`` splits large topic partitions over more tasks. Needs the
    Spark Kafka connector on the class path.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    if min_partitions:
        reader = reader.option("minPartitions", min_partitions)
    return topic_records(reader.load())


def topic_records(loaded: DataFrame) -> DataFrame:
    """Key and value as text, with the topic, partition, offset and broker time that give
    the order of arrival."""
    return loaded.selectExpr(
        "cast(key as string) as key", "cast(value as string) as value",
        "topic", "partition", "offset", "unix_micros(timestamp) as broker_micros",
    )


def record_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """New files of topic records that were saved as JSON lines, positions included."""
    reader = spark.readStream.schema(RECORD)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def folder_stream(
    spark: SparkSession, path: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """New files of a folder, one message per line."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)
