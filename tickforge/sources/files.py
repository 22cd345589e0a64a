"""JSON files and partitioned parquet tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from tickforge.operators.filters import partition_filter
from tickforge.schemas import KEYS
from tickforge.session import session_conf, stage

#: Parquet as a source that counts rows by partition from footers; folder names as text.
_FOOTERS = {
    "spark.sql.sources.useV1SourceList": "",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}
_KEYS_ONLY = StructType([StructField("symbol", StringType()), StructField("event_date", DateType())])


def read_json_arrays(
    spark: SparkSession,
    path: str,
    schema: StructType,
    symbol: str | None = None,
    event_date: str | None = None,
) -> DataFrame:
    """Files holding one JSON array each, one row per element.

    Every ``*.json`` below ``path`` is read, whatever the folder layout; keys come from the
    records. With ``symbol`` or ``event_date`` only folders ``symbol=.../event_date=...`` of
    that part are listed and read; a part that is not there is an empty table. A layout
    without such folders is read whole, and the caller filters. A file is one task, so
    writers should keep arrays small.
    """
    if symbol is not None or event_date is not None:
        part = f"{path}/symbol={symbol or '*'}/event_date={event_date or '*'}"
        if _matches(spark, part):
            path = part
        elif _matches(spark, f"{path}/symbol=*"):
            return spark.createDataFrame([], schema)
    return (
        spark.read.schema(schema)
        .option("multiline", "true")
        .option("pathGlobFilter", "*.json")
        .option("recursiveFileLookup", "true")
        .json(path)
    )


def _matches(spark: SparkSession, pattern: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return len(system.globStatus(folder) or []) > 0


def read_json_lines(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """One JSON record per line; splittable. Partition folders become columns."""
    return spark.read.schema(schema).json(path)


def read_table(
    spark: SparkSession,
    root: str,
    schema: StructType,
    symbol: str | None = None,
    event_date: str | None = None,
    until: str | None = None,
) -> DataFrame:
    """A table partitioned by symbol and event_date, optionally one part of it.

    Filters are on partition columns and prune folders. The schema is given, so an
    empty table reads as no rows and a numeric-looking symbol stays text.
    """
    table = spark.read.schema(schema).parquet(root)
    return partition_filter(table, symbol, event_date, until)


def table_inventory(spark: SparkSession, root: str) -> DataFrame:
    """symbol, event_date, n_rows and n_files of a partitioned table, without reading a row.

    Rows are counted by the reader from the footers of the files, files by listing; both in
    tasks. Partition folders keep their names as text.
    """
    with session_conf(spark, _FOOTERS):
        rows, files = footer_counts(spark, root), _file_counts(spark, root)
        return stage(rows.join(files, KEYS), "inventory")


def footer_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows by symbol and day; from footers while the settings of ``_FOOTERS`` hold."""
    footers = spark.read.schema(_KEYS_ONLY).parquet(root)
    return footers.groupBy(*KEYS).agg(F.count("*").alias("n_rows"))


def _file_counts(spark: SparkSession, root: str) -> DataFrame:
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(root)
    files = listed.groupBy(*KEYS).agg(F.count("*").alias("n_files"))
    return files.withColumn("event_date", F.col("event_date").cast("date"))


def read_parquet_file(spark: SparkSession, path: str) -> DataFrame:
    """One parquet file or folder as it is, for inspection."""
    return spark.read.parquet(path)
