"""Completeness, profiles, counts and previews."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions.calendar import date_literal


def with_source_file(df: DataFrame) -> DataFrame:
    """Add ``source_file``; must be called directly on a file scan."""
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def _expected(df: DataFrame, symbols, event_date) -> DataFrame:
    """Every symbol on the day, or on every day found. ``symbols``: a list, or a DataFrame."""
    days = df.select("event_date").distinct()
    if event_date is not None:
        one = df.sparkSession.range(1)
        days = one.select(date_literal(event_date).alias("event_date"))
    if not isinstance(symbols, DataFrame):
        listed = F.array(*[F.lit(symbol) for symbol in symbols])
        return days.select(F.explode(listed).alias("symbol"), "event_date")
    # The symbols are one row, which every day meets.
    listed = symbols.groupBy(F.lit(1).alias("all")).agg(F.collect_set("symbol").alias("listed"))
    met = days.withColumn("all", F.lit(1)).join(listed, "all")
    return met.select(F.explode("listed").alias("symbol"), "event_date")


def completeness(df: DataFrame, symbols, event_date: str | None = None) -> DataFrame:
    """Rows (and files, if ``source_file`` is there) per expected symbol and day.

    Without a day, every day found in the data is checked for every symbol.
    """
    counts = [F.count("*").alias("n_rows")]
    if "source_file" in df.columns:
        counts.append(F.countDistinct("source_file").alias("n_files"))
    if event_date is not None:
        df = df.where(F.col("event_date") == date_literal(event_date))
    return completeness_of(df.groupBy("symbol", "event_date").agg(*counts), symbols, event_date)


def completeness_of(found: DataFrame, symbols, event_date: str | None = None) -> DataFrame:
    """``completeness`` from counts by symbol and day, such as ``table_inventory`` gives."""
    expected = _expected(found, symbols, event_date)
    return expected.join(found, ["symbol", "event_date"], "left").na.fill(
        0, [c for c in found.columns if c.startswith("n_")]
    )


def missing_symbols(df: DataFrame, symbols, event_date: str | None = None) -> DataFrame:
    """Expected (symbol, day) pairs with no data."""
    expected = _expected(df, symbols, event_date)
    present = df.select("symbol", "event_date").distinct()
    return expected.join(present, ["symbol", "event_date"], "left_anti")


def profile(df: DataFrame) -> DataFrame:
    """column_name, data_type and non-NULL count of every column, in one pass."""
    names = df.columns
    counted = df.agg(*[F.count(F.col(f"`{name}`")).alias(f"c{i}") for i, name in enumerate(names)])
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.lit(df.schema[name].dataType.simpleString()).alias("data_type"),
                F.col(f"c{i}").alias("non_null_count"),
            )
            for i, name in enumerate(names)
        ]
    )
    return counted.select(F.inline(rows))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-NULL value, most frequent first."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), column)
    )


def message_counts(classified: DataFrame) -> DataFrame:
    """Messages per type and outcome."""
    return classified.groupBy("type", F.coalesce("reason", F.lit("accepted")).alias("status")).agg(
        F.count("*").alias("n_messages")
    )


def preview(df: DataFrame, n: int = 5, order_by=()) -> DataFrame:
    """First ``n`` rows; with an order this is a top-n per task, then merged."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
