"""Analyst recommendations: flattening and the two meanings of "latest"."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.functions.calendar import date_literal
from tickforge.schemas import RECO_COUNTS


def flatten_recos(messages: DataFrame, symbol: str | None = None) -> DataFrame:
    """Envelope to symbol, event_date (the period) and the five counts."""
    if symbol is not None:
        messages = messages.where(F.col("symbol") == symbol)
    return messages.select(
        "symbol",
        F.col("payload.period").try_cast("date").alias("event_date"),
        *[F.col(f"payload.{name}").alias(name) for name in RECO_COUNTS],
    )


def reco_periods(recos: DataFrame) -> DataFrame:
    """The distinct periods present."""
    return recos.select("event_date").distinct()


def _cutoff(value):
    return date_literal(value) if isinstance(value, str) else F.lit(value)


def latest_if_current(
    df: DataFrame, cutoff, key: str = "symbol", date_col: str = "event_date"
) -> DataFrame:
    """Rows of each key's newest date, provided that date is not after ``cutoff``.

    A key whose newest date lies after the cut-off yields no rows at all; rows that
    tie for the newest date are all kept. The newest date is aggregated map-side and
    joined back, so no key is gathered in one task.
    """
    newest = (
        df.groupBy(key)
        .agg(F.max(date_col).alias(date_col))
        .where(F.col(date_col) <= _cutoff(cutoff))
    )
    return df.join(newest, [key, date_col], "left_semi").select(*df.columns)


def latest_as_of(
    df: DataFrame, cutoff, key: str = "symbol", date_col: str = "event_date", tie_break=None
) -> DataFrame:
    """One row per key: the newest not after ``cutoff``.

    Ties go to the larger ``tie_break`` columns (default: the counts present). The
    row_number filter is planned as a group limit that runs before the shuffle.
    """
    if tie_break is None:
        tie_break = [name for name in RECO_COUNTS if name in df.columns]
    newest_first = Window.partitionBy(key).orderBy(
        F.desc(date_col), *[F.desc(name) for name in tie_break]
    )
    return (
        df.where(F.col(date_col) <= _cutoff(cutoff))
        .withColumn("row_num", F.row_number().over(newest_first))
        .where(F.col("row_num") == 1)
        .drop("row_num")
    )
