"""Row filters on partitions, keys, types, symbols, sessions and days."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.functions.calendar import date_literal
from tickforge.functions.columns import is_filled

# Regular session in UTC, and in New York local time.
SESSION_UTC = ("13:30:00", "20:00:00")
SESSION_NEW_YORK = ("09:30:00", "16:00:00")


def partition_filter(
    df: DataFrame, symbol: str | None = None, event_date: str | None = None, until=None
) -> DataFrame:
    """Equality on symbol and day, or all days up to ``until``; reaches the scan as
    partition pruning on a partitioned table."""
    if symbol is not None:
        df = df.where(F.col("symbol") == symbol)
    if event_date is not None:
        df = df.where(F.col("event_date") == date_literal(event_date))
    if until is not None:
        df = df.where(F.col("event_date") <= date_literal(until))
    return df


def has_keys(truthy: bool = True) -> Column:
    """Both keys given; with ``truthy`` an empty string counts as missing."""
    if truthy:
        return is_filled("symbol") & is_filled("event_date")
    return F.col("symbol").isNotNull() & F.col("event_date").isNotNull()


def has_type(kind: str) -> Column:
    """Message type equals ``kind``; a missing type does not."""
    return F.coalesce(F.col("type") == kind, F.lit(False))


def in_universe(df: DataFrame, symbols) -> DataFrame:
    """Rows of the listed symbols, or of the symbols in a one-column DataFrame."""
    if isinstance(symbols, DataFrame):
        return df.join(symbols.select("symbol"), "symbol", "left_semi")
    return df.where(F.col("symbol").isin(list(symbols)))


def in_session(df: DataFrame, day: str, ts: str = "timestamp_parsed", local=False) -> DataFrame:
    """Trades of one day's regular session, both ends included.

    The default is the fixed UTC session, which matches New York hours in summer
    time only; ``local=True`` follows the New York clock all year.
    """
    if not local:
        start, end = (F.to_timestamp(F.lit(f"{day} {clock}")) for clock in SESSION_UTC)
        return df.where(F.col(ts).between(start, end))
    start, end = (
        F.to_utc_timestamp(F.to_timestamp(F.lit(f"{day} {clock}")), "America/New_York")
        for clock in SESSION_NEW_YORK
    )
    return df.where(F.col(ts).between(start, end))


def on_day(df: DataFrame, day: str) -> DataFrame:
    """Messages of one day; event_date may be text or a date."""
    return df.where(F.col("event_date").try_cast("date") == date_literal(day))
