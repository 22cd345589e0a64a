"""Timestamps, their parts, and epoch seconds."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickforge.functions.columns import as_column


def parse_timestamp(text) -> Column:
    """ISO-8601 text with offset to an instant; text that does not parse gives NULL."""
    return F.try_to_timestamp(as_column(text))


def time_parts(ts) -> dict[str, Column]:
    """hour, minute, second, day_of_week (1 = Sunday) and whole epoch seconds."""
    ts = as_column(ts)
    return {
        "hour": F.hour(ts),
        "minute": F.minute(ts),
        "second": F.second(ts),
        "day_of_week": F.dayofweek(ts),
        "timestamp_epoch": F.unix_timestamp(ts),
    }


def from_epoch(seconds) -> Column:
    """Epoch seconds to an instant."""
    return F.timestamp_seconds(as_column(seconds))


def iso_text(ts) -> Column:
    """Instant to ISO-8601 text with microseconds and offset."""
    return F.date_format(as_column(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
