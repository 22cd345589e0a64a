"""Whether a table has what it should."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions.calendar import date_literal
from tickforge.operators.quality import completeness_of, missing_symbols
from tickforge.sources.files import table_inventory


def require_complete(df: DataFrame, symbols, event_date: str) -> None:
    """Raise if any expected symbol has no data for the day (runs one small job).

    What comes to the driver are names from ``symbols``, a list.
    """
    day = df.where(F.col("event_date") == date_literal(event_date))
    missing = [row.symbol for row in missing_symbols(day, symbols, event_date).collect()]
    if missing:
        raise ValueError(f"no data on {event_date} for: {', '.join(sorted(missing))}")


def table_completeness(spark, root: str, symbols, event_date: str | None = None) -> DataFrame:
    """Rows and files of a written table per expected symbol and day; no row is read."""
    found = table_inventory(spark, root)
    if event_date is not None:
        found = found.where(F.col("event_date") == date_literal(event_date))
    return completeness_of(found, symbols, event_date)
