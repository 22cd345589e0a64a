"""Date arithmetic used to pick which day a run works on."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickforge.functions.columns import as_column


def date_literal(text: str) -> Column:
    return F.to_date(F.lit(text), "yyyy-MM-dd")


def month_start(day) -> Column:
    return F.trunc(as_column(day), "MM")


def shift_days(day, days: int) -> Column:
    return F.date_add(as_column(day), days)


def previous_market_day(day) -> Column:
    """The weekday before ``day``; Monday, Sunday and Saturday give Friday. No holidays."""
    day = as_column(day)
    weekday = F.weekday(day)  # 0 = Monday
    back = F.when(weekday == 6, 2).when(weekday == 0, 3).otherwise(1)
    return F.date_sub(day, back)
