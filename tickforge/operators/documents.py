"""Flat, typed search documents built from trade features."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions.clock import from_epoch

# Document fields by type.
REAL_FIELDS = ["price", "size", "rolling_avg_price", "rolling_std_price", "cumulative_volume"]
WHOLE_FIELDS = [
    "exchange_index",
    "tape_index",
    "condition_at",
    "condition_i",
    "condition_t",
    "hour",
    "minute",
    "second",
    "day_of_week",
    "timestamp_epoch",
]


def typed_documents(features: DataFrame) -> DataFrame:
    """Cast the 15 fields and add ``timestamp`` from the epoch; other columns stay.

    Values that are not numbers become NULL. Whole numbers pass through double, so
    "3.7" becomes 3.
    """
    casts = {name: F.col(name).try_cast("double") for name in REAL_FIELDS}
    for name in WHOLE_FIELDS:
        casts[name] = F.col(name).try_cast("double").try_cast("long")
    return features.withColumns(casts).withColumn("timestamp", from_epoch("timestamp_epoch"))
