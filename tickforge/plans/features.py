"""The trade feature table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickforge.functions.clock import parse_timestamp, time_parts
from tickforge.functions.columns import array_flag
from tickforge.operators.labels import LabelIndex, apply_labels, fit_labels
from tickforge.operators.rolling import rolling_features
from tickforge.operators.slices import TARGET_ROWS
from tickforge.schemas import (
    CONDITION_CODES,
    FEATURE_COLUMNS,
    KEYS,
    LABEL_COLUMNS,
    ORDER_COLUMNS,
)


def typed_trades(messages: DataFrame) -> DataFrame:
    """Raw messages with the timestamp parsed and event_date as a date."""
    return messages.select(
        "symbol",
        F.col("event_date").try_cast("date").alias("event_date"),
        "price",
        "size",
        "exchange",
        "conditions",
        "tape",
        "id",
        parse_timestamp("timestamp").alias("timestamp_parsed"),
    )


def unreadable_times(messages: DataFrame) -> DataFrame:
    """Messages whose timestamp is missing or does not parse, for a rejects table.

    ``typed_trades`` keeps them with a NULL time.
    """
    return messages.where(parse_timestamp("timestamp").isNull())


def trade_features(
    trades: DataFrame,
    labels: LabelIndex | None = None,
    code_scope=(),
    target_rows: int = TARGET_ROWS,
    on_null_label: str = "error",
) -> DataFrame:
    """17 features per trade, followed by timestamp_parsed and id.

    Codes are fitted on the whole input unless fitted ``labels`` are given;
    ``code_scope=("symbol", "event_date")`` fits each symbol and day on its own. Pass a
    columnar source: the label counts, the hot-key counts and the features each scan it, with
    only the columns they need. Trades are shuffled once, by symbol, day and slice.
    """
    labels = labels or fit_labels(trades, LABEL_COLUMNS, code_scope)
    coded = apply_labels(trades, labels, LABEL_COLUMNS, on_null_label)
    flags = {name: array_flag("conditions", code) for name, code in CONDITION_CODES.items()}
    # Only what the result needs goes through the rolling shuffle: codes and flags
    # instead of text and arrays, and no time part, since those follow from the time.
    narrow = coded.withColumns(flags).select(
        *KEYS, "price", "size", *LABEL_COLUMNS.values(), *CONDITION_CODES, *ORDER_COLUMNS
    )
    rolled = rolling_features(narrow, target_rows, source=trades)
    return rolled.withColumns(time_parts("timestamp_parsed")).select(
        *FEATURE_COLUMNS, *ORDER_COLUMNS
    )


def feature_columns(features: DataFrame) -> DataFrame:
    """Exactly the 17 feature columns in their fixed order."""
    return features.select(*FEATURE_COLUMNS)
