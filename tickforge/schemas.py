"""Explicit schemas of every table and message.

Nothing in the library infers a schema from data: inference costs a full extra
pass over the raw zone and gives different types for different days.
"""

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# Column names, message types, condition codes and symbols that
# other systems read by name.
SYMBOLS = ["AAPL", "MSFT", "GOOGL", "TSLA", "NVDA", "AMZN"]
KEYS = ["symbol", "event_date"]
RECO_COUNTS = ["buy", "hold", "sell", "strongBuy", "strongSell"]
CONDITION_CODES = {"condition_at": "@", "condition_i": "I", "condition_t": "T"}
LABEL_COLUMNS = {"exchange": "exchange_index", "tape": "tape_index"}
RECO_TYPE = "RECO"
NEWS_TYPE = "NEWS"
FEATURE_COLUMNS = [
    "symbol",
    "event_date",
    "price",
    "size",
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
    "rolling_avg_price",
    "rolling_std_price",
    "cumulative_volume",
]
ENRICHED_COLUMNS = [
    "symbol",
    "event_date",
    "close_price",
    "volume",
    "volatility",
    "nb_transactions",
    "reco_event_date",
    "buy_score",
    "sell_score",
    "strong_buy_score",
    "strong_sell_score",
    "hold_score",
]

#: Columns that fix the order of trades; kept next to the 17 features so that
#: bars can pick open and close without guessing.
ORDER_COLUMNS = ["timestamp_parsed", "id"]


def _struct(**fields):
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


_text, _real, _whole = StringType(), DoubleType(), LongType()

#: Where a message stood on its topic; the broker's time in microseconds.
POSITION = _struct(topic=_text, partition=IntegerType(), offset=_whole, broker_micros=_whole)

#: A record of a topic, as the readers of streams give it.
RECORD = StructType([*_struct(key=_text, value=_text).fields, *POSITION.fields])

TRADE_MESSAGE = _struct(
    symbol=_text,
    price=_real,
    size=_real,
    exchange=_text,
    conditions=ArrayType(_text),
    tape=_text,
    id=_whole,
    timestamp=_text,
    event_date=_text,
)

RECO_PAYLOAD = _struct(period=_text, **{name: _whole for name in RECO_COUNTS})

RECO_MESSAGE = _struct(symbol=_text, event_date=_text, type=_text, payload=RECO_PAYLOAD)

#: The news payload is opaque, so it stays JSON text.
NEWS_MESSAGE = _struct(symbol=_text, event_date=_text, type=_text, payload=_text)

#: What every feed has in common; enough to route a message.
ENVELOPE = _struct(symbol=_text, event_date=_text, type=_text)

_FEATURE_TYPES = {
    "symbol": _text,
    "event_date": DateType(),
    **{
        name: IntegerType()
        for name in [*CONDITION_CODES, "hour", "minute", "second", "day_of_week"]
    },
    "timestamp_epoch": _whole,
}

TRADE_FEATURES = _struct(
    **{name: _FEATURE_TYPES.get(name, _real) for name in FEATURE_COLUMNS},
    timestamp_parsed=TimestampType(),
    id=_whole,
)

BARS = _struct(
    window=_struct(start=TimestampType(), end=TimestampType()),
    symbol=_text,
    event_date=DateType(),
    open_price=_real,
    high_price=_real,
    low_price=_real,
    close_price=_real,
    vwap=_real,
    volume_sum=_real,
    trade_count=_whole,
    volatility_price=_real,
)

#: Label counts by day.
LABEL_COUNTS = _struct(column=_text, label=_text, n=_whole, event_date=DateType())

RECOS = _struct(symbol=_text, event_date=DateType(), **{name: _whole for name in RECO_COUNTS})

ENRICHED = _struct(
    symbol=_text,
    event_date=DateType(),
    close_price=_real,
    volume=_real,
    volatility=_real,
    nb_transactions=_whole,
    reco_event_date=DateType(),
    buy_score=_whole,
    sell_score=_whole,
    strong_buy_score=_whole,
    strong_sell_score=_whole,
    hold_score=_whole,
    bar_start=TimestampType(),
)
