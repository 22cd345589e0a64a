"""Building messages, and sorting received ones into accepted and rejected."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.functions.clock import from_epoch, iso_text
from tickforge.functions.columns import is_filled
from tickforge.functions.codec import decode, encode, is_object_text
from tickforge.operators.filters import has_keys, has_type
from tickforge.schemas import ENVELOPE, NEWS_TYPE, RECO_COUNTS, RECO_TYPE

TRADES, RECOS, NEWS = "trades", "recos", "news"


def trade_messages(trades: DataFrame) -> DataFrame:
    """The nine message fields; time as ISO text, event_date as its UTC date."""
    return trades.select(
        "symbol",
        "price",
        "size",
        "exchange",
        "conditions",
        "tape",
        "id",
        iso_text("timestamp_parsed").alias("timestamp"),
        F.date_format("timestamp_parsed", "yyyy-MM-dd").alias("event_date"),
    )


def _envelope(df: DataFrame, event_date: Column, kind: str, payload: Column) -> DataFrame:
    return df.select(
        "symbol",
        event_date.alias("event_date"),
        F.lit(kind).alias("type"),
        payload.alias("payload"),
    )


def reco_messages(recos: DataFrame) -> DataFrame:
    """Flat recommendation rows (event_date is the period) to envelopes."""
    period = F.date_format("event_date", "yyyy-MM-dd")
    return _envelope(recos, period, RECO_TYPE, F.struct(period.alias("period"), *RECO_COUNTS))


def news_messages(news: DataFrame) -> DataFrame:
    """Rows of (symbol, payload struct with ``datetime`` epoch seconds) to envelopes."""
    day = F.date_format(from_epoch("payload.datetime"), "yyyy-MM-dd")
    return _envelope(news, day, NEWS_TYPE, F.col("payload"))


def as_records(messages: DataFrame, keyed: bool) -> DataFrame:
    """Broker records: JSON value, and the symbol as key for trades."""
    key = F.col("symbol") if keyed else F.lit(None)
    return messages.select(
        key.cast("string").alias("key"), encode(*messages.columns).alias("value")
    )


def once_per_position(landed: DataFrame) -> DataFrame:
    """One row for each topic, partition and offset; rows without an offset all stay.

    A topic is read again after a lost checkpoint, and then lands what it holds twice.
    """
    placed = landed.where(F.col("offset").isNotNull())
    return placed.dropDuplicates(["topic", "partition", "offset"]).unionByName(
        landed.where(F.col("offset").isNull())
    )


def read_envelopes(records: DataFrame, keep=()) -> DataFrame:
    """Records with ``value`` to value, symbol, event_date, type and malformed, and ``keep``.

    Text that is NULL, does not parse, or is not a JSON object is malformed.
    """
    return records.select("value", *keep, decode("value", ENVELOPE, "_bad")).select(
        "value",
        *keep,
        *ENVELOPE.names,
        (F.col("_bad").isNotNull() | ~is_object_text("value")).alias("malformed"),
    )


def reject_reason(feed: str) -> Column:
    """Why a feed refuses an envelope, or NULL if it takes it.

    Recommendations must carry their type. Trades only need both keys to be there;
    the other feeds need them filled. A day that is given must be a date.
    """
    wrong_type = ~has_type(RECO_TYPE) if feed == RECOS else F.lit(False)
    return (
        F.when(F.col("malformed"), "malformed")
        .when(wrong_type, "wrong type")
        .when(~has_keys(truthy=feed != TRADES), "missing key")
        .when(is_filled("event_date") & F.col("event_date").try_cast("date").isNull(), "bad date")
    )


def mixed_feed() -> Column:
    """Feed of a message on a topic that carries several: by type, else trades."""
    return F.when(has_type(RECO_TYPE), RECOS).when(has_type(NEWS_TYPE), NEWS).otherwise(TRADES)


def classify(envelopes: DataFrame, feed: str | None = None) -> DataFrame:
    """Add ``feed`` and ``reason`` (NULL when accepted); no feed means a mixed topic."""
    if feed is not None:
        return envelopes.withColumn("feed", F.lit(feed)).withColumn("reason", reject_reason(feed))
    reason = (
        F.when(F.col("feed") == RECOS, reject_reason(RECOS))
        .when(F.col("feed") == NEWS, reject_reason(NEWS))
        .otherwise(reject_reason(TRADES))
    )
    return envelopes.withColumn("feed", mixed_feed()).withColumn("reason", reason)


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reason").isNull())


def rejected(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reason").isNotNull())
