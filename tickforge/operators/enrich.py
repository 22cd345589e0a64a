"""Bars joined with the recommendation that was current on their day."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.operators.recos import latest_as_of
from tickforge.schemas import ENRICHED_COLUMNS, KEYS, RECO_COUNTS

# Output name of each bar and recommendation column.
BAR_NAMES = {
    "close_price": "close_price",
    "volume_sum": "volume",
    "volatility_price": "volatility",
    "trade_count": "nb_transactions",
}
SCORE_NAMES = {
    "buy": "buy_score",
    "sell": "sell_score",
    "strongBuy": "strong_buy_score",
    "strongSell": "strong_sell_score",
    "hold": "hold_score",
}


def bar_features(bars: DataFrame) -> DataFrame:
    """The bar columns that enrichment keeps, plus the start of the bar."""
    return bars.select(
        *KEYS,
        *[F.col(old).alias(new) for old, new in BAR_NAMES.items()],
        F.col("window.start").alias("bar_start"),
    )


def reco_features(recos: DataFrame) -> DataFrame:
    """Recommendation columns under their enriched names."""
    return recos.select(
        "symbol",
        F.col("event_date").alias("reco_event_date"),
        *[F.col(old).alias(new) for old, new in SCORE_NAMES.items()],
    )


def _ordered(enriched: DataFrame) -> DataFrame:
    return enriched.select(*ENRICHED_COLUMNS, "bar_start")


def enrich_day(bars: DataFrame, recos: DataFrame, event_date: str) -> DataFrame:
    """All bars of one day, each with its symbol's latest recommendation or NULLs.

    Both filters are on partition columns, so only that day's bars and no later
    recommendations are read. The join carries no hint: the latest table has one
    row per symbol, and Spark broadcasts it when its measured size allows.
    """
    day = bars.where(F.col("event_date") == F.lit(event_date).cast("date"))
    latest = latest_as_of(recos, event_date)
    return _ordered(bar_features(day).join(reco_features(latest), "symbol", "left"))


def recos_as_of(days: DataFrame, recos: DataFrame) -> DataFrame:
    """For each distinct (symbol, event_date), the newest recommendation not after it.

    Days and recommendations are laid on one timeline per symbol and the last
    recommendation is carried forward; no pairs are formed. A symbol has at most one
    entry per calendar day from either side, so its window stays small however many
    trades it has.
    """
    newest = recos.groupBy(*KEYS).agg(F.max(F.struct(*RECO_COUNTS)).alias("counts"))
    given = newest.select(
        "symbol",
        "event_date",
        F.lit(0).alias("side"),
        F.struct("event_date", "counts.*").alias("reco"),
    )
    asked = days.select(*KEYS).distinct().withColumn("side", F.lit(1))
    so_far = (
        Window.partitionBy("symbol")
        .orderBy("event_date", "side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        given.unionByName(asked, allowMissingColumns=True)
        .withColumn("reco", F.last("reco", ignorenulls=True).over(so_far))
        .where((F.col("side") == 1) & F.col("reco").isNotNull())
        .select(
            *KEYS,
            F.col("reco.event_date").alias("reco_event_date"),
            *[F.col(f"reco.{old}").alias(new) for old, new in SCORE_NAMES.items()],
        )
    )


def enrich_asof(bars: DataFrame, recos: DataFrame, days: DataFrame | None = None) -> DataFrame:
    """``enrich_day`` for every day at once (as-of left join).

    ``days`` may give the (symbol, event_date) pairs from a cheaper source than the
    bars, such as the table the bars are computed from.
    """
    matched = recos_as_of(bars if days is None else days, recos)
    return _ordered(bar_features(bars).join(matched, KEYS, "left"))
