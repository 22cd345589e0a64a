"""End-to-end enrichment: trades and recommendations to enriched bars."""

from pyspark.sql import DataFrame

from tickforge.operators.bars import ensure_timestamp, price_bars
from tickforge.operators.enrich import enrich_asof
from tickforge.operators.filters import in_universe


def enrich_market(
    trades: DataFrame, recos: DataFrame, window_size: str = "1 minute", symbols=None
) -> DataFrame:
    """Bars of every symbol and day with the recommendation current on that day.

    The (symbol, day) pairs for the as-of match are taken from the trades with a
    two-column scan, so the bars are computed once.
    """
    if symbols is not None:
        trades, recos = in_universe(trades, symbols), in_universe(recos, symbols)
    trades = ensure_timestamp(trades)
    timed = trades.where(trades.timestamp_parsed.isNotNull())
    return enrich_asof(price_bars(trades, window_size), recos, days=timed)
