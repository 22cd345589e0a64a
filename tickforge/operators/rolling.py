"""Rolling price and volume statistics over the last trades of a day."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickforge.operators import slices
from tickforge.schemas import KEYS, ORDER_COLUMNS

# Fixed value: the frame is the current trade and the ten before it.
PRECEDING = 10


def rolling_features(
    trades: DataFrame,
    target_rows: int = slices.TARGET_ROWS,
    source: DataFrame | None = None,
) -> DataFrame:
    """Add rolling_avg_price, rolling_std_price and cumulative_volume.

    The frame is up to 11 trades of one symbol and day, ordered by time and then id.
    ``cumulative_volume`` keeps its customary name but is the sum of size over that
    same frame, not over the day. The standard deviation of one trade is NULL.

    Trades cross the network once, keyed by symbol, day and slice. ``source`` may
    name a DataFrame with the same trades that is cheaper to scan, for counting keys.
    """
    columns = [*KEYS, *ORDER_COLUMNS, "price", "size"]
    source = trades if source is None else source
    points = slices.split_points(source, KEYS, ORDER_COLUMNS, target_rows)
    if points is None:
        return trades.withColumns(_statistics(KEYS))
    rows = slices.with_slices(trades, points, KEYS, ORDER_COLUMNS)
    ends = slices.with_slices(source.select(*columns), points, KEYS, ORDER_COLUMNS, "inner")
    earlier = slices.previous_rows(ends, KEYS, ORDER_COLUMNS, ["price", "size"], PRECEDING)

    return (
        rows.withColumn("_borrowed", F.lit(False))
        .unionByName(earlier.withColumn("_borrowed", F.lit(True)), allowMissingColumns=True)
        .withColumns(_statistics([*KEYS, slices.SLICE]))
        .where(~F.col("_borrowed"))
        .drop("_borrowed", slices.SLICE)
    )


def _statistics(keys) -> dict:
    frame = (
        Window.partitionBy(*keys)
        .orderBy(*ORDER_COLUMNS)
        .rowsBetween(-PRECEDING, Window.currentRow)
    )
    return {
        "rolling_avg_price": F.avg("price").over(frame),
        "rolling_std_price": F.stddev_samp("price").over(frame),
        "cumulative_volume": F.sum("size").over(frame),
    }


def last_trades(trades: DataFrame) -> DataFrame:
    """The last ten trades of each symbol and day: all that later trades look back on.

    A group limit runs before the shuffle, so a hot key sends ten rows from each task.
    """
    newest = Window.partitionBy(*KEYS).orderBy(*[F.desc(column) for column in ORDER_COLUMNS])
    columns = [*KEYS, *ORDER_COLUMNS, "price", "size"]
    ranked = trades.select(*columns).withColumn("_rank", F.row_number().over(newest))
    return ranked.where(F.col("_rank") <= PRECEDING).drop("_rank")


def overtaken_keys(trades: DataFrame, last: DataFrame) -> DataFrame:
    """Symbols and days with a trade that comes before one already counted.

    Their features have to be computed anew from all trades of the day.
    """
    place = F.struct(*ORDER_COLUMNS)
    first = trades.groupBy(*KEYS).agg(F.min(place).alias("_first"))
    seen = last.groupBy(*KEYS).agg(F.max(place).alias("_last"))
    return first.join(seen, KEYS).where("_first < _last").select(*KEYS)


def rolling_increment(
    trades: DataFrame, last: DataFrame, target_rows: int = slices.TARGET_ROWS
) -> tuple[DataFrame, DataFrame]:
    """(features of ``trades``, the next ``last``), without the earlier trades of the day.

    ``last`` is what ``last_trades`` gave for the trades before these, possibly empty. The
    result is that of ``rolling_features`` over all trades, for symbols and days that
    ``overtaken_keys`` does not list; NULL times come first in order, so a trade without a
    time overtakes those with one.
    """
    before = last.withColumn("_old", F.lit(True))
    both = trades.withColumn("_old", F.lit(False)).unionByName(before, allowMissingColumns=True)
    rolled = rolling_features(both, target_rows).where(~F.col("_old")).drop("_old")
    return rolled, last_trades(both)
