"""Ordered work on keys of any size.

A window function sends every row of a key to one task, and one (symbol, day) may
hold a large share of all rows. The helpers here cut such hot keys into slices that
follow the order column, so each task gets a bounded part, and give back exactly
what the whole-key window would give:

* ``split_points`` finds where to cut: hot keys into equal stretches, overfull stretches
  at quantiles of the order column, overfull single values at quantiles of the next one;
* ``with_slices`` puts a slice number on every row (0 for keys that are not hot);
* ``previous_rows`` fetches the few rows just before each slice, for frames that
  look back a fixed number of rows;
* ``slice_offsets`` counts the rows before each slice, for running row numbers.

The keys are counted first, in a pass over two or three columns, and the count decides the
plan: without a hot key there is nothing to cut, and what follows is the plain window. The
three tables of split points are written, so each is computed once, and broadcast. Each has at
most rows / target_rows rows, since each of its groups holds more than target_rows rows, and
a row holds no more than ``QUANTILES`` numbers.
"""

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, TimestampType

from tickforge.session import stage

#: Rows a single window task should hold, about 200-400 MB for trade rows.
TARGET_ROWS = 2_000_000

#: A stretch or a single value is cut into so many parts at most, by quantiles.
QUANTILES = 64

SLICE = "_slice"
_BOUNDS = ["_low", "_span", "_parts"]
#: Doubles below this hold whole numbers exactly, so equal ones are one value.
_EXACT = 2**53


@dataclass(frozen=True)
class SplitPoints:
    """Where hot keys are cut. ``ties`` is None if the order cannot split a single value."""

    hot: DataFrame
    cuts: DataFrame
    ties: DataFrame | None


def _position(df: DataFrame, order: str) -> str:
    """SQL for the order column as a double; rounding keeps it monotone."""
    is_time = isinstance(df.schema[order].dataType, TimestampType)
    return f"cast({f'unix_micros({order})' if is_time else order} as double)"


def _place(df: DataFrame, order: str) -> str:
    """``_position`` with NULL first, as in an ascending order."""
    return f"coalesce({_position(df, order)}, double('-infinity'))"


def _join_small(df: DataFrame, small: DataFrame, on, how: str) -> DataFrame:
    """Broadcast join where NULL keys match, as they do in a window's partitions."""
    names = {name: f"_match_{name}" for name in on}
    small = small.withColumnsRenamed(names)
    same = [df[name].eqNullSafe(small[match]) for name, match in names.items()]
    return df.join(F.broadcast(small), reduce(and_, same), how).drop(*names.values())


def hot_keys(df: DataFrame, keys, order: str, target_rows: int = TARGET_ROWS) -> DataFrame:
    """Keys with more than ``target_rows`` rows and how to cut them.

    Map-side combined count over two or three columns only.
    """
    place = _position(df, order)
    return (
        df.groupBy(*keys)
        .agg(
            F.expr("count(*) as _rows"),
            F.expr(f"min({place}) as _low"),
            F.expr(f"max({place}) as _high"),
        )
        .where(F.col("_rows") > target_rows)
        # Twice the needed number of parts: rows are not spread evenly over the day.
        .selectExpr(
            *keys, "_low", "_high - _low + 1 as _span", f"ceil(2 * _rows / {target_rows}) as _parts"
        )
    )


def split_points(
    df: DataFrame, keys, order_by, target_rows: int = TARGET_ROWS
) -> SplitPoints | None:
    """Split points that follow ``order_by``, so that a burst is split as well; None if no key
    is hot.

    All are map-side combined aggregates, run at once; the second and third read hot keys
    only. A single value of the first column is split
    if the second is a number or a timestamp. A slice holds about ``target_rows`` rows, or
    a sixty-fourth of a stretch or value that holds more than 64 times as many.
    """
    keys, (first, *more) = list(keys), list(order_by)[:2]
    hot = stage(hot_keys(df, keys, first, target_rows), "hot-keys")
    if hot.isEmpty():
        return None
    stretches = _with_stretch(df.select(*keys, first, *more), hot, keys, first, "inner")
    cuts = stage(_quantiles(stretches, [*keys, "_stretch"], first, target_rows), "cuts")
    ties = None
    if more and isinstance(df.schema[more[0]].dataType, (NumericType, TimestampType)):
        single = _with_part(stretches, cuts, keys, first, "inner").where("_part % 2 = 1")
        ties = stage(_quantiles(single, [*keys, "_stretch", "_part"], more[0], target_rows), "ties")
    return SplitPoints(hot, cuts, ties)


def _with_stretch(df, hot, keys, order, how):
    """Number of the equal stretch of the order column a row lies in."""
    share = f"({_position(df, order)} - _low) / _span"
    # ``least`` skips NULL, so an order value of NULL is put first before it.
    number = F.expr(f"coalesce(least(coalesce(floor({share} * _parts), 0L), _parts - 1), 0L)")
    return _join_small(df, hot, keys, how).withColumn("_stretch", number).drop(*_BOUNDS)


def _quantiles(df, groups, order, target_rows):
    """Distinct quantiles of every group that holds more than ``target_rows`` rows."""
    shares = ", ".join(f"{k / QUANTILES}D" for k in range(1, QUANTILES))
    step = f"greatest(1, {QUANTILES} div ceil(2 * _rows / {target_rows}))"
    return (
        df.groupBy(*groups)
        .agg(
            F.expr("count(*) as _rows"),
            F.expr(f"percentile_approx({_place(df, order)}, array({shares}), 1000) as _all"),
        )
        .where(F.col("_rows") > target_rows)
        .selectExpr(
            *groups, f"array_distinct(filter(_all, (c, i) -> (i + 1) % {step} = 0)) as _cuts"
        )
    )


def _with_part(df, cuts, keys, order, how):
    """Part of an overfull stretch: odd for the rows at a quantile, even for those between."""
    place = _place(df, order)
    before = f"size(filter(_cuts, c -> c < {place}))"
    # Of values too large to be told apart as doubles, none counts as a single one.
    exact = f"({place} between -{_EXACT}D and {_EXACT}D or {place} = double('-infinity'))"
    single = f"if({exact} and array_contains(_cuts, {place}), 1, 0)"
    part = F.expr(f"cast(if(_cuts is null, 0, 2 * {before} + {single}) as long)")
    return _join_small(df, cuts, [*keys, "_stretch"], how).withColumn("_part", part).drop("_cuts")


def with_slices(
    df: DataFrame, points: SplitPoints, keys, order_by, how: str = "left"
) -> DataFrame:
    """Add ``_slice``. ``how='inner'`` keeps the rows of hot keys only."""
    keys, (first, *more) = list(keys), list(order_by)[:2]
    rows = _with_stretch(df, points.hot, keys, first, how)
    rows = _with_part(rows, points.cuts, keys, first, "left")
    tie = "0L"
    if points.ties is not None:
        rows = _join_small(rows, points.ties, [*keys, "_stretch", "_part"], "left")
        before = f"size(filter(_cuts, c -> c < {_place(df, more[0])}))"
        tie = f"if(_cuts is null, 0, {before})"
    number = f"(_stretch * {2 * QUANTILES} + _part) * {QUANTILES} + {tie}"
    return rows.withColumn(SLICE, F.expr(number)).drop("_stretch", "_part", "_cuts")


def previous_rows(sliced: DataFrame, keys, order_by, carry, rows: int) -> DataFrame:
    """For every slice but the first, the ``rows`` rows just before it in its key.

    ``sliced`` holds rows of hot keys. The last rows of each slice are found with a
    group limit that runs before the shuffle; what is left is at most ``rows`` per
    slice, so the per-key window that follows is small.
    """
    order_by = list(order_by)
    columns = list(dict.fromkeys([*order_by, *carry]))
    newest_first = Window.partitionBy(*keys, SLICE).orderBy(*[F.desc(c) for c in order_by])
    tails = (
        sliced.select(*keys, SLICE, *columns)
        .withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= rows)
        .drop("_rank")
    )
    by_key = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        tails.withColumn("_before", F.lag(SLICE).over(by_key))
        .withColumn(
            "_previous", F.collect_list(F.struct(*columns)).over(by_key.rowsBetween(-rows, -1))
        )
        .where(F.col("_before") != F.col(SLICE))
        .select(*keys, SLICE, F.explode("_previous").alias("_row"))
        .select(*keys, SLICE, "_row.*")
    )


def slice_offsets(sliced: DataFrame, keys) -> DataFrame:
    """Rows before each slice of a hot key; a small multiple of rows / target_rows rows."""
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.groupBy(*keys, SLICE)
        .agg(F.count("*").alias("_rows"))
        .select(*keys, SLICE, F.sum("_rows").over(before).alias("_offset"))
        .where(F.col("_offset").isNotNull())
    )


def number_rows(
    df: DataFrame, keys, order_by, name: str, target_rows: int = TARGET_ROWS
) -> DataFrame:
    """1-based row number per key in the given order, hot keys split.

    ``order_by`` starts with a long or timestamp column and must be a total order. A second
    column of such a type lets single values of the first be split.
    """
    keys, order_by = list(keys), list(order_by)
    points = split_points(df, keys, order_by, target_rows)
    if points is None:
        whole = Window.partitionBy(*keys).orderBy(*order_by)
        return df.withColumn(name, F.row_number().over(whole).cast("long"))
    sliced = with_slices(df, points, keys, order_by)
    counted = with_slices(df.select(*keys, *order_by[:2]), points, keys, order_by, "inner")
    offsets = slice_offsets(counted, keys)
    within = Window.partitionBy(*keys, SLICE).orderBy(*order_by)
    return (
        _join_small(sliced, offsets, [*keys, SLICE], "left")
        .withColumn(
            name,
            F.row_number().over(within).cast("long") + F.coalesce("_offset", F.lit(0)),
        )
        .drop(SLICE, "_offset")
    )
