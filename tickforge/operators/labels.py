"""Categorical codes: 0 for the most frequent label, ties by label ascending.

Counts of labels are written before they are ranked and joined. So the planner knows how large
the codes are when it plans the join: a few codes are broadcast and no trade is shuffled
for them; very many are joined by a shuffle that adaptive execution splits where it is skewed.

Counts add up. A table of counts by day (``save_label_counts``) is refitted by adding the new
days alone, and ``saved_labels`` ranks the sums.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickforge.operators.slices import TARGET_ROWS, number_rows
from tickforge.schemas import LABEL_COUNTS
from tickforge.session import stage
from tickforge.sinks.files import write_table


@dataclass(frozen=True)
class LabelIndex:
    """Codes fitted on one input: rows of (scope..., column, label, label_index)."""

    table: DataFrame
    scope: tuple


def label_counts(df: DataFrame, columns, scope=()) -> DataFrame:
    """Count every non-NULL label of every column in one pass, combined map-side."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("label")) for c in columns])
    ).alias("pair")
    return (
        df.select(*scope, pairs)
        .select(*scope, "pair.*")
        .where(F.col("label").isNotNull())
        .groupBy(*scope, "column", "label")
        .agg(F.count("*").alias("n"))
    )


def rank_labels(counts: DataFrame, scope=(), target_rows: int = TARGET_ROWS) -> DataFrame:
    """label_index within each column (and scope) of a written table of label counts.

    Numbering cuts a column with very many labels into slices of its counts. A table with no
    more rows than a slice has nothing to cut.
    """
    ordered = counts.withColumn("_rarity", -F.col("n"))
    keys, order = [*scope, "column"], ["_rarity", "label"]
    if counts.count() <= target_rows:
        whole = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        numbered = ordered.withColumn("_number", whole)
    else:
        numbered = number_rows(ordered, keys, order, "_number", target_rows)
    index = (F.col("_number") - 1).cast("double").alias("label_index")
    return numbered.select(*scope, "column", "label", index)


def fit_labels(df: DataFrame, columns, scope=(), target_rows: int = TARGET_ROWS) -> LabelIndex:
    """Fit codes. With ``scope`` each group (say symbol and day) gets its own codes.

    One pass over ``df``, run at once; what is written is its counts. Nothing is collected.
    """
    columns, scope = list(columns), tuple(scope)
    counts = stage(label_counts(df, columns, scope).coalesce(64), "label-counts")
    return LabelIndex(rank_labels(counts, scope, target_rows), scope)


def save_label_counts(df: DataFrame, root: str, columns) -> None:
    """Counts of the days in ``df`` into a table by day; the counts of other days stay.

    A day that comes again replaces its counts, so ``df`` holds whole days.
    """
    counts = label_counts(df, columns, ("event_date",))
    write_table(counts.select(*LABEL_COUNTS.names), root, ["event_date"])


def saved_labels(
    spark: SparkSession, root: str, until: str | None = None, target_rows: int = TARGET_ROWS
) -> LabelIndex:
    """Codes from saved counts of all days, or of those up to one: no trade is read."""
    saved = spark.read.schema(LABEL_COUNTS).parquet(root)
    if until is not None:
        saved = saved.where(F.col("event_date") <= F.lit(until).cast("date"))
    sums = saved.groupBy("column", "label").agg(F.sum("n").alias("n"))
    return LabelIndex(rank_labels(stage(sums.coalesce(64), "label-sums"), (), target_rows), ())


def apply_labels(df: DataFrame, index: LabelIndex, columns: dict, on_null="error") -> DataFrame:
    """Add one code column per entry of ``columns`` ({label column: code column}).

    A NULL label fails the job, unless ``on_null='keep'`` asks for a NULL code.
    """
    for source, target in columns.items():
        codes = index.table.where(F.col("column") == source).select(
            *index.scope, F.col("label").alias(source), F.col("label_index").alias(target)
        )
        df = df.join(codes, [*index.scope, source], "left")
        if on_null == "error":
            missing = F.raise_error(F.lit(f"{source} is NULL, cannot be coded")).cast("double")
            df = df.withColumn(
                target, F.when(F.col(source).isNull(), missing).otherwise(F.col(target))
            )
    return df
