"""Running counts of a message stream that survive restarts.

The counts are state of the query, kept with its checkpoint: every trigger adds what it
read and the sums go to a table, one step a trigger. A restart goes on from the last
committed trigger, so no message counts twice.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tickforge.operators.messages import classify, read_envelopes
from tickforge.streaming.steps import Steps

_TOTALS = StructType(
    [
        StructField("feed", StringType()),
        StructField("status", StringType()),
        StructField("n_messages", LongType()),
        StructField("step", LongType()),
    ]
)


def totals_query(
    records: DataFrame, root: str, checkpoint: str, feed: str | None = None
) -> DataStreamWriter:
    """Messages per feed and outcome since the checkpoint began; a few rows of state."""
    classified = classify(read_envelopes(records), feed)
    counts = classified.groupBy("feed", F.coalesce("reason", F.lit("accepted")).alias("status")).agg(
        F.count("*").alias("n_messages")
    )

    def take(batch: DataFrame, batch_id: int) -> None:
        steps = Steps(batch.sparkSession, root)
        step, done = steps.last
        if done < batch_id:
            batch.coalesce(1).write.mode("overwrite").parquet(steps.path(step + 1))
            steps.commit(step + 1, batch_id, instead_of=[step])
            if step > 0:  # readers may still be at the step before
                steps.delete(steps.path(step - 1))

    writer = counts.writeStream.outputMode("complete").foreachBatch(take)
    return writer.option("checkpointLocation", checkpoint)


def message_totals(spark: SparkSession, root: str) -> DataFrame:
    """feed, status and n_messages as of the last committed trigger."""
    return Steps(spark, root).read(_TOTALS).drop("step")
