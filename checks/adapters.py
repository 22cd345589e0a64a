"""Market tables derived from the given ``events`` and ``orders`` tables.

``checks.oracle`` writes the same derivations in SQL.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickforge.schemas import RECO_COUNTS

# Which event type stands for which recommendation count, and the
# expected symbols (S6 has no data).
RECO_EVENTS = dict(zip(RECO_COUNTS, ["view", "click", "error", "purchase", "signup"], strict=True))
EXPECTED_SYMBOLS = [f"S{i}" for i in range(7)]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SYMBOL = "concat('S', cast(user_id % 6 as string)) as symbol"


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        SYMBOL,
        "to_date(ts) as event_date",
        "value as price",
        "cast(get_json_object(props, '$.k') as double) as size",
        "event_type as exchange",
        """case event_id % 4 when 0 then array('@') when 1 then array('@', 'I')
           when 2 then array('@', 'T', 'I') end as conditions""",
        "case user_id % 3 when 0 then 'A' when 1 then 'B' else 'C' end as tape",
        "event_id as id",
        "cast(ts as timestamp) as timestamp_parsed",
    )


def recos(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per symbol and week, dated the Monday after; S5 has none."""
    counts = [F.expr(f"count_if(event_type = '{e}') as {c}") for c, e in RECO_EVENTS.items()]
    return (
        table(spark, sf_dir, "events")
        .selectExpr(
            SYMBOL,
            "date_add(to_date(date_trunc('week', ts)), 7) as event_date",
            "event_type",
        )
        .where("symbol <> 'S5'")
        .groupBy("symbol", "event_date")
        .agg(*counts)
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes with empty symbols, NULL dates and NULL types among them."""
    return table(spark, sf_dir, "events").selectExpr(
        "if(event_id % 50 = 7, '', concat('S', cast(user_id % 6 as string))) as symbol",
        "if(event_id % 50 <> 9, date_format(ts, 'yyyy-MM-dd'), null) as event_date",
        "case event_id % 3 when 0 then 'RECO' when 1 then 'NEWS' end as type",
        """named_struct('id', event_id, 'datetime',
           if(event_id % 3 = 1, unix_timestamp(cast(ts as timestamp)), null)) as payload""",
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr("to_date(o_orderdate) as day").distinct()
