"""Client and server feeds derived from a plain `events` table.

For users whose events sit in one Parquet table (event_id, ts, user_id,
event_type, value, props) rather than in two JSON feeds. All rows of the table
become client events; purchases and a share of the signups become transactions
with delays, gaps and differing amounts, so that every case of the
reconciliation occurs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_NAME = """
    CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
      WHEN 'purchase' THEN 'purchase_intent' ELSE event_type END
"""

EXT_ID = """
    CASE WHEN day(tx_at) = 20 THEN NULL
      WHEN event_type = 'signup' THEN
        CASE WHEN event_id % 2 = 0 THEN concat('e', event_id - 1) END
      WHEN event_id % 5 = 0 THEN NULL
      WHEN event_id % 41 = 0 THEN '  '
      ELSE concat('e', event_id) END
"""

AMOUNT = "CASE WHEN event_id % 10 = 3 THEN round(value + 1.25, 2) ELSE value END"

STATUS = """
    CASE WHEN day(tx_at) = 15 THEN 'failed'
      WHEN event_id % 97 = 0 THEN NULL
      WHEN event_id % 20 IN (1, 2, 7) THEN 'failed'
      WHEN event_id % 20 = 4 THEN 'refunded'
      WHEN event_id % 20 = 6 THEN 'pending'
      ELSE 'completed' END
"""

# Repeats arrive after all first deliveries.
SECOND_DELIVERY = 1 << 62

ISO_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def _transactions(events_df: DataFrame) -> DataFrame:
    paid = events_df.where(
        "event_type = 'purchase' OR (event_type = 'signup' AND event_id % 4 <= 1)"
    )
    return paid.withColumn(
        "tx_at", F.expr("ts + make_dt_interval(0, 0, 0, (event_id * 37) % 700 - 50)")
    )


def clean_client(events_df: DataFrame) -> DataFrame:
    """Client clean table; the property bag is a struct of the value and `props.k`."""
    return events_df.select(
        F.expr("concat('e', event_id)").alias("event_id"),
        F.col("ts").alias("timestamp"),
        F.expr("concat('u', user_id)").alias("user_id"),
        F.expr(EVENT_NAME).alias("event_name"),
        F.struct(
            F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.col("value")
        ).alias("properties"),
        F.lit("client").alias("_source"),
        F.current_timestamp().alias("_extracted_at"),
    )


def clean_server(events_df: DataFrame) -> DataFrame:
    """Server clean table."""
    return _transactions(events_df).select(
        F.expr("concat('tx', event_id)").alias("tx_id"),
        F.col("tx_at").alias("timestamp"),
        F.expr("concat('u', user_id)").alias("user_id"),
        F.expr(STATUS).alias("status"),
        F.expr(AMOUNT).alias("amount"),
        F.expr(EXT_ID).alias("ext_id"),
        F.lit("server").alias("_source"),
        F.current_timestamp().alias("_extracted_at"),
    )


def raw_client(events_df: DataFrame) -> DataFrame:
    """Raw client records with violations and repeats.

    Errors carry a numeric user and no properties, signups a timestamp that is
    not ISO, and every purchase arrives a second time under another event id.
    """
    base = events_df.select(
        F.expr("concat('e', event_id)").cast("variant").alias("event_id"),
        F.when(F.col("event_type") == "signup", F.date_format("ts", "dd/MM/yyyy HH:mm:ss.SSSSSS"))
        .otherwise(F.date_format("ts", ISO_TEXT))
        .cast("variant")
        .alias("timestamp"),
        F.expr(
            "CASE WHEN event_type = 'error' THEN user_id::variant "
            "ELSE concat('u', user_id)::variant END"
        ).alias("user_id"),
        F.expr(EVENT_NAME).cast("variant").alias("event_name"),
        F.when(F.col("event_type") != "error", F.parse_json("props")).alias("properties"),
        F.col("event_id").cast("bigint").alias("pos"),
    )
    repeats = (
        base.where(F.expr("event_name::string") == "purchase_intent")
        .withColumn("event_id", F.expr("concat('again-', event_id::string)::variant"))
        .withColumn("pos", F.col("pos") + SECOND_DELIVERY)
    )
    return base.unionByName(repeats)


def raw_server(events_df: DataFrame) -> DataFrame:
    """Raw server records with violations and repeats.

    Refunds carry the amount as text, pending payments an unknown status,
    unlinked transactions a null meta, and every failed payment arrives a second
    time with another amount.
    """
    base = _transactions(events_df).select(
        F.expr("concat('tx', event_id)").cast("variant").alias("tx_id"),
        F.date_format("tx_at", ISO_TEXT).cast("variant").alias("timestamp"),
        F.expr("concat('u', user_id)").cast("variant").alias("user_id"),
        F.expr(STATUS).alias("status"),
        F.expr(AMOUNT).alias("amount"),
        F.expr(EXT_ID).alias("ext_id"),
        F.col("event_id").cast("bigint").alias("pos"),
    )
    repeats = (
        base.where(F.col("status") == "failed")
        .withColumn("amount", F.col("amount") + 1)
        .withColumn("pos", F.col("pos") + SECOND_DELIVERY)
    )
    return base.unionByName(repeats).select(
        "tx_id",
        "timestamp",
        "user_id",
        F.coalesce(
            F.expr("CASE WHEN status = 'pending' THEN 'On Hold' ELSE status END").cast("variant"),
            F.parse_json(F.lit("null")),
        ).alias("status"),
        F.expr(
            "CASE WHEN status = 'refunded' THEN amount::string::variant "
            "ELSE amount::variant END"
        ).alias("amount"),
        F.coalesce(
            F.to_variant_object(
                F.when(F.col("ext_id").isNotNull(), F.struct(F.col("ext_id").alias("ext_id")))
            ),
            F.parse_json(F.lit("null")),
        ).alias("meta"),
        "pos",
    )
