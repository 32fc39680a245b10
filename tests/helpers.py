"""Small staged tables for the tests."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

START = datetime(2026, 1, 1, 12, 0, 0)

CLIENT_SCHEMA = (
    "event_id string, user_id string, event_at timestamp, event_name string, event_value double"
)
SERVER_SCHEMA = (
    "transaction_id string, user_id string, client_event_id string, transaction_at timestamp, "
    "transaction_amount double, transaction_status string"
)


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def client_table(spark, rows):
    """Rows of (event_id, user_id, event_at, event_name, event_value)."""
    return spark.createDataFrame(rows, CLIENT_SCHEMA).select(
        "*",
        *[F.lit("").alias(c) for c in ("product_id", "page_url", "traffic_source")],
        F.lit("{}").alias("properties_raw"),
        F.coalesce(F.col("event_name") == "purchase_intent", F.lit(False)).alias(
            "is_conversion_client"
        ),
    )


def server_table(spark, rows):
    """Rows of (transaction_id, user_id, link, transaction_at, amount, status)."""
    status = F.col("transaction_status")
    return spark.createDataFrame(rows, SERVER_SCHEMA).select(
        "*",
        (status == "completed").alias("is_completed"),
        (status == "failed").alias("is_failed"),
        (status == "refunded").alias("is_refunded"),
        (status == "completed").alias("is_revenue_recognized"),
    )


def by(df, key):
    return {row[key]: row for row in df.collect()}
