"""Summaries of the mart and of the two clean tables.

All are single grouped or global aggregates: Spark combines them per task and
shuffles one row per task and group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.functions.money import in_money
from counterfoil.functions.values import number, text, truthy
from counterfoil.operators.staging import event_value, summable


def _or_zero(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0.0))


def _sum(amount: Column, where: Column | None = None) -> Column:
    """Exact decimal sum, 0 when nothing is summed."""
    picked = amount if where is None else F.when(where, amount)
    return F.coalesce(F.sum(in_money(picked)), F.lit(0))


def _cents(amount: Column) -> Column:
    return F.round(amount, 2).cast("double")


def summary_by_category(mart: DataFrame) -> DataFrame:
    """Per category the number of transactions and both totals."""
    return mart.groupBy("attribution_category").agg(
        F.count(F.lit(1)).alias("count"),
        _sum(F.col("server_amount")).cast("double").alias("server_total"),
        _sum(F.col("client_reported_amount")).cast("double").alias("client_total"),
    )


def summary_mart(mart: DataFrame) -> DataFrame:
    """One row of totals over the mart."""
    server = _or_zero(F.col("server_amount"))
    client = _or_zero(F.col("client_reported_amount"))
    category = F.col("attribution_category")
    failed, dark = category == "marketing_only", category == "finance_only"
    finance = _sum(server, F.col("conversion_definition_finance"))
    marketing = _sum(client, F.col("conversion_definition_marketing"))
    return mart.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        _cents(finance).alias("finance_revenue_completed"),
        _cents(marketing).alias("marketing_revenue_purchase_intents"),
        _cents(finance - marketing).alias("net_revenue_gap_finance_minus_marketing"),
        F.count_if(failed).alias("failed_transactions_with_client_tracking"),
        _cents(_sum(client, failed)).alias("failed_value_marketing_claims"),
        F.count_if(dark).alias("dark_transactions_no_client_event"),
        _cents(_sum(server, dark)).alias("dark_revenue_finance_sees"),
    )


def sample(mart: DataFrame, category: str, n: int = 3) -> DataFrame:
    """The first `n` transactions of a category, by time and id."""
    return (
        mart.where(F.col("attribution_category") == category)
        .orderBy("transaction_at", "transaction_id")
        .limit(n)
    )


def client_event_counts(clean: DataFrame) -> DataFrame:
    """Events per event name as recorded, upper and lower case kept apart."""
    return clean.groupBy(text(clean, "event_name").alias("event_name")).agg(
        F.count(F.lit(1)).alias("events")
    )


def summary_client(clean: DataFrame) -> DataFrame:
    """One row of totals over the client events."""
    rows = clean.select(
        text(clean, "event_name").alias("name"), event_value(clean).alias("value")
    )
    intent = F.col("name") == "purchase_intent"
    return rows.agg(
        F.count(F.lit(1)).alias("total_events"),
        F.coalesce(F.bool_or(F.col("name") == "session_start"), F.lit(False)).alias(
            "has_session_start_events"
        ),
        F.count_if(intent).alias("purchase_intent_count"),
        _cents(_sum(F.col("value"), intent)).alias("purchase_intent_value_total"),
    )


def server_status_counts(clean: DataFrame) -> DataFrame:
    """Transactions per status as recorded."""
    return clean.groupBy(text(clean, "status").alias("status")).agg(
        F.count(F.lit(1)).alias("transactions")
    )


def summary_server(clean: DataFrame) -> DataFrame:
    """One row of totals over the transactions; a link of blanks counts as a link here."""
    rows = clean.select(
        truthy(clean, "ext_id").alias("linked"),
        text(clean, "status").alias("status"),
        _or_zero(summable(number(clean, "amount"))).alias("amount"),
    )
    unlinked = ~F.col("linked")
    return rows.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.count_if("linked").alias("transactions_with_client_link"),
        F.count_if(unlinked).alias("transactions_without_client_link"),
        _cents(_sum(F.col("amount"), unlinked & (F.col("status") == "completed"))).alias(
            "revenue_without_client_link"
        ),
    )


def repeated_event_ids(clean: DataFrame) -> DataFrame:
    """Event ids that several clean records share.

    The id is not part of the key by which duplicates are removed, so it may
    repeat; the journey then keeps one row per id, the mart one per record.
    """
    return (
        clean.groupBy(text(clean, "event_id").alias("event_id"))
        .agg(F.count(F.lit(1)).alias("records"))
        .where("records > 1")
    )
