"""Reconciliation marts and the reports read from them."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.functions.keys import spread
from counterfoil.functions.money import in_money, rounded_total, total
from counterfoil.functions.times import day_of

def reconcile(server: DataFrame, client: DataFrame) -> DataFrame:
    """One row per transaction with the purchase event it names, both definitions side by side.

    Transactions without a link are spread over all tasks by a second join key.
    A link that very many transactions share is split by adaptive execution.
    """
    purchases = client.where("event_name = 'purchase_intent'").select(
        F.col("event_id").alias("purchase_id"),
        F.col("event_value").alias("client_reported_amount"),
        spread(F.col("event_id"), F.lit("")).alias("purchase_spread"),
    )
    linked = (F.col("client_event_id") == F.col("purchase_id")) & (
        spread(F.col("client_event_id"), F.col("transaction_id")) == F.col("purchase_spread")
    )
    joined = server.join(purchases, linked, "left")

    charged = F.coalesce("transaction_amount", F.lit(0.0))
    reported = F.coalesce("client_reported_amount", F.lit(0.0))
    tracked = F.col("purchase_id").isNotNull()
    recognised = F.col("is_revenue_recognized")
    category = (
        F.when(tracked & recognised, "both")
        .when(tracked & ~recognised, "marketing_only")
        .when(recognised & ~tracked, "finance_only")
        .otherwise("neither")
    )
    return joined.select(
        "transaction_id",
        "user_id",
        "transaction_at",
        "transaction_status",
        F.col("transaction_amount").alias("server_amount"),
        "client_reported_amount",
        (charged - reported).alias("variance"),
        (charged == reported).alias("is_reconciled"),
        tracked.alias("has_client_event"),
        F.col("purchase_id").alias("client_event_id"),
        tracked.alias("conversion_definition_marketing"),
        recognised.alias("conversion_definition_finance"),
        category.alias("attribution_category"),
    )


FINANCE = "conversion_definition_finance"
MARKETING = "conversion_definition_marketing"


def _daily(mart: DataFrame, label: str, definition: str, amount: Column) -> DataFrame:
    counted, reconciled = F.col(definition), F.col("is_reconciled")
    return (
        mart.where(counted)
        .groupBy(day_of(F.col("transaction_at")).alias("report_date"))
        .agg(
            F.lit(label).alias("revenue_source"),
            F.count(F.lit(1)).alias("transaction_count"),
            total(amount).alias("gross_revenue"),
            total(F.when(reconciled, amount).otherwise(0.0)).alias("reconciled_revenue"),
            total(F.when(~reconciled, amount).otherwise(0.0)).alias("unreconciled_revenue"),
            F.count_if(counted).alias("conversion_count"),
        )
    )


def _reported() -> Column:
    return F.coalesce("client_reported_amount", F.lit(0.0))


def finance_daily(mart: DataFrame) -> DataFrame:
    """Per day, transactions whose revenue is recognised, at the amount charged."""
    return _daily(mart, "finance", FINANCE, F.col("server_amount"))


def marketing_daily(mart: DataFrame) -> DataFrame:
    """Per day, transactions with a purchase event, at the amount the browser reported."""
    return _daily(mart, "marketing", MARKETING, _reported())


def revenue_by_source(mart: DataFrame) -> DataFrame:
    """Both daily tables below each other, one row per day and source.

    Every mart row is dealt into the definitions that count it, so the mart is
    read and grouped once.
    """
    sides = F.array(
        F.when(
            F.col(FINANCE),
            F.struct(F.lit("finance").alias("s"), F.col("server_amount").alias("a")),
        ),
        F.when(
            F.col(MARKETING), F.struct(F.lit("marketing").alias("s"), _reported().alias("a"))
        ),
    )
    amount, reconciled = F.col("side.a"), F.col("is_reconciled")
    return (
        mart.select("transaction_at", "is_reconciled", F.explode(sides).alias("side"))
        .where("side IS NOT NULL")
        .groupBy(
            day_of(F.col("transaction_at")).alias("report_date"),
            F.col("side.s").alias("revenue_source"),
        )
        .agg(
            F.count(F.lit(1)).alias("transaction_count"),
            total(amount).alias("gross_revenue"),
            total(F.when(reconciled, amount).otherwise(0.0)).alias("reconciled_revenue"),
            total(F.when(~reconciled, amount).otherwise(0.0)).alias("unreconciled_revenue"),
            F.count(F.lit(1)).alias("conversion_count"),
        )
    )


def revenue_summary(mart: DataFrame, reference_dates: bool = False) -> DataFrame:
    """Finance and marketing side by side per day, with variances, in day order.

    One grouping gives both sides; a side without rows on a day is null, not 0.
    With `reference_dates` days seen by marketing only have a null date, as a
    full join that shows the finance date would leave them.
    """
    reported, reconciled = _reported(), F.col("is_reconciled")

    def side(definition: str, amount: Column, name: str) -> list[Column]:
        counted = F.col(definition)
        n = F.count_if(counted)
        return [
            F.when(n > 0, n).alias(f"{name}_transaction_count"),
            F.sum(in_money(F.when(counted, amount))).alias(f"{name}_revenue"),
            total(F.when(counted, F.when(reconciled, amount).otherwise(0.0))).alias(
                f"{name}_reconciled_revenue"
            ),
        ]

    daily = (
        mart.where(F.col(FINANCE) | F.col(MARKETING))
        .groupBy(day_of(F.col("transaction_at")).alias("day"))
        .agg(
            *side(FINANCE, F.col("server_amount"), "finance"),
            *side(MARKETING, reported, "marketing"),
        )
    )
    finance, marketing = F.col("finance_revenue"), F.col("marketing_revenue")
    n_finance = F.col("finance_transaction_count")
    n_marketing = F.col("marketing_transaction_count")
    gap = (finance - marketing).cast("double")
    percent = F.lit(100.0) * gap / finance.cast("double")
    date = F.when(n_finance.isNotNull(), F.col("day")) if reference_dates else F.col("day")
    return daily.select(
        date.alias("report_date"),
        n_finance,
        n_marketing,
        finance.cast("double").alias("finance_revenue"),
        marketing.cast("double").alias("marketing_revenue"),
        gap.alias("revenue_variance"),
        "finance_reconciled_revenue",
        "marketing_reconciled_revenue",
        n_finance.alias("finance_conversions"),
        n_marketing.alias("marketing_conversions"),
        (n_marketing - n_finance).alias("conversion_count_variance"),
        F.when(finance > 0, F.round(percent.cast("decimal(28,6)"), 2).cast("double")).alias(
            "revenue_variance_pct"
        ),
    ).orderBy(F.asc_nulls_last("report_date"))


def attribution_snapshot(mart: DataFrame) -> DataFrame:
    """Per category the transactions and both revenues, most frequent first."""
    return (
        mart.groupBy("attribution_category")
        .agg(
            F.count(F.lit(1)).alias("transactions"),
            rounded_total(F.col("server_amount")).alias("server_revenue"),
            rounded_total(_reported()).alias("client_revenue"),
        )
        .orderBy(F.desc("transactions"), "attribution_category")
    )


def model_row_counts(models: Mapping[str, DataFrame]) -> DataFrame:
    """Name and number of rows of each model."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("model"), "row_count"
        )
        for name, df in models.items()
    ]
    return reduce(DataFrame.unionByName, counts)
