"""Corrective views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfoil.functions.money import in_money
from counterfoil.functions.times import micros
from counterfoil.operators.timeline import count_before

# Activity that counts as a sign of a session.
SESSION_ACTIVITY = ("page_view", "add_to_cart")

# Labels and notes of the four revenue definitions.
DEFINITIONS = {
    "finance_completed": (
        "Server-side completed transactions only. Source of truth for financial reporting."
    ),
    "marketing_purchase_intents": (
        "Client-side purchase_intent events. Used for attribution only, "
        "not financial reporting."
    ),
    "variance_dark_revenue": (
        "Completed server transactions with no client event. "
        "Finance sees this; marketing cannot attribute it."
    ),
    "variance_failed_but_tracked": (
        "Marketing counted these as conversions but the payment failed. "
        "Finance correctly excludes them."
    ),
}


def correct_marketing(mart: DataFrame) -> DataFrame:
    """The mart with a marketing flag that needs a completed payment.

    An unknown finance flag leaves the marketing flag as it was and the
    over-count flag unknown.
    """
    claimed = F.col("conversion_definition_marketing")
    overcounted = claimed & ~F.col("conversion_definition_finance")
    return mart.withColumns(
        {
            "conversion_definition_marketing_corrected": claimed
            & ~F.coalesce(overcounted, F.lit(False)),
            "was_overcounted_by_marketing": overcounted,
        }
    )


def tag_channel(server: DataFrame) -> DataFrame:
    """The transactions with a channel and a flag for those without a link."""
    dark = F.col("client_event_id").isNull()
    return server.withColumns(
        {
            "attribution_channel": F.when(dark, "unattributed").otherwise("client_tracked"),
            "is_dark_transaction": dark,
        }
    )


def session_check(client: DataFrame, minutes: int = 60) -> DataFrame:
    """Purchase events with the browsing of the same user in the minutes before.

    The span includes its start and excludes the purchase itself. Purchases
    without a user, a time or an event id have no preceding activity.
    """
    name = F.col("event_name")
    events = client.withColumns(
        {
            "key": F.col("user_id"),
            "at_us": micros(F.col("event_at")),
            "tie": F.xxhash64("event_id"),
        }
    )
    placed = F.col("key").isNotNull() & F.col("at_us").isNotNull() & F.col("event_id").isNotNull()
    bought = name == "purchase_intent"
    counted = count_before(
        events.where(placed & bought).select(
            "key", "at_us", "tie", F.struct(*client.columns).alias("row")
        ),
        events.where(placed & name.isin(*SESSION_ACTIVITY)).select(
            "key", "at_us", "tie", F.lit(1).alias("weight")
        ),
        minutes * 60,
    ).select("row.*", "preceding")
    none = events.where(bought & ~placed).select(*client.columns, F.lit(0).alias("preceding"))
    found = F.col("preceding")
    return counted.unionByName(none).select(
        *client.columns,
        (found > 0).alias("has_preceding_session_activity"),
        found.alias("preceding_event_count"),
    )


def revenue_decomposition(mart: DataFrame) -> DataFrame:
    """Four labelled totals that explain the gap, always four rows, from one pass."""
    server = F.col("server_amount")
    client = F.coalesce("client_reported_amount", F.lit(0.0))
    category = F.col("attribution_category")
    finance = F.col("conversion_definition_finance")
    parts = {
        "finance_completed": (finance, server),
        "marketing_purchase_intents": (F.col("conversion_definition_marketing"), client),
        "variance_dark_revenue": ((category == "finance_only") & finance, server),
        "variance_failed_but_tracked": (category == "marketing_only", client),
    }
    rows = [
        F.struct(
            F.lit(label).alias("revenue_definition"),
            F.count_if(counted).alias("transaction_count"),
            F.round(F.sum(in_money(F.when(counted, amount))), 2)
            .cast("double")
            .alias("total_revenue"),
            F.lit(DEFINITIONS[label]).alias("definition_note"),
        )
        for label, (counted, amount) in parts.items()
    ]
    return mart.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))
