"""Rule-based findings over the mart, checked against the staged sources.

Each rule gives one row with a count and an amount. Detection reads them from
the mart, verification computes them again from the two staging tables by
another route, and a finding is confirmed when both agree to the cent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from counterfoil.functions.money import in_money
from counterfoil.functions.values import text
from counterfoil.sources.feeds import CLIENT

# Severity and category of each rule, in report order.
RULES = {
    "R-ATTR": ("high", "ATTRIBUTION_ERROR"),
    "R-DARK": ("high", "DARK_REVENUE"),
    "R-GAP": ("medium", "TRACKING_GAP"),
    "R-VAR": ("high", "REVENUE_VARIANCE"),
}

# Verdicts.
CONFIRMED, ARTIFACT = "confirmed", "modeling_artifact"

DESCRIPTIONS = {
    "R-ATTR": "%d transactions without a completed payment have a purchase event;"
    " marketing counts %.2f for them.",
    "R-DARK": "%d completed transactions worth %.2f have no purchase event.",
    "R-GAP": "The client feed holds %d session_start events.",
    "R-VAR": "Over %d transactions, recognised revenue exceeds reported revenue by %.2f.",
}

IMPACTS = {
    "R-ATTR": "%.2f of conversion credit without revenue.",
    "R-DARK": "%.2f of revenue without attribution.",
    "R-GAP": "Session to purchase rates cannot be computed.",
    "R-VAR": "%.2f between the two reports.",
}

FIXES = {
    "R-ATTR": "Count a purchase event as a conversion only once its payment is completed.",
    "R-DARK": "Record the sales channel when a transaction is created.",
    "R-GAP": "Send session_start from the browser and check that no filter removes it.",
    "R-VAR": "Report both definitions with the categories that separate them.",
}

EXPLANATIONS = {
    "R-ATTR": "The event fires at checkout, the payment is decided afterwards.",
    "R-DARK": "These transactions were created outside the browser.",
    "R-GAP": "The event is not part of what the browser sends.",
    "R-VAR": "Untracked revenue and unpaid purchase events do not cancel out.",
}

NOT_SHOWN = "The staged sources do not show the figures of the mart."


def _cents(amount: Column) -> Column:
    return F.round(amount, 2).cast("double")


def _sum(amount: Column) -> Column:
    return F.coalesce(F.sum(amount), F.lit(0))


def _figure(rule: str, n: Column, amount: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule_id"),
        n.cast("bigint").alias("n"),
        amount.cast("double").alias("amount"),
    )


def _figures(totals: DataFrame, *figures: Column) -> DataFrame:
    return totals.select(F.inline(F.array(*figures)))


def _session_figure(client: DataFrame) -> DataFrame:
    starts = client.agg(F.count_if(text(client, "event_name") == "session_start").alias("n"))
    return _figures(starts, _figure("R-GAP", F.col("n"), F.lit(None)))


def _mart_figures(mart: DataFrame) -> DataFrame:
    category = F.col("attribution_category")
    server = in_money(F.col("server_amount"))
    client = in_money(F.col("client_reported_amount"))
    failed, dark = category == "marketing_only", category == "finance_only"
    totals = mart.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(failed).alias("n_failed"),
        _sum(F.when(failed, client)).alias("failed"),
        F.count_if(dark).alias("n_dark"),
        _sum(F.when(dark, server)).alias("dark"),
        _sum(F.when(F.col("conversion_definition_finance"), server)).alias("finance"),
        _sum(F.when(F.col("conversion_definition_marketing"), client)).alias("marketing"),
    )
    return _figures(
        totals,
        _figure("R-ATTR", F.col("n_failed"), _cents(F.col("failed"))),
        _figure("R-DARK", F.col("n_dark"), _cents(F.col("dark"))),
        _figure("R-VAR", F.col("n"), _cents(F.col("finance") - F.col("marketing"))),
    )


def _source_figures(client: DataFrame, server: DataFrame) -> DataFrame:
    """The same figures from the staging tables.

    Both sides are grouped by the link first, so a link shared by very many
    transactions, and all transactions without one, are single rows by the time
    they are joined.
    """
    amount = in_money(F.col("transaction_amount"))
    recognised = F.col("is_revenue_recognized")
    by_link = server.groupBy(F.col("client_event_id").alias("link")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(recognised).alias("n_paid"),
        F.count_if(~recognised).alias("n_unpaid"),
        _sum(F.when(recognised, amount)).alias("paid"),
    )
    by_event = (
        client.where("event_name = 'purchase_intent'")
        .groupBy(F.col("event_id").alias("link"))
        .agg(F.count(F.lit(1)).alias("events"), F.sum(in_money(F.col("event_value"))).alias("v"))
    )
    untracked = F.col("events").isNull()
    copies = F.coalesce("events", F.lit(1))
    totals = by_link.join(by_event, "link", "left").agg(
        _sum(F.col("n") * copies).alias("n"),
        _sum(F.col("n_unpaid") * F.col("events")).alias("n_failed"),
        _sum(F.col("n_unpaid") * F.col("v")).alias("failed"),
        _sum(F.when(untracked, F.col("n_paid"))).alias("n_dark"),
        _sum(F.when(untracked, F.col("paid"))).alias("dark"),
        _sum(F.col("paid") * copies).alias("finance"),
        _sum(F.col("n") * F.col("v")).alias("marketing"),
    )
    return _figures(
        totals,
        _figure("R-ATTR", F.col("n_failed"), _cents(F.col("failed"))),
        _figure("R-DARK", F.col("n_dark"), _cents(F.col("dark"))),
        _figure("R-VAR", F.col("n"), _cents(F.col("finance") - F.col("marketing"))),
    )


def _per_rule(texts: dict[str, Column | str]) -> Column:
    """The text that belongs to the rule of the row."""
    chosen = F.lit(None).cast("string")
    for rule, value in texts.items():
        value = F.lit(value) if isinstance(value, str) else value
        chosen = F.when(F.col("rule_id") == rule, value).otherwise(chosen)
    return chosen


def audit_findings(mart: DataFrame, client: DataFrame) -> DataFrame:
    """One row per rule that fires, with its figures.

    `client` is the clean table (raw event names), so that a gap that only comes from
    the way names are written is not confirmed from the staged one; it may be the staged
    table as well.
    """
    figures = _mart_figures(mart).unionByName(_session_figure(client))
    fires = (
        F.when(F.col("rule_id").isin("R-ATTR", "R-DARK"), F.col("n") > 0)
        .when(F.col("rule_id") == "R-GAP", F.col("n") == 0)
        .otherwise(F.col("amount") != 0)
    )
    return figures.where(fires).select(
        "rule_id",
        "n",
        "amount",
        _per_rule({r: F.format_string(t, "n", "amount") for r, t in DESCRIPTIONS.items()}).alias(
            "description"
        ),
        _per_rule({r: severity for r, (severity, _) in RULES.items()}).alias("severity"),
        _per_rule({r: category for r, (_, category) in RULES.items()}).alias("category"),
        _per_rule({r: F.format_string(t, "amount") for r, t in IMPACTS.items()}).alias(
            "financial_impact"
        ),
        _per_rule(FIXES).alias("recommended_fix"),
    )


def verify(findings: DataFrame, client: DataFrame, server: DataFrame) -> DataFrame:
    """Findings with verdict, evidence and confidence, judged by the staged sources only."""
    sources = (
        _source_figures(client, server)
        .unionByName(_session_figure(client))
        .select("rule_id", F.col("n").alias("source_n"), F.col("amount").alias("source_amount"))
    )
    agree = F.col("n").eqNullSafe(F.col("source_n")) & F.col("amount").eqNullSafe(
        F.col("source_amount")
    )
    evidence = F.when(
        F.col("source_amount").isNull(), F.format_string("Sources: %d rows.", "source_n")
    ).otherwise(F.format_string("Sources: %d rows, %.2f.", "source_n", "source_amount"))
    return (
        findings.join(sources, "rule_id", "left")
        .withColumn("verified", agree)
        .select(
            *findings.columns,
            "verified",
            F.when(F.col("verified"), CONFIRMED).otherwise(ARTIFACT).alias("verdict"),
            evidence.alias("raw_evidence"),
            F.when(F.col("verified"), _per_rule(EXPLANATIONS))
            .otherwise(NOT_SHOWN)
            .alias("explanation"),
            F.when(F.col("verified"), "high").otherwise("low").alias("confidence"),
        )
    )


def new_findings(
    findings: DataFrame,
    history: DataFrame | None = None,
    numbered_from: int = 1,
    iteration: int = 1,
) -> DataFrame:
    """The report: findings whose description no earlier run had, numbered in rule order.

    There is at most one finding per rule, so the numbering window holds no more
    rows than there are rules.
    """
    fresh = findings
    if history is not None:
        fresh = findings.join(history.select("description").distinct(), "description", "left_anti")
    place = F.row_number().over(W.orderBy("rule_id")) + F.lit(numbered_from - 1)
    return fresh.select(
        F.format_string("A%03d", place).alias("anomaly_id"),
        F.coalesce("description", F.lit("")).alias("description"),
        F.coalesce("severity", F.lit("medium")).alias("severity"),
        F.coalesce("category", F.lit("UNKNOWN")).alias("category"),
        F.coalesce("financial_impact", F.lit("")).alias("financial_impact"),
        "verified",
        "verdict",
        "raw_evidence",
        "explanation",
        F.coalesce("confidence", F.lit("low")).alias("confidence"),
        F.coalesce("recommended_fix", F.lit("")).alias("recommended_fix"),
        F.lit(iteration).alias("iteration"),
    )


def missing_event_types(
    client: DataFrame, expected: Sequence[str] = CLIENT.enums["event_name"]
) -> DataFrame:
    """Expected event names that never occur."""
    names = F.array(*[F.lit(name) for name in expected])
    wanted = client.sparkSession.range(1).select(F.explode(names).alias("event_name"))
    observed = client.where(F.col("event_name").isin(list(expected))).select("event_name")
    return wanted.join(observed.distinct(), "event_name", "left_anti")


def report_counts(report: DataFrame) -> DataFrame:
    """One row: number of findings and how many of them were verified."""
    return report.agg(
        F.count(F.lit(1)).alias("findings"), F.count_if("verified").alias("verified_findings")
    )
