import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from counterfoil.operators import audit, summaries
from tests.helpers import at, client_table, server_table


@pytest.fixture(scope="module")
def tables(spark):
    return registry.Tables(spark, "/root/testdata/sf0.01")


def test_all_rules_are_confirmed(tables):
    rows = tables.verified().orderBy("rule_id").collect()
    assert [r.rule_id for r in rows] == ["R-ATTR", "R-DARK", "R-GAP", "R-VAR"]
    assert all(r.verified and r.verdict == "confirmed" and r.confidence == "high" for r in rows)
    assert rows[0].n == 514 and rows[0].amount == 24267.23
    assert rows[3].amount == 32623.80


def test_gap_is_explained_by_its_parts(tables):
    total = summaries.summary_mart(tables.mart).first()
    category = F.col("attribution_category")
    linked = F.col("conversion_definition_marketing")
    unknown = linked & F.col("conversion_definition_finance").isNull()
    server, client = F.col("server_amount"), F.col("client_reported_amount")
    parts = tables.mart.agg(
        F.round(
            F.sum(F.when(category == "finance_only", server).otherwise(0))
            - F.sum(F.when(category == "marketing_only", client).otherwise(0))
            - F.sum(F.when(unknown, client).otherwise(0))
            + F.sum(F.when(category == "both", server - client).otherwise(0)),
            2,
        ).alias("gap")
    ).first()
    assert parts.gap == total.net_revenue_gap_finance_minus_marketing == 32623.80


def test_figures_only_the_mart_shows(tables):
    altered = tables.mart.withColumn(
        "attribution_category",
        F.when(F.col("attribution_category") == "both", "marketing_only").otherwise(
            F.col("attribution_category")
        ),
    )
    findings = audit.audit_findings(altered, tables.client)
    rows = {
        r.rule_id: r for r in audit.verify(findings, tables.client, tables.server).collect()
    }
    assert rows["R-ATTR"].verdict == "modeling_artifact" and rows["R-ATTR"].verified is False
    assert rows["R-ATTR"].confidence == "low"
    assert rows["R-DARK"].verdict == "confirmed"


def test_quiet_data_gives_no_findings(spark):
    from counterfoil.operators.marts import reconcile

    client = client_table(
        spark,
        [
            ("e1", "u", at(0), "purchase_intent", 10.0),
            ("e2", "u", at(0), "session_start", 0.0),
        ],
    )
    server = server_table(spark, [("t", "u", "e1", at(1), 10.0, "completed")])
    mart = reconcile(server, client)
    assert audit.audit_findings(mart, client).isEmpty()


def test_repeated_event_ids_and_links_verify(spark):
    """Rows that the mart multiplies are multiplied in the check as well."""
    from counterfoil.operators.marts import reconcile

    client = client_table(
        spark,
        [
            ("e1", "u", at(0), "purchase_intent", 10.0),
            ("e1", "u", at(1), "purchase_intent", 11.0),
            ("e2", "u", at(0), "purchase_intent", 5.0),
        ],
    )
    server = server_table(
        spark,
        [
            ("t1", "u", "e1", at(1), 10.0, "completed"),
            ("t2", "u", "e1", at(2), 10.0, "failed"),
            ("t3", "u", "e2", at(2), 5.0, None),
            ("t4", "u", None, at(2), 6.0, "completed"),
        ],
    )
    mart = reconcile(server, client)
    assert mart.count() == 6
    verified = audit.verify(audit.audit_findings(mart, client), client, server).collect()
    assert len(verified) == 4 and all(r.verified for r in verified)


def test_report_leaves_out_known_findings(tables, spark):
    verified = tables.verified()
    report = audit.new_findings(verified).collect()
    assert [r.anomaly_id for r in report] == ["A001", "A002", "A003", "A004"]
    assert len(report[0]) == 12
    known = spark.createDataFrame([(report[0].description,)], "description string")
    fresh = audit.new_findings(verified, known, numbered_from=5, iteration=2).collect()
    assert [r.anomaly_id for r in fresh] == ["A005", "A006", "A007"]
    assert fresh[0].category == "DARK_REVENUE" and fresh[0].iteration == 2
    assert audit.new_findings(verified, verified).isEmpty()


def test_missing_event_types(tables):
    rows = audit.missing_event_types(tables.client, ["page_view", "session_start"]).collect()
    assert [r.event_name for r in rows] == ["session_start"]
