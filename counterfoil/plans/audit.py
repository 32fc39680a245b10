"""Findings from the exported mart and the clean tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from counterfoil.operators.audit import audit_findings, new_findings, verify
from counterfoil.operators.staging import stg_client_events, stg_server_logs
from counterfoil.sources.feeds import CLIENT, SERVER
from counterfoil.sources.records import read_clean
from counterfoil.sources.sinks import write_json

# Columns of the exported mart, in order.
MART_SCHEMA = """
    transaction_id string, user_id string, transaction_at timestamp, transaction_status string,
    server_amount double, client_reported_amount double, variance double, is_reconciled boolean,
    has_client_event boolean, client_event_id string, conversion_definition_marketing boolean,
    conversion_definition_finance boolean, attribution_category string
"""


def report_findings(
    spark: SparkSession, clean: str, mart: str, out: str, history: str | None = None
) -> DataFrame:
    """Write the report below `out` and give it; `history` is an earlier report."""
    events = read_clean(spark, f"{clean}/{CLIENT.name}_clean", CLIENT)
    client = stg_client_events(events)
    server = stg_server_logs(read_clean(spark, f"{clean}/{SERVER.name}_clean", SERVER))
    exported = spark.read.schema(MART_SCHEMA).option("mode", "FAILFAST").json(mart)
    earlier = spark.read.schema("description string").json(history) if history else None
    report = new_findings(verify(audit_findings(exported, events), client, server), earlier)
    write_json(report, f"{out}/findings")
    return spark.read.schema(report.schema).json(f"{out}/findings")
