"""Clean tables to staging, journey and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from counterfoil.operators.journey import user_journey
from counterfoil.operators.marts import (
    attribution_snapshot,
    model_row_counts,
    reconcile,
    revenue_summary,
)
from counterfoil.operators.staging import stg_client_events, stg_server_logs
from counterfoil.plans.tables import written
from counterfoil.sources.feeds import CLIENT, SERVER
from counterfoil.sources.records import read_clean
from counterfoil.sources.sinks import publish, published, save_models, save_version, write_json


def build_models(
    client_clean: DataFrame,
    server_clean: DataFrame,
    strict: bool = False,
    write: bool = False,
    db: str | None = None,
) -> dict[str, DataFrame]:
    """The five models by name, in the order in which they depend on each other.

    With `write` the tables that others read (both staging tables and the
    reconciliation mart) are written to the shared work folder first; with `db` they
    are saved there, as a version that is not published yet, and the rest is built from those.
    """
    spark = client_clean.sparkSession
    version = None if db is None else published(spark, db) + 1

    def keep(df: DataFrame, name: str) -> DataFrame:
        if db is not None:
            return save_version(df, db, name, version)
        return written(df, name) if write else df

    client = stg_client_events(client_clean, strict)
    # Purchase events next to each other let the mart skip most row groups.
    client = keep(client.sortWithinPartitions("event_name") if write or db else client, "stg_client_events")
    server = keep(stg_server_logs(server_clean, strict), "stg_server_logs")
    mart = keep(reconcile(server, client), "mart_reconciliation")
    return {
        "stg_client_events": client,
        "stg_server_logs": server,
        "int_user_journey": user_journey(client, server),
        "mart_reconciliation": mart,
        "mart_revenue_summary": revenue_summary(mart),
    }


def derive_models(
    spark: SparkSession, clean: str, out: str, db: str | None = None, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Register or save the models and export the mart; give row counts and the snapshot."""
    models = build_models(
        read_clean(spark, f"{clean}/{CLIENT.name}_clean", CLIENT),
        read_clean(spark, f"{clean}/{SERVER.name}_clean", SERVER),
        strict,
        write=True,
        db=db,
    )
    if db is None:
        save_models(models)
    else:
        version = published(spark, db) + 1
        for name in ("int_user_journey", "mart_revenue_summary"):
            models[name] = save_version(models[name], db, name, version)
        publish(spark, db, list(models), version)
    write_json(models["mart_reconciliation"], f"{out}/mart_reconciliation")
    return model_row_counts(models), attribution_snapshot(models["mart_reconciliation"])
