"""User journey: each client event with its best transaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from counterfoil.functions.times import micros, seconds_between
from counterfoil.operators.timeline import SECOND, nearest

# Columns taken over from the two staging tables, in order.
CLIENT_COLUMNS = (
    "event_id",
    "user_id",
    "event_at",
    "event_name",
    "event_value",
    "product_id",
    "page_url",
    "traffic_source",
    "is_conversion_client",
)
SERVER_COLUMNS = (
    "transaction_id",
    "transaction_at",
    "transaction_amount",
    "transaction_status",
    "client_event_id",
    "is_completed",
    "is_failed",
    "is_refunded",
    "is_revenue_recognized",
)


# Spaces of a timeline: events and transactions of one user, or with one event id.
BY_USER, BY_LINK = 0, 1


def transaction(server: DataFrame) -> Column:
    """The transaction columns of a journey as one struct."""
    return F.struct(*[F.col(c) for c in SERVER_COLUMNS])


def candidates(
    client: DataFrame, server: DataFrame, window_s: int = 300, prefer_link: bool = False
) -> DataFrame:
    """Client events with struct `tx`: the nearest transaction of their user or none.

    With `prefer_link`, transactions that name an event are left to it, and the nearest
    of those that name it (`_linked` = 1) is a second candidate of an event. Both kinds of match
    go through one lookup.
    """
    event_us, transaction_us = micros(F.col("event_at")), micros(F.col("transaction_at"))
    link = F.col("client_event_id")
    row = F.struct(*CLIENT_COLUMNS)
    placed = F.col("user_id").isNotNull() & F.col("event_at").isNotNull()

    def asked(events: DataFrame, space: int, key: str, reach: int | None) -> DataFrame:
        return events.select(
            F.lit(space).alias("space"),
            F.col(key).alias("key"),
            event_us.alias("at_us"),
            F.lit(reach).cast("bigint").alias("reach_us"),
            F.xxhash64("event_id", "user_id", "event_at").alias("tie"),
            F.struct(F.lit(space).alias("_linked"), row.alias("event")).alias("row"),
        )

    def offered(transactions: DataFrame, space: int, key: str) -> DataFrame:
        return transactions.select(
            F.lit(space).alias("space"),
            F.col(key).alias("key"),
            transaction_us.alias("at_us"),
            F.col("transaction_id").alias("id"),
            transaction(server).alias("target"),
        )

    timed = server.where("user_id IS NOT NULL AND transaction_at IS NOT NULL")
    probes = asked(client.where(placed), BY_USER, "user_id", window_s * SECOND)
    if prefer_link:
        named = client.where("event_id IS NOT NULL")
        probes = probes.unionByName(asked(named, BY_LINK, "event_id", None))
        targets = offered(timed.where(link.isNull()), BY_USER, "user_id").unionByName(
            offered(server.where(link.isNotNull()), BY_LINK, "client_event_id")
        )
    else:
        targets = offered(timed, BY_USER, "user_id")
    found = nearest(probes, targets).select(
        "row.event.*", F.col("row._linked").alias("_linked"), F.col("target").alias("tx")
    )
    nothing = F.lit(None).cast(found.schema["tx"].dataType)
    unplaced = client.where(~placed).select(
        *CLIENT_COLUMNS, F.lit(BY_USER).alias("_linked"), nothing.alias("tx")
    )
    every = found.where(f"_linked = {BY_USER} OR tx IS NOT NULL").unionByName(unplaced)
    return every if prefer_link else every.drop("_linked")


def _best_per_event(rows: DataFrame) -> DataFrame:
    """One row per event_id; all rows without an event_id count as one event."""
    order = [F.desc("_linked")] if "_linked" in rows.columns else []
    best = W.partitionBy("event_id").orderBy(
        *order,
        F.asc_nulls_last(seconds_between(F.col("event_at"), F.col("tx.transaction_at"))),
        "tx.transaction_at",
        "tx.transaction_id",
        "event_at",
        "user_id",
    )
    return rows.withColumn("_rank", F.row_number().over(best)).where("_rank = 1")


def _journey_columns(rows: DataFrame) -> DataFrame:
    link = F.col("tx.client_event_id")
    return rows.select(
        *CLIENT_COLUMNS,
        *[
            F.col(f"tx.{c}").alias("server_reported_event_id" if c == "client_event_id" else c)
            for c in SERVER_COLUMNS
        ],
        seconds_between(F.col("event_at"), F.col("tx.transaction_at")).alias("time_delta_seconds"),
        F.col("tx.transaction_id").isNull().alias("is_unmatched_client_event"),
        F.coalesce(link != F.col("event_id"), F.lit(False)).alias("has_conflicting_ext_id"),
    )


def best_journey(rows: DataFrame) -> DataFrame:
    """Journey rows from events with any number of candidate transactions `tx`."""
    return _journey_columns(_best_per_event(rows))


def user_journey(
    client: DataFrame,
    server: DataFrame,
    window_s: int = 300,
    prefer_link: bool = False,
    unique_ids: bool = False,
) -> DataFrame:
    """Each client event with the nearest transaction of the same user, if any.

    The window is inclusive on both sides. With `prefer_link` a transaction that
    names the event wins, and only transactions without a link are matched by
    time. A transaction may serve several events. Where event ids are known to
    be unique, `unique_ids` saves the last shuffle (time matching only).
    """
    rows = candidates(client, server, window_s, prefer_link)
    return _journey_columns(rows) if unique_ids and not prefer_link else best_journey(rows)
