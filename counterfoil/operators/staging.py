"""Typed staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfoil.functions.money import fits
from counterfoil.functions.values import instant, is_variant, number, text


def _property(clean: DataFrame, name: str, type_name: str, strict: bool) -> Column:
    """One entry of the property bag, which is a VARIANT, a struct or JSON text."""
    kind = clean.schema["properties"].dataType
    if isinstance(kind, T.StructType):
        if name not in kind.names:
            return F.lit(None).cast(type_name)
        entry = F.col(f"properties.`{name}`")
        return entry.cast(type_name) if strict else entry.try_cast(type_name)
    bag = F.col("properties") if is_variant(clean, "properties") else F.try_parse_json("properties")
    get = F.variant_get if strict else F.try_variant_get
    return get(bag, f"$.{name}", type_name)


def _bag_text(clean: DataFrame) -> Column:
    if isinstance(clean.schema["properties"].dataType, T.StringType):
        return F.col("properties")
    return F.to_json("properties", {"ignoreNullFields": "false"})


def summable(amount: Column, strict: bool = False) -> Column:
    """The amount; one too large for exact sums counts as unreadable."""
    found = F.when(fits(amount), amount)
    if strict:
        why = F.concat(F.lit("amount out of range: "), amount.cast("string"))
        found = F.when(~fits(amount), F.raise_error(why).cast("double")).otherwise(amount)
    return found


def event_value(clean: DataFrame, strict: bool = False) -> Column:
    value = _property(clean, "value", "double", strict)
    return F.coalesce(summable(value, strict), F.lit(0.0))


def stg_client_events(clean: DataFrame, strict: bool = False) -> DataFrame:
    """Client events with types, promoted properties and the conversion flag.

    Unreadable values become null unless `strict`, which raises. The bag stays
    whole in `properties_raw`. One narrow projection; columns that a later step
    does not read are never computed.
    """
    name = F.lower(text(clean, "event_name", strict))
    empty = F.lit("")
    return clean.select(
        text(clean, "event_id", strict).alias("event_id"),
        text(clean, "user_id", strict).alias("user_id"),
        instant(clean, "timestamp", strict).alias("event_at"),
        name.alias("event_name"),
        event_value(clean, strict).alias("event_value"),
        F.coalesce(_property(clean, "product_id", "string", strict), empty).alias("product_id"),
        F.coalesce(_property(clean, "url", "string", strict), empty).alias("page_url"),
        F.coalesce(_property(clean, "source", "string", strict), empty).alias("traffic_source"),
        _bag_text(clean).alias("properties_raw"),
        F.lit("client").alias("_source"),
        F.col("_extracted_at").cast("timestamp").alias("_extracted_at"),
        F.coalesce(name == "purchase_intent", F.lit(False)).alias("is_conversion_client"),
    )


def stg_server_logs(clean: DataFrame, strict: bool = False) -> DataFrame:
    """Server transactions with types and status flags.

    A blank link becomes null, any other link is kept untrimmed. Statuses are an
    open set: unknown ones pass with all flags false, a null status gives null
    flags.
    """
    link = text(clean, "ext_id", strict)
    typed = clean.select(
        text(clean, "tx_id", strict).alias("transaction_id"),
        text(clean, "user_id", strict).alias("user_id"),
        F.when(F.trim(link) != "", link).alias("client_event_id"),
        instant(clean, "timestamp", strict).alias("transaction_at"),
        F.coalesce(summable(number(clean, "amount", strict), strict), F.lit(0.0)).alias("transaction_amount"),
        F.lower(text(clean, "status", strict)).alias("transaction_status"),
        F.lit("server").alias("_source"),
        F.col("_extracted_at").cast("timestamp").alias("_extracted_at"),
    )
    status = F.col("transaction_status")
    return typed.select(
        "*",
        (status == "completed").alias("is_completed"),
        (status == "failed").alias("is_failed"),
        (status == "refunded").alias("is_refunded"),
        (status == "completed").alias("is_revenue_recognized"),
    )
