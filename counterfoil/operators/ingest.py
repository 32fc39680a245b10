"""Deduplication, validation and normalisation of raw records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from counterfoil.functions.money import LIMIT, fits
from counterfoil.functions.times import is_iso
from counterfoil.functions.values import (
    as_variant,
    instant,
    is_json,
    is_present,
    is_variant,
    json_name,
    json_schema,
    number,
    shown,
    text,
    truthy,
)
from counterfoil.sources.feeds import ID_KEYS, Feed
from counterfoil.sources.records import number_records

# Kinds and texts of violations.
MISSING = "MISSING_FIELD field=%s record=%s"
MISMATCH = "TYPE_MISMATCH field=%s expected=%s actual=%s record=%s"
UNKNOWN = "UNKNOWN_ENUM field=%s value=%s allowed=%s record=%s"
BAD_TIME = "BAD_TIMESTAMP value=%s record=%s"
TOO_LARGE = "AMOUNT_OUT_OF_RANGE field=%s value=%s record=%s"
UNREADABLE = "UNREADABLE_RECORD record=%s"


# --- duplicates -----------------------------------------------------------------


def key_text(df: DataFrame, name: str) -> Column:
    """Text under which a key column takes part in deduplication.

    An absent key counts as '' and a JSON null as 'None', so neither is skipped
    and the number 5 equals the text '5'.
    """
    as_text = text(df, name)
    if not is_variant(df, name):
        return F.coalesce(as_text, F.lit("None"))
    return (
        F.when(F.col(name).isNull(), F.lit(""))
        .when(F.is_variant_null(name), F.lit("None"))
        .when(F.schema_of_variant(name) == "BOOLEAN", F.initcap(as_text))
        .otherwise(as_text)
    )


def key_hash(df: DataFrame, key_cols: Sequence[str]) -> Column:
    """128 bits of the key columns, each with its length, so that columns do not run together."""
    texts = [key_text(df, c) for c in key_cols]
    sized = [part for t in texts for part in (F.octet_length(t).cast("string"), F.lit(":"), t)]
    # Never null, which the optimiser must know or it works the hash out twice.
    return F.coalesce(F.unhex(F.md5(F.concat(*sized).cast("binary"))), F.lit(b""))


def arrival(df: DataFrame, order_col: str) -> tuple[DataFrame, Column, Column]:
    """df with what its order needs, the order of its rows as one number, and their number.

    Both are whole numbers of 64 bits. Rows of a landed table have a number of their own;
    their order is that of their file block, ranked over all blocks, and then of the row.
    """
    kind = df.schema[order_col].dataType
    if not isinstance(kind, T.StructType):
        number = F.col(order_col).cast("bigint")
        return df, number, number
    pos = F.col(order_col)
    block = [pos["file"].alias("_file"), pos["block"].alias("_block")]
    blocks = df.select(*block).distinct()
    ranked = blocks.withColumn("_rank", F.row_number().over(W.orderBy("_file", "_block")))
    same = (pos["file"] == F.col("_file")) & (pos["block"] == F.col("_block"))
    row = pos["row"].bitwiseAND(F.lit((1 << 33) - 1))  # within its task
    order = F.shiftleft(F.col("_rank").cast("bigint"), 33).bitwiseOR(row)
    return df.join(ranked, same), order, pos["row"]


def _decided(
    df: DataFrame, key_cols: Sequence[str], order_col: str, **values: Column
) -> tuple[DataFrame, DataFrame]:
    """Narrow rows (_key, _order, _number and values), and the groups of their keys.

    A group is its first row's order, the values of that row, and its number of records.
    Nothing here has a buffer of changing width, so groups are hashed, not sorted.
    """
    columns = [c for c in df.columns if c in {order_col, *key_cols}]
    source = df.select(*columns) if not values else df
    ordered, order, number = arrival(source, order_col)
    narrow = ordered.select(
        key_hash(df, key_cols).alias("_key"),
        order.alias("_order"),
        number.alias("_number"),
        *[v.alias(name) for name, v in values.items()],
    )
    groups = narrow.groupBy("_key").agg(
        F.min("_order").alias("_first"),
        F.count(F.lit(1)).alias("_copies"),
        *[F.min_by(name, "_order").alias(name) for name in values],
    )
    return narrow, groups


def dedup(
    df: DataFrame, key_cols: Sequence[str], order_col: str = "pos", copies: str | None = None
) -> DataFrame:
    """Keep the first record per key in arrival order.

    Keys are compared column by column, by a hash of 128 bits. Which record stays is
    decided on rows of hash and position alone; then only the losers are taken out of the
    records, which are neither sorted nor, where losers are few enough to be broadcast,
    moved. `order_col` is the position of a landed record or a whole number, and differs
    from record to record. `copies` names a column for the number of records the kept one
    stands for.
    """
    narrow, groups = _decided(df, key_cols, order_col)
    repeated = narrow.join(groups.where("_copies > 1"), "_key")
    number = F.col(order_col)
    if isinstance(df.schema[order_col].dataType, T.StructType):
        number = number["row"]
    marked = repeated.select(
        "_number", F.when(F.col("_order") == F.col("_first"), F.col("_copies")).alias("_stands_for")
    )
    if copies is None:
        marked = marked.where("_stands_for IS NULL")
    # Not an anti join: that would be repeated for each part of a union.
    found = df.join(marked, number == F.col("_number"), "left").where(
        "_number IS NULL OR _stands_for IS NOT NULL"
    )
    counted = [F.coalesce("_stands_for", F.lit(1)).cast("bigint").alias(copies)] if copies else []
    return found.select(*df.columns, *counted)


# --- violations -------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """One rule: when it is broken and what was expected of which field."""

    broken: Column
    kind: str
    field: str
    expected: str
    value: Column | None = None

    def report(self) -> Column:
        value = F.lit(None).cast("variant") if self.value is None else self.value
        return F.when(
            self.broken,
            F.struct(
                F.lit(self.kind).alias("kind"),
                F.lit(self.field).alias("field"),
                F.lit(self.expected).alias("expected"),
                value.alias("value"),
            ),
        )


def _schema(field: str) -> Column:
    return F.col(f"_schema_{field}")


def with_schemas(df: DataFrame, feed: Feed) -> DataFrame:
    """Add what the rules ask more than once, so that it is worked out once per record.

    The JSON schema of each declared field, and whether the timestamp reads.
    """
    facts = {f"_schema_{f}": json_schema(df, f) for f in feed.types if f in df.columns}
    if "timestamp" in df.columns:
        facts["_readable"] = is_iso(text(df, "timestamp")) & instant(df, "timestamp").isNotNull()
    return df.withColumns(facts)


def _missing(field: str, types: Sequence[str]) -> Check:
    return Check(F.col(field).isNull(), "MISSING_FIELD", field, "/".join(types))


def _mismatch(df: DataFrame, field: str, types: Sequence[str]) -> Check:
    # A boolean passes where numbers are expected.
    accepted = [*types, "bool"] if "int" in types else list(types)
    broken = is_present(_schema(field)) & ~is_json(_schema(field), *accepted)
    return Check(broken, "TYPE_MISMATCH", field, "/".join(types), as_variant(df, field))


def _unknown_enum(df: DataFrame, field: str, allowed: Sequence[str]) -> Check:
    known = is_json(_schema(field), "str") & text(df, field).isin(list(allowed))
    listed = "[" + ", ".join(f"'{a}'" for a in sorted(allowed)) + "]"
    broken = is_present(_schema(field)) & ~known
    return Check(broken, "UNKNOWN_ENUM", field, listed, as_variant(df, field))


def _bad_timestamp(df: DataFrame) -> Check:
    schema = _schema("timestamp")
    broken = truthy(df, "timestamp", schema) & ~F.coalesce("_readable", F.lit(False))
    return Check(broken, "BAD_TIMESTAMP", "timestamp", "ISO 8601", as_variant(df, "timestamp"))


def _too_large(df: DataFrame, field: str, amount: Column) -> Check:
    value = amount.cast("variant")
    return Check(~fits(amount), "AMOUNT_OUT_OF_RANGE", field, f"below {LIMIT:.0e}", value)


def checks(df: DataFrame, feed: Feed) -> list[Check]:
    """All rules that apply to the columns of `df`, in report order."""
    found: list[Check] = []
    for field, types in feed.types.items():
        if field in df.columns:
            if field in feed.fields and is_variant(df, field):
                found.append(_missing(field, types))
            found.append(_mismatch(df, field, types))
    found += [_unknown_enum(df, f, a) for f, a in feed.enums.items() if f in df.columns]
    if "timestamp" in df.columns:
        found.append(_bad_timestamp(df))
    if "amount" in df.columns:
        found.append(_too_large(df, "amount", number(df, "amount")))
    if "properties" in df.columns and is_variant(df, "properties"):
        value = F.try_variant_get("properties", "$.value", "double")
        found.append(_too_large(df, "properties.value", value))
    return found


def record_id(df: DataFrame) -> Column:
    """First non-empty id of the record; null when it has none."""
    present = [key for key in ID_KEYS if key in df.columns]
    known = {key: _schema(key) for key in present if f"_schema_{key}" in df.columns}
    return F.coalesce(*[F.when(truthy(df, k, known.get(k)), text(df, k)) for k in present])


def _rows(
    df: DataFrame, feed: Feed, rules: Sequence[Check], records: DataFrame | None = None
) -> DataFrame:
    rows = (
        with_schemas(df, feed)
        .transform(
            lambda d: d.select(
                record_id(d).alias("rec_id"),
                *[c for c in ("pos", "record_no") if c in d.columns],
                F.explode(F.array(*[rule.report() for rule in rules])).alias("_v"),
            )
        )
        .where("_v IS NOT NULL")
    )
    if records is not None:
        rows = number_records(rows, records)
    place = F.col("record_no") if "record_no" in rows.columns else F.lit(None)
    value, rec = F.col("_v.value"), F.coalesce("rec_id", F.lit("?"))
    return (
        rows.select(
            F.lit(feed.name).alias("source"),
            F.coalesce("rec_id", F.concat(F.lit("idx:"), place.cast("string"))).alias("rec_id"),
            "_v.kind",
            "_v.field",
            shown(value).alias("value"),
            "_v.expected",
            json_name(value).alias("actual"),
        )
        .withColumn(
            "message",
            F.when(F.col("kind") == "MISSING_FIELD", F.format_string(MISSING, "field", rec))
            .when(
                F.col("kind") == "TYPE_MISMATCH",
                F.format_string(MISMATCH, "field", "expected", "actual", rec),
            )
            .when(
                F.col("kind") == "UNKNOWN_ENUM",
                F.format_string(UNKNOWN, "field", "value", "expected", rec),
            )
            .when(
                F.col("kind") == "AMOUNT_OUT_OF_RANGE",
                F.format_string(TOO_LARGE, "field", "value", rec),
            )
            .otherwise(F.format_string(BAD_TIME, "value", rec)),
        )
    )


def drift(df: DataFrame, feed: Feed, records: DataFrame | None = None) -> DataFrame:
    """One row per violation: source, rec_id, kind, field, value, expected, actual, message.

    Violating records are only listed here, never dropped. A record without an
    id is named by its place in the file, counting duplicates; pass the raw
    `records` to have the place worked out (only violations are joined for it).
    No shuffle is needed otherwise.
    """
    return _rows(df, feed, checks(df, feed), records)


def unreadable(landed: DataFrame, feed: Feed) -> DataFrame:
    """One violation per landed row that is no JSON object, named by its place, with its text."""
    found = number_records(landed.where("unreadable IS NOT NULL"), landed.select("pos"))
    rec = F.concat(F.lit("idx:"), F.col("record_no").cast("string"))
    none = F.lit(None).cast("string")
    return found.select(
        F.lit(feed.name).alias("source"),
        rec.alias("rec_id"),
        F.lit("UNREADABLE_RECORD").alias("kind"),
        none.alias("field"),
        F.col("unreadable").alias("value"),
        F.lit("JSON object").alias("expected"),
        none.alias("actual"),
        F.format_string(UNREADABLE, rec).alias("message"),
    )


def drift_enum(df: DataFrame, feed: Feed) -> DataFrame:
    """Only the check of allowed texts, also over typed columns."""
    rules = [_unknown_enum(df, f, a) for f, a in feed.enums.items() if f in df.columns]
    return _rows(df, feed, rules)


def drift_timestamp(df: DataFrame, feed: Feed) -> DataFrame:
    """Only the check of the timestamp, also over typed columns."""
    return _rows(df, feed, [_bad_timestamp(df)])


# --- clean records ------------------------------------------------------------------


def _plain(name: str) -> Column:
    # A JSON null and an absent key are the same from here on.
    return F.when(~F.is_variant_null(name), F.col(name)).alias(name)


def normalize_client(df: DataFrame) -> DataFrame:
    """Seven clean columns; an empty or missing property bag becomes {}."""
    return df.select(
        *[_plain(c) for c in ("event_id", "timestamp", "user_id", "event_name")],
        F.when(truthy(df, "properties"), F.col("properties"))
        .otherwise(F.parse_json(F.lit("{}")))
        .alias("properties"),
        F.lit("client").alias("_source"),
        F.current_timestamp().alias("_extracted_at"),
    )


def normalize_server(df: DataFrame) -> DataFrame:
    """Eight clean columns; the link to the client event is lifted out of meta."""
    link = F.try_variant_get(F.col("meta"), "$.ext_id", "variant")
    return df.select(
        *[_plain(c) for c in ("tx_id", "timestamp", "user_id", "status", "amount")],
        F.when(~F.is_variant_null(link), link).alias("ext_id"),
        F.lit("server").alias("_source"),
        F.current_timestamp().alias("_extracted_at"),
    )


# --- counts -----------------------------------------------------------------------


def with_counts(records: DataFrame, feed: Feed) -> DataFrame:
    """First record per key, its `copies`, and how many `violations` it has."""
    kept = dedup(records, feed.key, copies="copies")
    broken = [F.when(rule.broken, 1).otherwise(0) for rule in checks(kept, feed)]
    count = reduce(Column.__add__, broken).cast("bigint")
    return with_schemas(kept, feed).select(*kept.columns, count.alias("violations"))


def stats_of_kept(kept: DataFrame, feed: Feed) -> DataFrame:
    """One row: ingested, duplicates removed, violations, clean records; zeros if empty."""
    ingested = F.coalesce(F.sum("copies"), F.lit(0))
    clean = F.count(F.lit(1))
    return kept.agg(
        F.lit(feed.name).alias("source"),
        ingested.alias("total_ingested"),
        (ingested - clean).alias("duplicates_removed"),
        F.coalesce(F.sum("violations"), F.lit(0)).alias("schema_violations"),
        clean.alias("clean_records_written"),
    )


def extraction_stats(records: DataFrame, feed: Feed, order_col: str = "pos") -> DataFrame:
    """The counts of one feed straight from its raw records, which are read once.

    Every record's violations are counted where it is read, so only hash, position and
    that count are moved.
    """
    rules = checks(records, feed)
    count = reduce(Column.__add__, [F.when(rule.broken, 1).otherwise(0) for rule in rules])
    _, groups = _decided(
        with_schemas(records, feed), feed.key, order_col, violations=count.cast("bigint")
    )
    return stats_of_kept(groups.withColumnRenamed("_copies", "copies"), feed)


def total_violations(stats: DataFrame) -> DataFrame:
    """One row: violations over all feeds."""
    return stats.agg(
        F.coalesce(F.sum("schema_violations"), F.lit(0)).alias("total_schema_violations")
    )
