"""Raw feeds to clean tables, violations and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from counterfoil.operators.ingest import (
    drift,
    normalize_client,
    normalize_server,
    record_id,
    stats_of_kept,
    unreadable,
    with_counts,
)
from counterfoil.plans.tables import written
from counterfoil.sources.feeds import CLIENT, SERVER, Feed
from counterfoil.sources.records import land_array, land_records, readable
from counterfoil.sources.sinks import write_json

NORMALIZE = {"client": normalize_client, "server": normalize_server}


def _extract(
    spark: SparkSession, path: str, feed: Feed, out: str, lines: bool, strict: bool, split: bool
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Write the clean table of one feed; give its violations, unreadable texts and counts.

    The feed is parsed and shuffled once. What is left after deduplication is
    written down, and clean records, violations and counts are read from there.
    """
    if split:
        landed = land_array(spark, path, feed, strict)
    else:
        landed = land_records(spark, path, feed, lines, strict)
    kept = written(with_counts(readable(landed), feed), feed.name)
    write_json(NORMALIZE[feed.source](kept), f"{out}/{feed.name}_clean")
    # Places in the file need a second look at the landed feed, so only if a
    # violating record has no id to be named by.
    nameless = kept.where(record_id(kept).isNull() & (F.col("violations") > 0))
    return (
        drift(kept, feed, None if nameless.isEmpty() else landed),
        unreadable(landed, feed),
        stats_of_kept(kept, feed),
    )


def extract_feeds(
    spark: SparkSession,
    client_path: str,
    server_path: str,
    out: str,
    lines: bool = False,
    strict: bool = False,
    split: bool = False,
) -> DataFrame:
    """Write both clean tables and the violations below `out`; give the counts per feed.

    What is no JSON object is neither a record nor a duplicate: it is listed with the
    violations and counted per feed in `unreadable_records`; `strict` raises instead. With
    `split` each file's array is read by many tasks, and records in front of a break are kept.
    """
    client_drift, client_broken, client_stats = _extract(
        spark, client_path, CLIENT, out, lines, strict, split
    )
    server_drift, server_broken, server_stats = _extract(
        spark, server_path, SERVER, out, lines, strict, split
    )
    broken = written(client_broken.unionByName(server_broken), "unreadable")
    found = client_drift.unionByName(server_drift).unionByName(broken)
    write_json(found, f"{out}/schema_drift")
    counts = broken.groupBy("source").agg(F.count(F.lit(1)).alias("unreadable_records"))
    write_json(counts, f"{out}/unreadable_records")
    return client_stats.unionByName(server_stats)
