"""Deduplication of records as files arrive.

`stream_dedup` drops copies within a delay and keeps bounded state. `upsert_records` keeps
what batch deduplication over all files would keep, whenever and in whatever order the
files come: its state is the table of kept records.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from counterfoil.operators.ingest import key_hash, key_text
from counterfoil.sources.feeds import Feed

# Where a record stands: files are ordered by path, as in batch.
POSITION = "struct<file string, block bigint, row bigint>"


def stream_records(
    spark: SparkSession, folder: str, feed: Feed, files_per_trigger: int | None = None
) -> DataFrame:
    """Raw records of JSON Lines files as they arrive, with `arrived_at`.

    A line that is no JSON object is a row with its text in `unreadable` and no keys.
    """
    columns = [*(f"`{key}` variant" for key in feed.types), "unreadable string"]
    reader = spark.readStream.schema(", ".join(columns))
    reader = reader.option("columnNameOfCorruptRecord", "unreadable")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(folder).select(
        "*", F.col("_metadata.file_modification_time").alias("arrived_at")
    )


def stream_dedup(records: DataFrame, key_cols: Sequence[str], delay: str = "1 day") -> DataFrame:
    """One record per key as long as its copies arrive within `delay` of each other.

    The clock is the time of arrival: a record whose own timestamp is late,
    unreadable or missing is kept all the same. Unlike in batch, copies that
    arrive further apart are both kept, which bounds the state. Unreadable lines, where
    the records have that column, are copies of each other only if their texts are equal.
    """
    own = {f"_key_{i}": key_text(records, c) for i, c in enumerate(key_cols)}
    if "unreadable" in records.columns:
        own["_key_unreadable"] = F.col("unreadable")
    keys = list(own)
    return (
        records.withColumns(own)
        .withWatermark("arrived_at", delay)
        .dropDuplicatesWithinWatermark(keys)
        .drop(*keys)
    )


@dataclass(frozen=True)
class Upserted:
    """The tables an upsert leaves: `kept` records, and what it counted on the way.

    `late` has the kept records that came after another one of their key had been kept
    and took its place, with the position they `replaced`, so nothing that comes late
    is lost or goes uncounted; `unreadable` has the lines that are no records.
    """

    kept: DataFrame
    late: DataFrame
    unreadable: DataFrame


def _table(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    columns = [*(f"`{key}` variant" for key in feed.types), "unreadable string"]
    own = f"_key binary, pos {POSITION}, replaced {POSITION}, batch long"
    return spark.read.schema(", ".join([*columns, own])).parquet(path)


def fold_batch(batch: DataFrame, number: int, path: str, feed: Feed) -> None:
    """Add to the table at `path` what a batch of records has that stands before it.

    `batch` has the columns of `stream_records`, and the `file` and `block` of each.
    Which record of a key comes first is decided on rows of hash and position, of the
    batch and of the batches before it; only records that are kept are written. Done
    again, it replaces what it wrote, so a batch that failed half-way can be repeated.
    """
    spark = batch.sparkSession
    # read once, so that positions agree in all that follows
    incoming = f"{path}-incoming"
    position = F.struct("file", "block", F.monotonically_increasing_id().alias("row"))
    placed = batch.withColumn("pos", position).drop("file", "block")
    placed.write.mode("overwrite").parquet(incoming)
    records = spark.read.schema(placed.schema).parquet(incoming)
    records = records.withColumn("_key", key_hash(records, feed.key))
    readable = records.where("unreadable IS NULL")
    best = readable.groupBy("_key").agg(F.min("pos").alias("pos"))
    before = _table(spark, path, feed).where((F.col("batch") < number) & F.col("_key").isNotNull())
    earlier = before.groupBy("_key").agg(F.min("pos").alias("replaced"))
    found = best.join(earlier, "_key", "left").where("replaced IS NULL OR pos < replaced")
    kept = readable.join(found.drop("_key"), "pos")
    broken = records.where("unreadable IS NOT NULL").withColumns(
        {"_key": F.lit(None).cast("binary"), "replaced": F.lit(None).cast(POSITION)}
    )
    columns = [*feed.types, "unreadable", "_key", "pos", "replaced"]
    rows = kept.select(*columns).unionByName(broken.select(*columns))
    rows.write.mode("overwrite").parquet(f"{path}/batch={number}")


def upsert_records(
    spark: SparkSession, folder: str, feed: Feed, path: str, files_per_trigger: int | None = None
) -> Upserted:
    """Take in all files that are there, and give what is kept of all files so far.

    The first record of a key in file order stays, also if its file comes last. A later
    run on the same `path` goes on with the files that have come since. The state is the
    kept table's hashes and positions, one row per key: a batch small enough is
    broadcast against it, and nothing of the table is moved or written again.
    """
    records = stream_records(spark, folder, feed, files_per_trigger).select(
        *feed.types,
        "unreadable",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    # an empty table to begin with, which later runs leave alone
    kinds = {**dict.fromkeys(feed.types, "variant"), "unreadable": "string", "_key": "binary"}
    kinds |= {"pos": POSITION, "replaced": POSITION}
    none = spark.range(0).select(*(F.lit(None).cast(k).alias(c) for c, k in kinds.items()))
    none.write.mode("ignore").parquet(f"{path}/batch=-1")
    writer = (
        records.writeStream.foreachBatch(lambda batch, number: fold_batch(batch, number, path, feed))
        .option("checkpointLocation", f"{path}-state")
        .trigger(availableNow=True)
    )
    writer.start().awaitTermination()
    rows = _table(spark, path, feed)
    records = rows.where("unreadable IS NULL").drop("unreadable")
    late = records.where("replaced IS NOT NULL")
    gone = late.select(F.col("replaced").alias("pos"))
    return Upserted(
        records.join(gone, "pos", "left_anti").select(*feed.types),
        late.select(*feed.types, "pos", "replaced", "batch"),
        rows.where("unreadable IS NOT NULL").select("unreadable", "pos", "batch"),
    )
