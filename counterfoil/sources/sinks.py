"""Writing results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ISO 8601 instants with microseconds and zone.
ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
ISO_LOCAL = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def write_json(df: DataFrame, path: str) -> None:
    """JSON Lines, written by all executors at once; nulls are kept as nulls.

    Used for clean records, violations, the mart export and the findings report.
    Every run replaces the earlier one.
    """
    (
        df.write.mode("overwrite")
        .option("ignoreNullFields", "false")
        .option("timestampFormat", ISO_INSTANT)
        .option("timestampNTZFormat", ISO_LOCAL)
        .json(path)
    )


# The table of a database that names the version readers see: its largest number.
PUBLISHED = "published_versions"
# Versions that stay: the published one and the one before it, for readers still at work.
KEPT = 2


def published(spark: SparkSession, db: str) -> int:
    """The version readers of a database see; 0 before the first one."""
    if not spark.catalog.tableExists(f"`{db}`.`{PUBLISHED}`"):
        return 0
    return spark.table(f"`{db}`.`{PUBLISHED}`").agg(F.max("version")).first()[0] or 0


def save_version(df: DataFrame, db: str, name: str, version: int) -> DataFrame:
    """Write one model of a version that nobody sees yet, and give it as it was written.

    What an earlier run left of the same version, because it failed, is replaced.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")
    table = f"`{db}`.`{name}_versions`"
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (version = {version})")
    df.withColumn("version", F.lit(version)).write.mode("append").partitionBy(
        "version"
    ).saveAsTable(table)
    return spark.table(table).where(F.col("version") == version).drop("version")


def publish(spark: SparkSession, db: str, names: Sequence[str], version: int) -> None:
    """Make a version the one that readers of the database see, all models at once.

    A view per model shows the largest published version, so one row added to one small
    table moves all of them. Versions before the last KEPT are dropped afterwards.
    """
    pointer = f"`{db}`.`{PUBLISHED}`"
    if not spark.catalog.tableExists(pointer):
        spark.sql(f"CREATE TABLE {pointer} (version INT, published_at TIMESTAMP) USING parquet")
    for name in names:
        columns = ", ".join(
            f"`{c}`" for c in spark.table(f"`{db}`.`{name}_versions`").columns if c != "version"
        )
        spark.sql(
            f"CREATE VIEW IF NOT EXISTS `{db}`.`{name}` AS SELECT {columns} "
            f"FROM `{db}`.`{name}_versions` WHERE version = (SELECT max(version) FROM {pointer})"
        )
    spark.sql(f"INSERT INTO {pointer} VALUES ({version}, current_timestamp())")
    for name in names:
        table = f"`{db}`.`{name}_versions`"
        kept = {row[0].partition("=")[2] for row in spark.sql(f"SHOW PARTITIONS {table}").collect()}
        for old in (v for v in kept if int(v) <= version - KEPT):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (version = {old})")


def save_models(models: Mapping[str, DataFrame], db: str | None = None) -> None:
    """Make the models available by name: as session views, or as a new version of `db`.

    A reader of the database sees the models of one version, whole, before and after.
    """
    if db is None:
        for name, df in models.items():
            df.createOrReplaceTempView(name)
        return
    spark = next(iter(models.values())).sparkSession
    version = published(spark, db) + 1
    for name, df in models.items():
        save_version(df, db, name, version)
    publish(spark, db, list(models), version)
