"""Running a stream over what has arrived so far."""

from __future__ import annotations

from pyspark.sql import DataFrame

from counterfoil.session import work_folder


def drain(
    stream: DataFrame, name: str, path: str | None = None, partition_by: str | None = None
) -> DataFrame:
    """Process all files that are there, append the rows to a table, and give that table.

    Offsets and state are kept next to the table, so a later run on the same
    `path` goes on with the files that have come since, also after a failure.
    """
    spark = stream.sparkSession
    path = path or work_folder(spark, name)
    writer = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", f"{path}-state")
        .option("path", path)
        .trigger(availableNow=True)
    )
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)
