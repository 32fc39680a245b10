"""Intermediate tables that several later steps read."""

from __future__ import annotations

from pyspark.sql import DataFrame

from counterfoil.session import work_folder


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read back from a table in the shared work folder.

    Steps that share it do not compute it again, and a lost executor costs at
    most the tasks it was running.
    """
    spark = df.sparkSession
    path = work_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
