"""Helpers the operators share.

Every operator selects the columns it reads first, under names of its own, so that
further columns of the input, whatever their names, never meet its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from counterfoil.session import configure, work_folder

Columns = dict[str, list]

# Rows in an Arrow batch: bounds what a Python worker holds when texts are long.
BATCH_ROWS = 500


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the tables of a folder."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_prefix(docs: DataFrame, wanted: str) -> str:
    """wanted, longer by underscores while any column of docs starts with it in either case."""
    while any(c.lower().startswith(wanted) for c in docs.columns):
        wanted += "_"
    return wanted


def named(name: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col(f"`{name}`")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and text alone; null texts are empty."""
    return docs.select(
        named(id_col).cast("long").alias("doc_id"),
        F.coalesce(named(text_col).cast("string"), F.lit("")).alias("text"),
    )


def written(df: DataFrame, purpose: str) -> DataFrame:
    """df as a table in the shared folder: cuts the lineage, and lost executors cost no rerun."""
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_columns(
    df: DataFrame, make: Callable[[Iterator[Columns]], Iterator[Columns]], schema: str
) -> DataFrame:
    """df through a function from column lists to column lists, batch by batch."""
    kind = _parse_datatype_string(schema)
    assert isinstance(kind, StructType)
    arrow = to_arrow_schema(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in make(b.to_pydict() for b in batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[field.name], field.type) for field in arrow], schema=arrow
            )

    return df.mapInArrow(run, kind)
