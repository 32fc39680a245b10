"""Connected components of links, as Spark joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """links (a, b) to (id, label): the smallest id of each component, for ids with links.

    Every round moves each id to its smallest neighbour, and on to where that one moved,
    and then draws the links between the new places only, so links inside a group fall
    away and the next round has few left. Rounds end when no link is left. All tables are
    written, nothing is collected.
    """
    open_ = written(_between(links, "a", "b"), "edges")
    labels = None
    while labels is None or not open_.isEmpty():
        both = open_.unionByName(open_.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("to"))
        near = written(near, "moves")
        far = near.select(F.col("id").alias("at"), F.col("to").alias("on"))
        moves = near.join(far, F.col("to") == F.col("at")).select("id", F.col("on").alias("to"))
        moves = written(moves, "moves")
        if labels is None:
            labels = moves.withColumnRenamed("to", "label")
        else:
            labels = written(
                labels.join(moves.withColumnRenamed("id", "at"), F.col("label") == F.col("at"), "left")
                .select("id", F.coalesce("to", "label").alias("label")),
                "labels",
            )
        a = moves.select(F.col("id").alias("a"), F.col("to").alias("to_a"))
        b = moves.select(F.col("id").alias("b"), F.col("to").alias("to_b"))
        open_ = written(_between(open_.join(a, "a").join(b, "b"), "to_a", "to_b"), "edges")
    return labels


def _between(links: DataFrame, a: str, b: str) -> DataFrame:
    """Distinct links between different ids, the smaller one first."""
    chosen = links.where(F.col(a) != F.col(b))
    return chosen.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()
