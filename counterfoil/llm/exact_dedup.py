"""Exact dedup: 128-bit content hash, bytes compared inside the groups of a hash.

Definite results: a null text is the empty text; a null id never wins over another
id; rows that repeat both id and text count one by one in group_size and are all
marked kept (`deduplicated` keeps one of them); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import id_and_text, named


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return id_and_text(docs, id_col, text_col).withColumn("content_hash", F.unhex(F.md5("text")))


def exact_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """Every row with its group: doc_id, keep_id, group_size, kept, text_sha256.

    Grouping by hash and text compares the bytes of all texts with equal hash, so texts
    that merely collide form groups of their own. Copies are folded inside each task
    before the shuffle: a group with a third of all rows arrives as one row per task.
    The way back from row to group carries digests only; adaptive execution can split it.
    """
    best = F.min if keep == "smallest" else F.max
    rows = _hashed(docs, id_col, text_col)
    groups = (
        rows.groupBy("content_hash", "text")
        .agg(best("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select(
            "content_hash", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"
        )
    )
    narrow = rows.select("doc_id", "content_hash", F.sha2("text", 256).alias("text_sha256"))
    return narrow.join(groups, ["content_hash", "text_sha256"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def deduplicated(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest"
) -> DataFrame:
    """One whole row per distinct text, all columns as they came; null texts count as empty.

    Of rows that tie in the id, the other columns decide, so the result is the same in
    every run; where one of them has no order (maps, variants), their JSON does.
    """
    pick = F.min if keep == "smallest" else F.max
    rest = [c for c in docs.columns if c not in (id_col, text_col)]
    row = F.struct(
        (named(id_col).isNull() if keep == "smallest" else named(id_col).isNotNull()).alias("no_id"),
        named(id_col).alias("id"),
        named(text_col).alias("text"),
        *(named(c).alias(f"c{i}") for i, c in enumerate(rest)),
    )
    chosen = pick("r")
    if any(k in docs.schema[c].dataType.simpleString() for c in rest for k in ("map<", "variant")):
        pick_by = F.min_by if keep == "smallest" else F.max_by
        order = F.struct(*(F.col("r")[k] for k in ("no_id", "id", "text")), F.to_json("r"))
        chosen = pick_by("r", order)
    text = F.coalesce(named(text_col), F.lit(""))
    found = (
        docs.select(F.unhex(F.md5(text)).alias("h"), text.alias("t"), row.alias("r"))
        .groupBy("h", "t")
        .agg(chosen.alias("r"))
    )
    back = {id_col: "id", text_col: "text"} | {c: f"c{i}" for i, c in enumerate(rest)}
    return found.select(*(F.col(f"r.{back[c]}").alias(c) for c in docs.columns))
