"""Reading raw and clean feeds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from counterfoil.session import work_folder
from counterfoil.sources.feeds import ID_KEYS, Feed

# Columns of the clean tables, in order.
CLEAN_SCHEMA = {
    "client": (
        "event_id variant, timestamp variant, user_id variant, event_name variant, "
        "properties variant, _source string, _extracted_at timestamp"
    ),
    "server": (
        "tx_id variant, timestamp variant, user_id variant, status variant, "
        "amount variant, ext_id variant, _source string, _extracted_at timestamp"
    ),
}


def land_records(
    spark: SparkSession, path: str | Sequence[str], feed: Feed, lines: bool = False, strict: bool = False
) -> DataFrame:
    """One row per JSON object, one VARIANT column per declared key, `unreadable` and `pos`.

    A declared key that is absent reads as SQL NULL, a JSON null as a variant
    null; keys that are not declared are never parsed into the plan. What is no
    JSON object is a row with its text in `unreadable` and no keys: a line, or a
    whole file with an array (a cut array gives no single records). `strict`
    raises instead. `pos` (file, block, row) sorts records in file order however
    the files were split.

    The feed is parsed once and written to the work folder, so places, records
    and counts taken from the result agree even if files are split in another
    way the next time. A file holding one JSON array cannot be split, so one task
    parses it whole; large feeds should come as JSON Lines (`lines=True`), which
    split by block, or as many array files.
    """
    keys = list(feed.types) + [key for key in ID_KEYS if key not in feed.types]
    paths = path if isinstance(path, str) else list(path)
    parsed = (
        spark.read.schema(", ".join([*(f"`{key}` variant" for key in keys), "unreadable string"]))
        .option("columnNameOfCorruptRecord", "unreadable")
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
        .option("multiLine", not lines)
        .json(paths)
        .select(
            *keys,
            "unreadable",
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("pos"),
        )
    )
    folder = work_folder(spark, f"{feed.name}-landed")
    parsed.write.parquet(folder)
    return spark.read.schema(parsed.schema).parquet(folder)


# --- one large array ----------------------------------------------------------------


def _earlier(pieces: DataFrame, name: str) -> Column:
    """The sum of a column over all pieces of the file in front of a piece.

    Within a block it is a window; what the blocks in front add up to is in _before.
    """
    inside = W.partitionBy("file", "block").orderBy("row").rowsBetween(W.unboundedPreceding, -1)
    return F.col("_before") + F.coalesce(F.sum(name).over(inside), F.lit(0))


def _with_earlier(pieces: DataFrame, name: str, result: str) -> DataFrame:
    """Adds that sum as `result`: sums per block, carried on over the blocks of a file."""
    blocks = pieces.groupBy("file", "block").agg(F.sum(name).alias("_own"))
    front = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = blocks.select("file", "block", F.coalesce(F.sum("_own").over(front), F.lit(0)).alias("_before"))
    joined = pieces.join(carried, ["file", "block"])
    return joined.withColumn(result, _earlier(joined, name)).drop("_before")


def _count(text: Column, mark: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))


def array_texts(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """The elements of JSON arrays as texts, read by as many tasks as the files have blocks.

    Gives file, place (0-based, in the file), text, and `whole`: true for what ends at a
    closing brace of the outer array's own level, false for the pieces behind the last such
    brace, which are no elements (a cut array) and are given one by one.

    Files are split at braces wherever Spark splits them, so a piece does not know whether
    it begins inside a text. Quotes in front of it, summed over pieces and blocks, tell; that known,
    the braces in front of it give its depth; and the elements that end in front of it give its place.
    """
    paths = path if isinstance(path, str) else list(path)
    read = spark.read.option("lineSep", "}").text(paths)
    text = F.regexp_replace("text", r"(?s)\\.", "")
    folder = work_folder(spark, "pieces")
    (
        read.select(
            F.col("value").alias("text"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_size").alias("size"),
            F.monotonically_increasing_id().alias("row"),
        )
        .withColumn("quotes", _count(text, '"').cast("bigint"))
        .write.parquet(folder)
    )
    pieces = spark.read.schema(
        "text string, file string, block long, size long, row long, quotes long"
    ).parquet(folder)

    # The last piece of a file has a brace behind it only if the lengths say so; a byte
    # order mark is not read.
    ends = pieces.groupBy("file").agg(
        F.sum(F.octet_length("text") + 1).alias("read"),
        F.max("size").alias("size"),
        F.max(F.struct("block", "row")).alias("last"),
    )
    cut = ends.where(~F.col("read").isin(F.col("size"), F.col("size") - 3)).select("file", "last")
    pieces = pieces.join(cut, "file", "left").withColumn(
        "closed", ~F.coalesce(F.struct("block", "row") == F.col("last"), F.lit(False))
    )
    placed = _with_earlier(pieces, "quotes", "quotes_before")
    within = F.col("quotes_before") % 2 == 1
    plain = F.regexp_replace(
        F.concat(F.when(within, '"').otherwise(""), text), r'"[^"]*(?:"|\z)', ""
    )
    closes = F.col("closed") & ((F.col("quotes_before") + F.col("quotes")) % 2 == 0)
    opened = _count(plain, "{") + _count(plain, "[") - _count(plain, "]")
    deep = placed.select(
        "file", "block", "row", "text", "closed", closes.alias("closes"),
        (opened - closes.cast("int")).cast("bigint").alias("deeper"),
    )
    deep = _with_earlier(deep, "deeper", "depth_before")
    ended = F.col("closes") & (F.col("depth_before") + F.col("deeper") == 1)
    numbered = _with_earlier(deep.withColumn("ends", ended.cast("bigint")), "ends", "place")
    total = numbered.groupBy("file").agg(F.sum("ends").alias("elements"))
    numbered = numbered.join(total, "file")
    part = F.struct("block", "row", F.concat("text", F.when(F.col("closed"), "}").otherwise("")).alias("text"))
    whole = (
        numbered.where("place < elements")
        .groupBy("file", "place")
        .agg(F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda p: p["text"]), "").alias("text"))
        .withColumn("whole", F.lit(True))
    )
    rest = W.partitionBy("file", "block").orderBy("row")
    tail = (
        numbered.where("place >= elements")
        .where(~F.trim(F.regexp_replace("text", r"\s", "")).isin("", "]", "[]") | F.col("closed"))
        # numbers behind the elements, apart by block: a block has fewer pieces than bytes
        .withColumn("place", F.col("elements") + F.col("block") + F.row_number().over(rest) - 1)
        .select("file", "place", part["text"].alias("text"), F.lit(False).alias("whole"))
    )
    return whole.unionByName(tail)


def land_array(
    spark: SparkSession, path: str | Sequence[str], feed: Feed, strict: bool = False
) -> DataFrame:
    """What `land_records` gives, for files with one JSON array each, read by many tasks.

    Records in front of a break are kept; what is no object, and every piece behind a
    break, is a row with its text in `unreadable`. `strict` raises instead.
    """
    keys = list(feed.types) + [key for key in ID_KEYS if key not in feed.types]
    schema = ", ".join([*(f"`{key}` variant" for key in keys), "unreadable string"])
    texts = array_texts(spark, path)
    element = F.regexp_replace("text", r"^\s*[\[,]\s*", "")
    options = {
        "columnNameOfCorruptRecord": "unreadable",
        "mode": "FAILFAST" if strict else "PERMISSIVE",
    }
    parsed = F.from_json(F.when(F.col("whole"), element), schema, options)
    # files in order, one row per file
    files = texts.select("file").distinct()
    ranked = files.withColumn("_file_no", F.row_number().over(W.orderBy("file")).cast("bigint"))
    read = texts.join(ranked, "file").withColumn("_record", parsed)
    broken = F.when(F.col("whole"), F.col("_record.unreadable")).otherwise(F.col("text"))
    if strict:
        broken = F.when(F.col("whole"), broken).otherwise(
            F.raise_error(F.concat(F.lit("unreadable: "), F.col("text"))).cast("string")
        )
    landed = read.select(
        *[F.col(f"_record.`{key}`").alias(key) for key in keys],
        broken.alias("unreadable"),
        F.struct(
            "file",
            F.lit(0).cast("bigint").alias("block"),
            (F.shiftleft("_file_no", 33) + F.col("place")).alias("row"),
        ).alias("pos"),
    )
    folder = work_folder(spark, f"{feed.name}-landed")
    landed.write.parquet(folder)
    return spark.read.schema(landed.schema).parquet(folder)


def read_array(
    spark: SparkSession, path: str | Sequence[str], feed: Feed, strict: bool = False
) -> DataFrame:
    """The records of arrays, without what is unreadable."""
    return readable(land_array(spark, path, feed, strict))


# --- records ------------------------------------------------------------------------


def readable(landed: DataFrame) -> DataFrame:
    """The records among landed rows."""
    return landed.where("unreadable IS NULL").drop("unreadable")


def read_records(
    spark: SparkSession, path: str | Sequence[str], feed: Feed, lines: bool = False, strict: bool = False
) -> DataFrame:
    """Landed records without what is unreadable, which `land_records` gives as well."""
    return readable(land_records(spark, path, feed, lines, strict))


def number_records(rows: DataFrame, records: DataFrame) -> DataFrame:
    """Add `record_no`, the 1-based place of `pos` within its file, to some of the records.

    Counts the records of each file block (as many rows as there are blocks),
    adds them up within the file, and joins that small table to `rows`.
    """
    blocks = records.groupBy(
        F.col("pos.file").alias("_file"), F.col("pos.block").alias("_block")
    ).agg(F.min("pos.row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    at_start = (F.col("pos.file") == F.col("_file")) & (F.col("pos.block") == F.col("_block"))
    return (
        rows.join(starts, at_start, "left")
        .withColumn("record_no", F.col("_before") + F.col("pos.row") - F.col("_first") + 1)
        .drop("_file", "_block", "_first", "_n", "_before")
    )


def read_clean(spark: SparkSession, path: str, feed: Feed) -> DataFrame:
    """Clean records as `write_clean` leaves them; a damaged table raises.

    The schema is given, never inferred.
    """
    return spark.read.schema(CLEAN_SCHEMA[feed.source]).option("mode", "FAILFAST").json(path)
