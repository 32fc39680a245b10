"""Time matching of events and transactions as both arrive.

Two ways. `stream_journey` joins the two streams and gives candidates at once;
what it writes grows with the transactions a user has within the window. For
feeds with very busy users, `land` only appends both streams to tables by hour, and
`match_landed` matches every hour whose rows, or those around it, have changed since it
was matched: a row that comes late, however late, is matched with its hour again.
`frontier` is the hour from which on rows may still be missing in the ordinary course,
and `late_rows` counts what came behind it.
"""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from counterfoil.functions.times import micros
from counterfoil.operators.journey import (
    CLIENT_COLUMNS,
    best_journey,
    candidates,
    transaction,
    user_journey,
)
from counterfoil.operators.timeline import SECOND, cell_of, cell_width

# Fixed value: hours in this form sort as texts.
HOUR = "yyyy-MM-dd-HH"


def stream_journey(
    client: DataFrame, server: DataFrame, window_s: int = 300, delay: str = "1 hour"
) -> DataFrame:
    """Client events with the transactions of their user within the window, as struct `tx`.

    A left outer join of two streams: an event without a transaction appears once
    the watermark has passed its window. The join key holds the time cell next to
    the user, so the state of one busy user is spread over the state partitions.
    `best_candidates` reduces the rows to one per event afterwards.
    """
    reach = window_s * SECOND
    width = cell_width(reach)
    event_us = micros(F.col("event_at"))
    transaction_us = micros(F.col("transaction_at"))
    events = client.select(*CLIENT_COLUMNS, cell_of(event_us, width).alias("cell"))
    offers = server.select(
        F.col("user_id").alias("tx_user_id"),
        F.explode(
            F.sequence(
                cell_of(transaction_us - reach, width), cell_of(transaction_us + reach, width)
            )
        ).alias("tx_cell"),
        F.col("transaction_at").alias("tx_at"),
        transaction(server).alias("tx"),
    )
    span = F.expr(f"INTERVAL {window_s} SECONDS")
    near = (
        (F.col("user_id") == F.col("tx_user_id"))
        & (F.col("cell") == F.col("tx_cell"))
        & (F.col("tx_at") >= F.col("event_at") - span)
        & (F.col("tx_at") <= F.col("event_at") + span)
    )
    return (
        events.withWatermark("event_at", delay)
        .join(offers.withWatermark("tx_at", delay), near, "left_outer")
        .select(*CLIENT_COLUMNS, "tx")
    )


def best_candidates(candidates: DataFrame, client: DataFrame | None = None) -> DataFrame:
    """The journey rows from what `stream_journey` has written so far.

    An event that waits for the watermark, or has no time, is not written by the stream.
    Given the staged events, such events appear as unmatched.
    """
    if client is not None:
        candidates = candidates.unionByName(_unmatched(client, candidates))
    return best_journey(candidates)


def _unmatched(client: DataFrame, like: DataFrame) -> DataFrame:
    return client.select(*CLIENT_COLUMNS, F.lit(None).cast(like.schema["tx"].dataType).alias("tx"))


def land(stream: DataFrame, time_col: str, path: str) -> DataFrame:
    """Append a staged stream to a table by `batch` and by the `hour` of `time_col`.

    A batch writes a folder of its own, so one that failed half-way is replaced when it
    is repeated. Hours are dealt to tasks by their size: a large one is split, small ones
    are put together. Rows without a time lie in an hour of their own (null).
    """
    spark = stream.sparkSession

    def write(batch: DataFrame, number: int) -> None:
        by_hour = batch.withColumn("hour", F.date_format(time_col, HOUR))
        sized = by_hour.hint("rebalance", "hour")
        sized.write.mode("overwrite").partitionBy("hour").parquet(f"{path}/batch={number}")

    # a table to read even before anything has come
    none = spark.createDataFrame([], stream.schema).withColumn("hour", F.lit(None).cast("string"))
    none.write.mode("ignore").partitionBy("hour").parquet(f"{path}/batch=-1")
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{path}-state")
        .trigger(availableNow=True)
    )
    query.start().awaitTermination()
    schema = none.withColumn("batch", F.lit(0).cast("bigint")).schema
    return spark.read.schema(schema).parquet(path)


def frontier(client: DataFrame, server: DataFrame) -> str | None:
    """The hour both landed streams have reached: hours before it are complete in the
    ordinary course. None while one of them has nothing."""
    last = [table.agg(F.max("hour")).first()[0] for table in (client, server)]
    return None if None in last else min(last)


def late_rows(landed: DataFrame) -> DataFrame:
    """Rows per batch that fell into an hour before the last one an earlier batch had reached."""
    by_hour = landed.where("hour IS NOT NULL").groupBy("batch", "hour").agg(F.count("*").alias("n"))
    earlier = W.orderBy("batch").rowsBetween(W.unboundedPreceding, -1)
    # one row per batch
    reached = by_hour.groupBy("batch").agg(F.max("hour").alias("last"))
    reached = reached.select("batch", F.max("last").over(earlier).alias("reached"))
    late = by_hour.join(reached, "batch").where("hour < reached")
    return late.groupBy("batch").agg(F.sum("n").alias("late_rows"))


def _hours(table: DataFrame, name: str) -> DataFrame:
    """Rows of each hour, by its number."""
    number = (F.unix_seconds(F.to_timestamp("hour", HOUR)) / 3600).cast("bigint")
    rows = table.where("hour IS NOT NULL").groupBy("hour").agg(F.count("*").alias(name))
    return rows.select("hour", number.alias("number"), name)


def match_landed(client: DataFrame, server: DataFrame, path: str, window_s: int = 300) -> DataFrame:
    """Match what has landed and was not matched yet, or not with all that is there now.

    Landed tables only grow, so an hour has to be matched again if it has more events, or
    it and the hours within reach have more transactions, than when it was. The matches of
    an hour are replaced whole; what they were made from is written after them, so a run
    that failed half-way is made up for by the next. Gives the journey rows of everything
    that has landed, the same as one batch over it, whatever order it came in.
    """
    spark = client.sparkSession
    reach = -(-window_s // 3600)
    near = F.explode(F.sequence(F.col("number") - reach, F.col("number") + reach)).alias("number")
    offered = _hours(server, "n").select("n", near).groupBy("number").agg(F.sum("n").alias("offered"))
    now = _hours(client, "events").join(offered, "number", "left").select(
        "hour", "number", "events", F.coalesce("offered", F.lit(0)).alias("offered")
    )
    done = f"{path}/hours"
    state = "hour string, events long, offered long"
    spark.createDataFrame([], state).write.mode("ignore").parquet(done)
    before = spark.read.schema(state).parquet(done).groupBy("hour").agg(
        F.max("events").alias("had_events"), F.max("offered").alias("had_offered")
    )
    changed = now.join(before, "hour", "left").where(
        "had_events IS NULL OR events > had_events OR offered > had_offered"
    )
    # a row per hour: bounded by the time the tables span
    stale = changed.select(*now.columns).collect()
    if stale:
        hours = [r.hour for r in stale]
        around = {n + d for r in stale for n in (r.number,) for d in range(-reach, reach + 1)}
        names = [datetime.fromtimestamp(3600 * n, UTC).strftime("%Y-%m-%d-%H") for n in sorted(around)]
        found = candidates(
            client.where(F.col("hour").isin(hours)), server.where(F.col("hour").isin(names)), window_s
        )
        (
            found.withColumn("hour", F.date_format("event_at", HOUR))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("hour")
            .parquet(f"{path}/matches")
        )
        rows = [(r.hour, r.events, r.offered) for r in stale]
        spark.createDataFrame(rows, state).write.mode("append").parquet(done)
    untimed = _unmatched(client.where("hour IS NULL"), server.select(transaction(server).alias("tx")))
    if not stale and now.isEmpty():
        return best_journey(untimed)
    kinds = untimed.withColumn("hour", F.lit("")).schema
    matched = spark.read.schema(kinds).parquet(f"{path}/matches").drop("hour")
    return best_journey(matched.unionByName(untimed))


def landed_span(client: DataFrame) -> tuple[datetime, datetime] | None:
    """Start of the first and end of the last hour that has landed; None if there is none."""
    hour = F.to_timestamp("hour", HOUR)
    first, last = client.agg(F.unix_seconds(F.min(hour)), F.unix_seconds(F.max(hour))).first()
    if first is None:
        return None
    return tuple(datetime.fromtimestamp(s, UTC) for s in (first, last + 3600))


def untimed_journey(client: DataFrame, server: DataFrame) -> DataFrame:
    """The journey rows of landed events without a time, all unmatched."""
    like = server.select(transaction(server).alias("tx"))
    return best_journey(_unmatched(client.where("hour IS NULL"), like))


def _within(table: DataFrame, time_col: str, start: datetime, end: datetime) -> DataFrame:
    """Rows with start <= time <= end; other hours are not read."""
    first, last = (F.date_format(F.lit(t), HOUR) for t in (start, end))
    return table.where(
        F.col("hour").between(first, last) & F.col(time_col).between(F.lit(start), F.lit(end))
    )


def journey_between(
    client: DataFrame, server: DataFrame, start: datetime, end: datetime, window_s: int = 300
) -> DataFrame:
    """The journey rows of the events with start <= event_at < end, from landed tables.

    Give the bounds with a time zone. Complete once transactions up to `end` plus
    the window have landed. Spans
    next to each other, from `landed_span`, give together with `untimed_journey` what
    one batch over all of them gives, as long as event ids do not repeat.
    """
    reach = timedelta(seconds=window_s)
    events = _within(client, "event_at", start, end).where(F.col("event_at") < F.lit(end))
    near = _within(server, "transaction_at", start - reach, end + reach)
    return user_journey(events, near, window_s)
