"""Linear-time lookups along timelines that are cut anywhere.

Rows are ordered by their place (space, key, instant, kind, tie) and cut into parts at
borders taken from a sample, in the middle of a key or of an instant where that is where
the rows are. A first pass gives what each part hands to its neighbours (a sum, or its
first and last target), one row per part; a second pass is one sorted window per part
that starts from what was handed on. No pairs are formed, no row is copied into a second
part, and one very active key fills as many parts as its rows need.

Only rows of one place cannot be cut apart, so `tie` should differ from row to row.
"""

from __future__ import annotations

import json
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

SECOND = 1_000_000

# Parts for each shuffle partition: parts are dealt by hash, so several even out.
PARTS = 4
# Rows sampled for each part. The driver holds PARTS x SAMPLED of them, about, for each
# shuffle partition, whatever the table.
SAMPLED = 32

PLACE = ("space", "key", "at_us", "kind", "tie")
_PLACES = "array<struct<space int, key string, at_us bigint, kind int, tie bigint>>"


def cell_width(reach_us: int) -> int:
    """Width of the time cells of a stream for targets that matter so far around them."""
    return 3 * reach_us


def cell_of(at_us: Column, width_us: int) -> Column:
    """Number of the time cell that holds an instant."""
    return F.call_function("div", at_us - F.pmod(at_us, F.lit(width_us)), F.lit(width_us))


# --- parts ------------------------------------------------------------------------


def _order(place: tuple) -> tuple:
    """Places in Python as Spark orders them: nulls first."""
    return tuple((value is not None, value or 0) if k == 2 else value for k, value in enumerate(place))


def borders(rows: DataFrame) -> list[tuple]:
    """Places that cut the rows into parts of about equal size.

    The result of a lookup does not depend on them, so any sample will do.
    """
    parts = PARTS * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    wanted = parts * SAMPLED
    n = rows.count()
    some = rows if n <= wanted else rows.sample(wanted / n, 1)
    places = sorted((tuple(r) for r in some.select(*PLACE).collect()), key=_order)
    step = max(1, len(places) // parts)
    return list(dict.fromkeys(places[step::step]))


def with_part(rows: DataFrame, cuts: list[tuple]) -> DataFrame:
    """Adds the number of the part a row belongs to: how many borders are not above its place."""
    listed = [dict(zip(PLACE, cut, strict=True)) for cut in cuts]
    # A constant for the optimiser, however many borders there are.
    known = F.from_json(F.lit(json.dumps(listed)), _PLACES)
    place = F.struct(
        F.col("space").cast("int").alias("space"),
        F.col("key").cast("string").alias("key"),
        F.col("at_us").cast("bigint").alias("at_us"),
        F.col("kind").cast("int").alias("kind"),
        F.col("tie").cast("bigint").alias("tie"),
    )
    # A binary search, one alias per step: compiled, which a lambda is not.
    steps = [F.lit(0).alias("_part0")]
    for k in reversed(range(len(cuts).bit_length())):
        part = F.col(f"_part{len(steps) - 1}")
        above = F.get(known, part + ((1 << k) - 1)) <= F.col("_place")
        steps.append(F.when(above, part + (1 << k)).otherwise(part).alias(f"_part{len(steps)}"))
    found = rows.select("*", place.alias("_place"), *steps)
    return found.select(*rows.columns, F.col(f"_part{len(steps) - 1}").alias("part"))


_IN_PART = "PARTITION BY part ORDER BY space, key, at_us, kind, tie"


# --- nearest target ------------------------------------------------------------------


def _nullable(kind: pa.DataType) -> pa.DataType:
    """An Arrow type whose fields, at any depth, may all be null."""
    if not pa.types.is_struct(kind):
        return kind
    return pa.struct([pa.field(f.name, _nullable(f.type)) for f in kind])


def _handed_on(offered: DataFrame, n: int) -> DataFrame:
    """For each of n parts, the last target before it and the first one behind it."""
    hit = F.col("hit")
    ends = offered.groupBy("part").agg(F.min(hit).alias("first"), F.max(hit).alias("last")).toArrow()
    first, last = (
        column.combine_chunks().cast(_nullable(column.type)) for column in (ends["first"], ends["last"])
    )
    held = dict(zip(ends["part"].to_pylist(), range(len(ends))))
    have = [held.get(p) for p in range(n)]

    def latest(seen: int | None, row: int | None) -> int | None:
        return seen if row is None else row

    before = [None, *accumulate(have, latest)][:n]
    after = [None, *accumulate(reversed(have), latest)][:n][::-1]
    table = pa.table(
        {
            "part": pa.array(range(n), pa.int32()),
            "handed_before": last.take(pa.array(before, pa.int64())),
            "handed_after": first.take(pa.array(after, pa.int64())),
        }
    )
    return offered.sparkSession.createDataFrame(table, from_arrow_schema(table.schema))


def nearest(probes: DataFrame, targets: DataFrame) -> DataFrame:
    """Every row of `probes` with the nearest target of its space and key, if any.

    `probes` holds space, key, at_us, reach_us (null: any distance), tie, and `row`, a
    struct that is handed on; `targets` holds space, key, at_us, id and a struct
    `target`. Gives row and target: smallest distance first, then earliest, then
    smallest id. Where the instant of either is unknown, any distance is smaller; of
    targets that remain, one without an instant comes first, then the earliest.
    """
    where = ["space", "key", "at_us"]
    best = targets.groupBy(*where).agg(F.min(F.struct("id", "target")).alias("best"))
    offered = best.select(
        *where,
        F.lit(0).alias("kind"),
        F.lit(0).cast("bigint").alias("tie"),
        F.struct(*where, F.col("best.target").alias("target")).alias("hit"),
    )
    asked = probes.select(*where, F.lit(1).alias("kind"), "tie", "reach_us", "row")
    cuts = borders(
        asked.select(*PLACE).unionByName(
            targets.select(*where, F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("tie"))
        )
    )
    offered = with_part(offered, cuts)
    timeline = offered.unionByName(with_part(asked, cuts), allowMissingColumns=True)
    found = (
        timeline.select(
            *where,
            "part",
            "kind",
            "reach_us",
            "row",
            F.expr(
                f"last(hit) IGNORE NULLS OVER ({_IN_PART} "
                "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
            ).alias("before"),
            F.expr(f"lead(hit) IGNORE NULLS OVER ({_IN_PART})").alias("after"),
        )
        .where("kind = 1")
        .join(_handed_on(offered, len(cuts) + 1), "part", "left")
    )

    def own(hit: str, handed: str) -> Column:
        known = F.coalesce(hit, handed)
        return F.when((known["space"] == F.col("space")) & (known["key"] == F.col("key")), known)

    at = F.col("at_us")
    both = found.select(
        "row", "reach_us", at, own("before", "handed_before").alias("before"),
        own("after", "handed_after").alias("after"),
    )
    gap_before, gap_after = at - F.col("before.at_us"), F.col("after.at_us") - at
    hit = (
        F.when(gap_after < gap_before, F.col("after"))
        .when(gap_before.isNotNull(), F.col("before"))
        .when(gap_after.isNotNull(), F.col("after"))
        .otherwise(F.coalesce("before", "after"))
    )
    chosen = both.select("row", "reach_us", at, hit.alias("hit"))
    near = F.col("reach_us").isNull() | (F.abs(at - F.col("hit.at_us")) <= F.col("reach_us"))
    return chosen.select("row", F.when(near, F.col("hit.target")).alias("target"))


# --- activity before ------------------------------------------------------------------


def count_before(probes: DataFrame, activity: DataFrame, lookback_s: int) -> DataFrame:
    """The weight of the activity of a probe's key in the half-open span before it.

    `probes` holds key, at_us, tie and `row`, a struct that is handed on; `activity`
    holds key, at_us, tie and `weight`. Gives row and `preceding`, what happened in
    [at - lookback, at).

    Activity enters a running sum at its own time and leaves it just after the lookback
    has passed. All that a key enters leaves again, so the sum runs over all keys and
    parts without a break, and a part starts from the sum of the parts before it.
    """
    lookback = lookback_s * SECOND
    at = F.col("at_us")
    no = F.lit(0).cast("bigint")
    # A probe sorts before changes of its instant: activity at that very instant is not
    # counted yet, activity exactly one lookback ago still is.
    asked = probes.select("key", at, F.lit(0).alias("kind"), "tie", no.alias("change"), "row")
    weight = F.col("weight").cast("bigint")
    changes = F.array(
        F.struct(at.alias("at_us"), weight.alias("change")),
        F.struct((at + lookback).alias("at_us"), (-weight).alias("change")),
    )
    moved = activity.select("key", "tie", F.inline(changes)).withColumn("kind", F.lit(1))
    rows = asked.unionByName(moved, allowMissingColumns=True).withColumn("space", F.lit(0))
    cuts = borders(rows.select(*PLACE))
    parted = with_part(rows, cuts)
    sums = dict(parted.groupBy("part").agg(F.sum("change")).collect())
    handed = list(accumulate(sums.get(p, 0) for p in range(len(cuts))))
    known = F.from_json(F.lit(json.dumps([0, *handed])), "array<bigint>")
    running = F.expr(
        f"sum(change) OVER ({_IN_PART} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    return (
        parted.select("kind", "row", "part", running.alias("sum"))
        .where("kind = 0")
        .select("row", (F.col("sum") + F.get(known, F.col("part"))).alias("preceding"))
    )
