"""Shards of nearly equal bytes by histogram sort.

Rows are ordered by (hash of the text, doc_id, number of the row), so equal texts stand
together. The key space is probed: a round counts rows and bytes exactly between the
probes, in every task and then over all tasks, and only the gaps that still hold a
border are probed again. A border is settled by the first probe that lies within
TOLERANCE of a shard from where it belongs, or by the nearer one of two probes with at
most one row between them. Gaps are probed between texts first, so a group of equal
texts is cut only where it is larger than the tolerance allows. Then rows are exchanged
once, straight to their parts, which no longer depend on how the rows are distributed.

Every shard consists of parts of at most PART_BYTES (but for a single longer row), and
each part is one group of the exchange: a text that a third of all rows share is cut
into as many parts as it needs.

Definite results: a null text counts 1 byte (0 and the 1 that every row counts) and
stands with the empty text; a null id stands before the others; rows that repeat id and text are
kept, in the order in which they were staged; shards that get no row, and those of an
empty table, are simply absent. Other columns are handed on; one whose name is that of
an added column is replaced by it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from counterfoil.llm.common import named, written

# A border may lie off its place by this share of a shard.
TOLERANCE = 0.001
# Parts that a shard is exchanged in: at least PARTS, and none above PART_BYTES.
PART_BYTES = 1 << 29
PARTS = 4
# Probes between two known ones.
PROBES = 256

_MIN = -(1 << 63)
_KEY = ("_h", "_i", "_t")

Key = tuple[int, int, int]  # hash, id, row number


def keyed(
    docs: DataFrame, columns: list[str], id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, size, text_crc32, the key rows are sorted by, and `columns` as struct _row."""
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    identity = named(id_col).cast("long")
    handed = [F.struct(*(named(c) for c in columns)).alias("_row")] if columns else []
    return docs.select(
        *handed,
        identity.alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("_h"),
        F.coalesce(identity, F.lit(_MIN)).alias("_i"),
        F.monotonically_increasing_id().alias("_t"),
    )


def _below(columns: list[np.ndarray], probes: list[np.ndarray]) -> np.ndarray:
    """For each key, how many of the sorted probes are not above it."""
    first = np.searchsorted(probes[0], columns[0], "left")
    found = np.searchsorted(probes[0], columns[0], "right")
    if len(columns) == 1:
        return found
    shared = np.flatnonzero(first < found)
    for start in np.unique(first[shared]):
        rows = shared[first[shared] == start]
        stop = found[rows[0]]
        within = _below([c[rows] for c in columns[1:]], [p[start:stop] for p in probes[1:]])
        found[rows] = start + within
    return found


def _arrays(keys: list[Key]) -> list[np.ndarray]:
    return [np.array([key[k] for key in keys], "i8") for k in range(3)]


@dataclass(frozen=True)
class Gap:
    """What lies between two probes: rows, bytes, smallest and largest hash."""

    rows: int
    bytes: int
    first: int
    last: int


def _counted(rows: DataFrame, probes: list[Key]) -> dict[int, Gap]:
    """What lies in front of, between and behind the probes, where anything does."""
    arrays = _arrays(probes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, size = np.zeros((2, len(probes) + 1), "i8")
        first = np.full(len(probes) + 1, np.iinfo("i8").max)
        last = np.full(len(probes) + 1, np.iinfo("i8").min)
        for batch in batches:
            *key, own = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            at = _below(key, arrays)
            n += np.bincount(at, minlength=len(n))
            np.add.at(size, at, own)
            np.minimum.at(first, at, key[0])
            np.maximum.at(last, at, key[0])
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), *(pa.array(c[used]) for c in (n, size, first, last))],
            ["gap", "n", "bytes", "first", "last"],
        )

    schema = "gap long, n long, bytes long, first long, last long"
    counts = rows.select(*_KEY, "size").mapInArrow(count, schema)
    whole = counts.groupBy("gap").agg(F.sum("n"), F.sum("bytes"), F.min("first"), F.max("last"))
    return {gap: Gap(*found) for gap, *found in whole.collect()}


@dataclass(frozen=True)
class Probe:
    """A place in the order, with the rows and bytes in front of it."""

    key: Key
    rows: int
    bytes: int


def _between(low: Key, high: Key, ends: list[tuple[int, int]], n: int) -> list[Key]:
    """Up to n keys above low and below high, between texts if there is room.

    `ends` are the smallest and largest id and row number there are.
    """
    (id_min, id_max), (row_min, row_max) = ends

    def spread(a: int, b: int) -> list[int]:
        step = max(1, (b - a) // (n + 1))
        return list(range(a + step, b, step))[: n + 1]

    if high[0] - low[0] > 1:
        return [(h, _MIN, _MIN) for h in spread(low[0], high[0])]
    if low[0] < high[0] and high[1:] != (_MIN, _MIN):
        return [(high[0], _MIN, _MIN)]  # the border between two neighbouring texts
    last = high[1] if low[0] == high[0] else id_max + 1
    first = max(low[1], id_min - 1)
    if last - first > 1:
        return [(low[0], i, _MIN) for i in spread(first, last)]
    if first < last and low[0] == high[0] and high[2] != _MIN:
        return [(low[0], last, _MIN)]
    end = high[2] if low[:2] == high[:2] else row_max + 1
    start = max(low[2], row_min - 1)
    # the rows of one id and text, which `low` may stand in front of
    return [(low[0], first, t) for t in spread(start, end)]


@dataclass(frozen=True)
class Layout:
    """Where parts begin, the shard of each, and the rows of the shard in front of it."""

    starts: list[Key]
    shard: list[int]
    offset: list[int]


def layout(
    rows: DataFrame, shards: int, tolerance: float = TOLERANCE, part_bytes: int = PART_BYTES
) -> Layout:
    """The parts of all shards, from rounds of exact counts over the key columns.

    The driver holds a few probes for each part: their number is bounded by the bytes
    of the table over `part_bytes`, and by the shards.
    """
    ends = rows.agg(
        F.sum("size"), F.count(F.lit(1)), F.min("_h"), F.max("_h"), F.min("_i"), F.max("_i"),
        F.min("_t"), F.max("_t"),
    ).first()
    total, n = ends[0], ends[1]
    if not n:
        return Layout([], [], [])
    bounds = [(ends[4], ends[5]), (ends[6], ends[7])]
    known = [Probe((ends[2], _MIN, _MIN), 0, 0), Probe((ends[3] + 1, _MIN, _MIN), n, total)]
    part = min(part_bytes, -(-total // (PARTS * shards)))
    slack = tolerance * total / shards
    wanted = [k * total / shards for k in range(1, shards)]
    stuck: set[tuple[Key, Key]] = set()  # gaps without room for a probe
    while True:
        asked: dict[int, list[Key]] = {}
        gaps = [(p, q) for p, q in zip(known, known[1:]) if p.rows < q.rows]
        places = np.array([low.bytes for low, _ in gaps])
        open_: dict[int, int] = {}
        for target in wanted:
            k = int(np.searchsorted(places, target, "right")) - 1
            low, high = gaps[k]
            near = min(target - low.bytes, high.bytes - target)
            if near > slack and high.rows - low.rows > 1:
                open_[k] = PROBES
        for k, (low, high) in enumerate(gaps):
            if high.rows - low.rows > 1 and high.bytes - low.bytes > part:
                open_[k] = max(open_.get(k, 0), 4 * (high.bytes - low.bytes) // part)
        for k, count in open_.items():
            low, high = gaps[k]
            if (low.key, high.key) not in stuck:
                inner = [p for p in _between(low.key, high.key, bounds, count) if low.key < p < high.key]
                if inner:
                    asked[k] = inner
                else:
                    stuck.add((low.key, high.key))
        if not asked:
            break
        # only gaps that are probed are counted: all else is known
        probes = sorted({p for k, inner in asked.items() for p in (gaps[k][0].key, *inner, gaps[k][1].key)})
        counts = _counted(rows, probes)
        found = list(known)
        number = {p: k for k, p in enumerate(probes)}
        for k, inner in asked.items():
            low, high = gaps[k]
            at, size = low.rows, low.bytes
            for start, stop in zip((low.key, *inner), (*inner, high.key)):
                gap = counts.get(number[start] + 1)
                if gap and start < (gap.first, _MIN, _MIN):
                    found.append(Probe((gap.first, _MIN, _MIN), at, size))
                if gap:
                    at, size = at + gap.rows, size + gap.bytes
                if gap and (gap.last + 1, _MIN, _MIN) < stop:
                    found.append(Probe((gap.last + 1, _MIN, _MIN), at, size))
                if stop != high.key:
                    found.append(Probe(stop, at, size))
        found.sort(key=lambda p: p.key)
        # of probes with nothing between them the first and the last bound their gaps
        known = [
            p
            for before, p, after in zip([None, *found], found, [*found[1:], None])
            if not before or not after or before.rows < p.rows or p.rows < after.rows
        ]
    return _parts(known, wanted, part)


def _parts(known: list[Probe], wanted: list[float], part: int) -> Layout:
    """Shards begin at the known probes nearest to where they should, parts in between."""
    known = [p for p, q in zip(known, known[1:]) if p.rows < q.rows] + [known[-1]]
    places = [p.bytes for p in known]
    borders = [0]
    for target in wanted:
        k = int(np.searchsorted(places, target))
        if k and target - places[k - 1] <= places[k] - target:
            k -= 1
        borders.append(max(k, borders[-1]))
    starts, shard, offset = [], [], []
    for number, (first, stop) in enumerate(zip(borders, [*borders[1:], len(known) - 1])):
        begun = None
        for k in range(first, stop):
            if begun is None or known[k + 1].bytes - begun > part:
                begun = known[k].bytes
                starts.append(known[k].key)
                shard.append(number)
                offset.append(known[k].rows - known[first].rows)
    return Layout(starts, shard, offset)


def sharded(
    docs: DataFrame,
    shards: int = 16,
    id_col: str = "doc_id",
    text_col: str = "text",
    columns: list[str] | None = None,
    tolerance: float = TOLERANCE,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """docs with shard and slot (its place in the shard), doc_id, size and text_crc32.

    `columns` names the further columns to hand on (all by default): what is left out is
    not moved.
    """
    chosen = docs.columns if columns is None else columns
    added = ("doc_id", "size", "text_crc32", "shard", "slot")
    handed = [c for c in chosen if c.lower() not in added]
    staged = written(keyed(docs, handed, id_col, text_col), "keyed-documents")
    found = layout(staged, shards, tolerance, part_bytes)
    arrays = _arrays(found.starts)
    result = (["_row.*"] if handed else []) + [*added]
    if not found.starts:
        return staged.withColumns(
            {"shard": F.lit(0), "slot": F.lit(0).cast("long")}
        ).select(*result)

    @F.arrow_udf("int")
    def part_of(h: pa.Array, i: pa.Array, t: pa.Array) -> pa.Array:
        key = [c.to_numpy(zero_copy_only=False) for c in (h, i, t)]
        return pa.array(_below(key, arrays) - 1, pa.int32())

    spark = docs.sparkSession
    numbered = list(zip(range(len(found.shard)), found.shard, found.offset, strict=True))
    parts = spark.createDataFrame(numbered, "_part int, shard int, _offset long")
    inside = Window.partitionBy("_part").orderBy(*_KEY)
    return (
        staged.withColumn("_part", part_of(*_KEY))
        .withColumn("_n", F.row_number().over(inside) - 1)
        .join(F.broadcast(parts), "_part")  # a row per part: bounded as `layout` states
        .withColumn("slot", F.col("_offset") + F.col("_n"))
        .select(*result)
    )


def write_shards(placed: DataFrame, folder: str) -> None:
    """The shards as Parquet below folder/shard=K, every file ordered by slot.

    Parts stay in the tasks that sorted them, so rows are not exchanged again.
    """
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
