"""Vector codes by product quantisation, trained with Lloyd's rounds on cover trees.

Vectors are cut into PARTS equal parts with a codebook each. Every task gathers its
vectors in chunks of CHUNK and builds one cover tree per chunk and part: the centers of
a level are at least a radius apart, cover all points within it, and are kept by all
finer levels (radii shrink by SHRINK; the last points hang below the finest level). A
node carries the number and the sum of its points and the exact distance to its
farthest one. Trees are stored once and serve all rounds.

In a round, a node whose nearest entry is nearer than any other one by more than twice
its radius goes to that entry as a whole, by its sums. Other nodes hand the entries that
may still be nearest to their children. Points that remain are compared exactly, in
whole numbers, with the entries that remain for them, so ties go to the lower index.
Only sums per entry leave the tasks; codebooks are all the driver holds.

Definite results: vectors that are null or hold null or non-finite components are left
out, and so are those without the commonest number of components (of equally common
ones, the larger; a number that PARTS divides); components beyond +-67,108,864 after
scaling count as that; repeated ids are vectors of their own, and a null id stays null
and comes last in the order of ids; equal ids are ordered by components; with fewer
vectors than entries there are fewer entries; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import named, written
from counterfoil.llm.vectors import integer_vectors, matrix, squared, squared_rows

PARTS = 4
ENTRIES = 256
# Vectors of a tree: bounds what a task holds.
CHUNK = 2048
# A level's radius over that of the next finer one.
SHRINK = 1.5
# Centers of the finest level: one for so many points.
POINTS_A_CENTER = 8
# Relative room for rounding of square roots.
ROOM = 1e-9
# Entries are compared one by one, not all at once, where fewer than this share remain.
FEW = 0.1
# Copies of each label's total in the last join, so that a hot label is no single task.
SALTS = 16


@dataclass(frozen=True)
class Level:
    """The nodes of a level: the point each one centers on, its parent, its points."""

    center: np.ndarray
    parent: np.ndarray
    radius: np.ndarray
    n: np.ndarray
    total: np.ndarray
    node_of: np.ndarray  # of each point of the chunk


def cover_tree(points: np.ndarray) -> list[Level]:
    """Levels from the coarsest (one node) to the finest; points hang below the last."""
    n = len(points)
    order, reach = [0], [float("inf")]
    gap = squared(points, points[:1])[:, 0]
    while len(order) < max(1, n // POINTS_A_CENTER):
        far = int(gap.argmax())
        if gap[far] == 0:
            break  # all points stand on a center
        order.append(far)
        reach.append(float(np.sqrt(gap[far])))
        gap = np.minimum(gap, squared_rows(points, points[far][None, :]))
    centers = np.array(order)
    widths = [1]
    if len(order) > 1:
        radius = reach[1]
        while widths[-1] < len(order):
            radius /= SHRINK
            width = int(np.searchsorted(-np.array(reach), -radius, "right"))
            if width > widths[-1]:
                widths.append(width)
    # from the finest level upwards: each point's node, and the node's node
    own = squared(points, points[centers[: widths[-1]]]).argmin(1)
    levels: list[Level] = []
    for k in range(len(widths) - 1, -1, -1):
        width = widths[k]
        if k:
            up = squared(points[centers[:width]], points[centers[: widths[k - 1]]]).argmin(1)
        else:
            up = np.zeros(width, "i8")
        far = squared_rows(points, points[centers[own]])
        most = np.zeros(width, "i8")
        np.maximum.at(most, own, far)
        total = np.zeros((width, points.shape[1]), "i8")
        np.add.at(total, own, points)
        levels.append(
            Level(centers[:width], up, np.sqrt(most.astype("f8")), np.bincount(own, minlength=width),
                  total, own)
        )
        own = up[own]
    return levels[::-1]


def _distances(points: np.ndarray, book: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Squared distances where asked, elsewhere the largest number."""
    none = np.iinfo("i8").max
    if asked.mean() >= FEW:
        return np.where(asked, squared(points, book), none)
    out = np.full(asked.shape, none)
    rows, entries = np.nonzero(asked)
    out[rows, entries] = squared_rows(points[rows], book[entries])
    return out


def assigned(
    points: np.ndarray, levels: list[Level], book: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Entry of each point, the points and sums of each entry, and the distances measured."""
    entry = np.full(len(points), -1, "i8")
    n, total = np.zeros(len(book), "i8"), np.zeros(book.shape, "i8")
    nodes = np.zeros(1, "i8")
    asked = np.ones((1, len(book)), bool)
    measured = 0
    for k, level in enumerate(levels):
        d = _distances(points[level.center[nodes]], book, asked)
        measured += int(asked.sum())
        rows = np.arange(len(nodes))
        best = d.argmin(1)
        root = np.sqrt(d.astype("f8"))
        wide = 2 * level.radius[nodes] * (1 + ROOM) + ROOM * (1 + root[rows, best])
        near = root <= (root[rows, best] * (1 + ROOM) + wide)[:, None]
        near &= asked
        sure = near.sum(1) == 1
        whole = nodes[sure]
        np.add.at(n, best[sure], level.n[whole])
        np.add.at(total, best[sure], level.total[whole])
        goes = np.full(len(level.center), -1, "i8")
        goes[whole] = best[sure]
        under = goes[level.node_of]
        entry = np.where(entry < 0, under, entry)
        place = np.full(len(level.center), -1, "i8")
        place[nodes[~sure]] = np.arange(int((~sure).sum()))
        near = near[~sure]
        if k + 1 < len(levels):
            above = place[levels[k + 1].parent]
            nodes = np.flatnonzero(above >= 0)
            asked = near[above[nodes]]
        else:
            left = np.flatnonzero(entry < 0)
            asked = near[place[level.node_of[left]]]
        if not len(asked):
            break
    left = np.flatnonzero(entry < 0)
    if len(left):
        chosen = _distances(points[left], book, asked).argmin(1)
        measured += int(asked.sum())
        entry[left] = chosen
        n += np.bincount(chosen, minlength=len(book))
        np.add.at(total, chosen, points[left])
    return entry, n, total, measured


def _lists(rows: np.ndarray | list[np.ndarray]) -> pa.Array:
    """Rows of whole numbers as a column of lists."""
    sizes = [len(r) for r in rows]
    ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype("i4"))
    flat = np.concatenate([*rows, np.zeros(0, "i8")]).astype("i8")
    return pa.ListArray.from_arrays(ends, pa.array(flat))


def _stored(points: np.ndarray, levels: list[Level]) -> list[np.ndarray]:
    """A tree as arrays: widths, then center, parent, squared radius, number and sums of
    all nodes, and each point's node of the finest level."""
    far = [np.rint(level.radius**2).astype("i8") for level in levels]
    return [
        np.array([len(level.center) for level in levels]),
        np.concatenate([level.center for level in levels]),
        np.concatenate([level.parent for level in levels]),
        np.concatenate(far),
        np.concatenate([level.n for level in levels]),
        np.concatenate([level.total.ravel() for level in levels]),
        levels[-1].node_of,
    ]


_TREE = ("widths", "centers", "parents", "radii", "ns", "totals", "nodes")


def _restored(arrays: list[np.ndarray], width: int) -> list[Level]:
    widths, center, parent, far, n, total, own = arrays
    total = total.reshape(-1, width)
    stops = np.cumsum(widths)
    levels: list[Level] = []
    for stop, size in zip(stops[::-1], widths[::-1]):
        span = slice(stop - size, stop)
        levels.append(
            Level(center[span], parent[span], np.sqrt(far[span].astype("f8")), n[span], total[span], own)
        )
        own = parent[span][own]
    return levels[::-1]


def stored_trees(vectors: DataFrame) -> DataFrame:
    """A row per chunk: rows (what belongs to each vector besides v), v of all, four trees."""
    others = [c for c in vectors.columns if c != "v"]
    kinds = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in vectors.schema if f.name != "v")

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held: list[pa.RecordBatch] = []
        n = 0
        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, CHUNK - n)
                held.append(taken)
                n += taken.num_rows
                batch = batch.slice(taken.num_rows)
                if n == CHUNK:
                    yield pa.Table.from_batches(held)
                    held, n = [], 0
        if n:
            yield pa.Table.from_batches(held)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches):
            columns = {c: chunk[c].combine_chunks() for c in chunk.column_names}
            points = matrix(columns["v"])
            trees = []
            for part in np.split(points, PARTS, axis=1):
                tree = _stored(part, cover_tree(part))
                trees.append(
                    pa.StructArray.from_arrays([_lists([a]) for a in tree], list(_TREE))
                )
            own = pa.StructArray.from_arrays([columns[c] for c in others], others)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own),
                 _lists([points.ravel()]), *trees],
                ["rows", "v", *(f"tree_{k}" for k in range(PARTS))],
            )

    tree = "struct<" + ", ".join(f"{c}: array<long>" for c in _TREE) + ">"
    schema = f"rows array<struct<{kinds}>>, v array<long>" + "".join(
        f", tree_{k} {tree}" for k in range(PARTS)
    )
    return written(vectors.mapInArrow(build, schema), "cover-trees")


def _read(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, list[list[Level]], int]]:
    """The points of each chunk of a batch, its trees, and its place in the batch."""
    for k in range(batch.num_rows):
        points = batch["v"][k].values.to_numpy().reshape(-1, size)
        trees = []
        for p in range(PARTS):
            tree = batch[f"tree_{p}"][k]
            arrays = [tree[c].values.to_numpy() for c in _TREE]
            trees.append(_restored(arrays, size // PARTS))
        yield points, trees, k


def _round(trees: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round; unused entries stay."""
    _, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((PARTS, entries), "i8")
        total = np.zeros((PARTS, entries, width), "i8")
        for batch in batches:
            for points, levels, _ in _read(batch, PARTS * width):
                for p, part in enumerate(np.split(points, PARTS, axis=1)):
                    _, more, sums, _ = assigned(part, levels[p], books[p])
                    n[p] += more
                    total[p] += sums
        part, entry = np.nonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(part), pa.array(entry), pa.array(n[part, entry]), _lists(total[part, entry])],
            ["part", "entry", "n", "s"],
        )

    schema = "part long, entry long, n long, s array<long>"
    read = trees.drop("rows").mapInArrow(run, schema)
    sums = [F.sum(F.col("s")[j]) for j in range(width)]
    moved = books.copy()
    for part, entry, n, *s in read.groupBy("part", "entry").agg(F.sum("n"), *sums).collect():
        moved[part, entry] = np.array(s, "i8") // n  # floor, also below zero
    return moved


def _usual_size(rows: DataFrame, vector_col: str) -> int | None:
    """The commonest number of components that PARTS divides."""
    sizes = (
        rows.select(F.size(named(vector_col)).alias("size"))
        .where(f"size > 0 AND size % {PARTS} = 0")
        .groupBy("size")
        .count()
    )
    first = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    return first and first["size"]


def trained(vectors: DataFrame, rounds: int) -> tuple[DataFrame, np.ndarray]:
    """Stored trees of all vectors (vec_id, v and further columns) and the codebooks."""
    start = vectors.select("vec_id", "v").orderBy(F.asc_nulls_last("vec_id"), "v").limit(ENTRIES)
    first = np.array([r.v for r in start.collect()], "i8")
    trees = stored_trees(vectors)
    books = np.stack(np.split(first, PARTS, axis=1))
    for _ in range(rounds):
        books = _round(trees, books)
    return trees, books


def encoded(trees: DataFrame, books: np.ndarray) -> DataFrame:
    """The columns stored with each vector, its code, its error, and `measured`: the
    distances worked out for it, on average over its chunk."""
    size = PARTS * books.shape[2]
    row = trees.schema["rows"].dataType.elementType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for points, levels, k in _read(batch, size):
                codes, error, work = [], np.zeros(len(points), "i8"), 0
                for p, part in enumerate(np.split(points, PARTS, axis=1)):
                    entry, _, _, measured = assigned(part, levels[p], books[p])
                    codes.append(entry)
                    error += squared_rows(part, books[p][entry])
                    work += measured
                hexed = [bytes(c).hex() for c in np.stack(codes, 1).astype("u1")]
                own = batch["rows"][k].values
                yield pa.RecordBatch.from_arrays(
                    [*own.flatten(), pa.array(hexed), pa.array(error),
                     pa.array(np.full(len(points), work / len(points)))],
                    [*row.names, "code", "error", "measured"],
                )

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in row)
    return trees.mapInArrow(run, f"{kinds}, code string, error long, measured double")


def with_label_error(rows: DataFrame, label: str, identity: str) -> DataFrame:
    """Adds label_error: the error of all rows of the label, nulls together."""
    salt = F.pmod(F.xxhash64(identity, "code"), F.lit(SALTS)).cast("int")
    totals = (
        rows.groupBy(F.col(label).alias("_label"))
        .agg(F.sum("error").alias("label_error"))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    salted = rows.withColumn("_own_salt", salt)
    same = F.col(label).eqNullSafe(F.col("_label")) & (F.col("_own_salt") == F.col("_salt"))
    return salted.join(totals, same, "left").select(*rows.columns, "label_error")


def compressed(
    rows: DataFrame,
    rounds: int = 4,
    scale: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, np.ndarray | None]:
    """vec_id, label, code, error, measured and label_error of every usable vector, and
    the codebooks (part, entry, component); no codebooks for an empty table."""
    size = _usual_size(rows, vector_col)
    vectors = integer_vectors(
        rows.withColumn("label", named(label_col)), scale, size or 0, id_col, vector_col, "label"
    )
    kind = vectors.schema["label"].dataType.simpleString()
    if size is None or vectors.isEmpty():
        schema = f"vec_id long, label {kind}, code string, error long, measured double, label_error long"
        return rows.sparkSession.createDataFrame([], schema), None
    trees, books = trained(vectors, rounds)
    return with_label_error(written(encoded(trees, books), "codes"), "label", "vec_id"), books
