"""Centroid clustering of integer vectors with a LAESA pivot table.

Distances of every vector from PIVOTS fixed vectors are worked out once and stored
beside it. In a round, the distances of the centroids from the pivots are worked out
anew; |d(v, p) - d(c, p)| bounds d(v, c) from below. The centroid with the least bound
is measured first; only centroids whose bound does not exceed what that gave are
measured too, in whole numbers, so the nearest one and ties are exact.

Spark stores and reads the table, tasks add their vectors up per centroid, and a round
moves one row per task and centroid; only centroids and their sums reach the driver.

Definite results: vectors that are null, hold null or non-finite components or have
another number of components than `size` are left out; components beyond
+-67,108,864 after scaling count as that; repeated ids are vectors of their own, and
a null id stays null and is hashed as `1:`; ties in the starting hash go by the
components; with fewer vectors than centroids there are fewer centroids; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import named, written
from counterfoil.llm.vectors import integer_vectors, matrix, squared, squared_rows

PIVOTS = 8
# Vectors the pivots are chosen from: those with the smallest hashes, a bounded sample.
PIVOT_SAMPLE = 256
# Relative room for rounding of square roots: far above it, and too little to matter.
ROOM = 1e-9


def starting_vectors(vectors: DataFrame, n: int) -> np.ndarray:
    """The n vectors with the smallest sha256 of `1:<vec_id>`, in that order."""
    seed = F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = (
        vectors.select(F.sha2(seed, 256).alias("h"), "v")
        .orderBy("h", "v")
        .limit(n)
    )
    return np.array([r.v for r in chosen.collect()], "i8")


def far_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """n vectors of the sample, each the farthest from those before it."""
    chosen = [0]
    gap = squared(sample, sample[:1])[:, 0]
    while len(chosen) < min(n, len(sample)):
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, squared(sample, sample[chosen[-1] :][:1])[:, 0])
    return sample[chosen]


def with_pivots(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """The stored table: vectors and d, their distances from the pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = np.sqrt(squared(matrix(batch["v"]), pivots).astype("f8"))
                flat = pa.array(d.ravel())
                ends = pa.array(np.arange(len(d) + 1, dtype="i4") * len(pivots))
                yield batch.append_column("d", pa.ListArray.from_arrays(ends, flat))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in vectors.schema)
    return written(vectors.mapInArrow(run, schema + ", d array<double>"), "pivot-table")


def nearest(
    v: np.ndarray, d: np.ndarray, centroids: np.ndarray, to_pivots: np.ndarray
) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid and squared distance of each vector, and the distances measured."""
    bound = np.zeros((len(v), len(centroids)))
    for p in range(d.shape[1]):
        far, near = d[:, p, None], to_pivots[None, :, p]
        np.maximum(bound, np.abs(far - near) - ROOM * (far + near + 1), out=bound)
    first = bound.argmin(1)
    best = squared_rows(v, centroids[first])
    chosen = first.copy()
    reach = np.sqrt(best.astype("f8")) * (1 + ROOM) + ROOM
    open_ = bound <= reach[:, None]
    open_[np.arange(len(v)), first] = False
    for c in np.flatnonzero(open_.any(0)):
        rows = np.flatnonzero(open_[:, c])
        own = squared_rows(v[rows], centroids[c][None, :])
        better = (own < best[rows]) | ((own == best[rows]) & (c < chosen[rows]))
        best[rows[better]] = own[better]
        chosen[rows[better]] = c
    return chosen, best, len(v) + int(open_.sum())


def _round(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round; those without vectors stay."""
    to_pivots = np.sqrt(squared(centroids, pivots).astype("f8"))
    k, size = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, size), "i8")
        n = np.zeros(k, "i8")
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch["v"])
                chosen, _, _ = nearest(v, matrix(batch["d"]), centroids, to_pivots)
                np.add.at(sums, chosen, v)
                n += np.bincount(chosen, minlength=k)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(n[used]), pa.array(list(sums[used]), pa.list_(pa.int64()))],
            ["c", "n", "s"],
        )

    parts = table.select("v", "d").mapInArrow(run, "c long, n long, s array<long>")
    whole = parts.groupBy("c").agg(F.sum("n"), *(F.sum(F.col("s")[j]) for j in range(size)))
    moved = centroids.copy()
    for c, n, *sums in whole.collect():
        moved[c] = np.array(sums, "i8") // n  # floor, also below zero
    return moved


def clustered(
    rows: DataFrame,
    clusters: int = 16,
    rounds: int = 3,
    scale: int = 64,
    size: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, measured (distances worked out for the vector's batch,
    a vector), cluster_inertia, inertia and centroid (its final components)."""
    vectors = integer_vectors(rows, scale, size, id_col, vector_col)
    sample = starting_vectors(vectors, max(clusters, PIVOT_SAMPLE))
    schema = "vec_id long, cluster int, distance long, measured double"
    spark = rows.sparkSession
    if not len(sample):
        none = "cluster_inertia long, inertia long, centroid array<long>"
        return spark.createDataFrame([], f"{schema}, {none}")
    centroids, pivots = sample[:clusters], far_pivots(sample, PIVOTS)
    table = with_pivots(vectors, pivots)
    for _ in range(rounds):
        centroids = _round(table, centroids, pivots)
    to_pivots = np.sqrt(squared(centroids, pivots).astype("f8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                chosen, best, measured = nearest(
                    matrix(batch["v"]), matrix(batch["d"]), centroids, to_pivots
                )
                each = np.full(len(chosen), measured / len(chosen))
                yield pa.RecordBatch.from_arrays(
                    [batch["vec_id"], pa.array(chosen, pa.int32()), pa.array(best), pa.array(each)],
                    ["vec_id", "cluster", "distance", "measured"],
                )

    found = written(table.select("vec_id", "v", "d").mapInArrow(run, schema), "clustered")
    inertia = dict(found.groupBy("cluster").agg(F.sum("distance")).collect())
    whole = sum(inertia.values())
    # a row per centroid
    sides = spark.createDataFrame(
        [(c, own, whole, centroids[c].tolist()) for c, own in sorted(inertia.items())],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>",
    )
    return found.join(F.broadcast(sides), "cluster").select(
        *found.columns, "cluster_inertia", "inertia", "centroid"
    )


def components_sha256(components: str) -> F.Column:
    """Hash of a column of components as decimal integers joined by commas."""
    texts = F.transform(named(components), lambda x: x.cast("string"))
    return F.sha2(F.array_join(texts, ","), 256)


def joined_sha256(values: np.ndarray) -> str:
    """The same for an array of any shape, on the driver."""
    return hashlib.sha256(",".join(map(str, values.ravel().tolist())).encode()).hexdigest()
