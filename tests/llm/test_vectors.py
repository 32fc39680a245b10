"""Sharding, clustering and vector codes against brute force and odd input."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from counterfoil.llm import centroids, sharding, vector_codes
from counterfoil.llm.queries import QUERIES
from counterfoil.llm.vectors import integer_vectors, squared, squared_rows

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, shard string, _h array<int>"
VECTORS = "vec_id long, embedding array<double>, label string, v int, d string"


# --- sharding ---------------------------------------------------------------------


def check_shards(found, texts, shards, tolerance=sharding.TOLERANCE):
    """Sizes within the law, slots gapless, equal texts together unless they must be cut."""
    total = sum(r["size"] for r in found)
    ordered = sorted(found, key=lambda r: (r.shard, r.slot))
    by_shard = defaultdict(list)
    for r in ordered:
        by_shard[r.shard].append(r)
    assert set(by_shard) <= set(range(shards))
    for own in by_shard.values():
        assert [r.slot for r in own] == list(range(len(own)))
    place, borders = 0, []
    sizes = [r["size"] for r in ordered]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    for k in range(1, shards):
        place = sum(r["size"] for r in found if r.shard < k)
        borders.append(place)
        nearest = np.abs(starts - k * total / shards).min()
        slack = max(tolerance * total / shards, nearest)
        assert abs(place - k * total / shards) <= slack + 1e-6
    keys = [texts(r) for r in ordered]
    runs = sum(a != b for a, b in zip(keys, keys[1:])) + 1
    assert runs == len(set(keys))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sharding_of_whole_tables(spark, sf):
    folder = f"/root/testdata/{sf}"
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = QUERIES["op11_sharding"](spark, folder).collect()
    assert sorted(r.doc_id for r in found) == sorted(docs)
    for r in found:
        data = docs[r.doc_id].encode()
        assert (r["size"], r.text_crc32) == (len(data) + 1, zlib.crc32(data))
        assert (r.law, r.grown_shard) == ("bytes", None)
    check_shards(found, lambda r: docs[r.doc_id], 16)


def hot_rows(n):
    """A third with one text and one null id, a third with one text; the rest their own."""
    rows = [(None, "copy of " * 20, "x", [1])] * n
    rows += [(k, "shared " * 25, "y", None) for k in range(n)]
    return rows + [(n + k, f"own {k} " * (k % 40), None, []) for k in range(n)]


@pytest.mark.parametrize("parts", [2, 40])
def test_sharding_cuts_hot_groups(spark, parts):
    rows = hot_rows(600)
    docs = spark.createDataFrame(rows, DOCS).repartition(parts)
    found = sharding.sharded(docs, 16, part_bytes=4000).collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in found))) == sorted(
        map(repr, (row[:2] for row in rows))
    )
    assert sorted(map(repr, (r._h for r in found))) == sorted(repr(row[3]) for row in rows)
    check_shards(found, lambda r: r.text, 16)


def test_parts_of_a_hot_group_are_bounded(spark):
    docs = spark.createDataFrame(hot_rows(600), DOCS)
    path_rows = sharding.written(sharding.keyed(docs, []), "test-keys")
    found = sharding.layout(path_rows, 16, part_bytes=4000)
    total = path_rows.agg(F.sum("size")).first()[0]
    assert len(found.starts) >= total / 4000
    arrays = sharding._arrays(found.starts)
    rows = path_rows.select("_h", "_i", "_t", "size").toPandas()
    at = sharding._below([rows[c].to_numpy() for c in ("_h", "_i", "_t")], arrays) - 1
    assert at.min() == 0
    assert rows.groupby(at)["size"].sum().max() <= 2 * 4000


def test_sharding_of_odd_rows(spark, tmp_path):
    rows = [(1, None, "a", [1]), (1, None, "a", [1]), (None, "", "b", None), (2, "é" * 70000, None, [])]
    rows += [(3, "tie", "c", [2])] * 5
    docs = spark.createDataFrame(rows, DOCS)
    found = sharding.sharded(docs, 4)
    assert found.columns == ["text", "_h", "doc_id", "size", "text_crc32", "shard", "slot"]
    kept = found.collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept))) == sorted(
        map(repr, (row[:2] for row in rows))
    )
    check_shards(kept, lambda r: r.text or "", 4)
    sharding.write_shards(found, f"{tmp_path}/shards")
    back = spark.read.parquet(f"{tmp_path}/shards").select(*found.columns).collect()
    assert sorted(map(repr, back)) == sorted(map(repr, kept))
    assert sharding.sharded(docs.where("false")).collect() == []
    only = sharding.sharded(docs.limit(1), 16).collect()
    assert [(r.slot, r["size"]) for r in only] == [(0, 1)]


# --- clustering -------------------------------------------------------------------


def brute_clusters(vectors, clusters=16, rounds=3):
    """(vec_id, integer vector) to the clusters and the centroids."""
    start = sorted(vectors, key=lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))
    centers = np.array([v for _, v in start[:clusters]])
    points = np.array([v for _, v in vectors])
    for r in range(rounds + 1):
        d = ((points[:, None, :] - centers[None, :, :]) ** 2).sum(2)
        own = d.argmin(1)
        if r < rounds:
            for c in set(own.tolist()):
                centers[c] = points[own == c].sum(0) // (own == c).sum()
    return own, d.min(1), centers


def odd_vectors(rng, n=300):
    rows = [(k, rng.normal(size=64).tolist(), f"l{k % 3}", k, "d") for k in range(n)]
    rows += [(n + k, rows[7][1], None, None, None) for k in range(n // 2)]  # hot copies
    rows += [(5, rows[9][1], "l0", 1, "d")] * 2  # repeated rows and ids
    rows += [
        (9001, None, "l1", 1, "d"),
        (9002, [], "l1", 1, "d"),
        (9003, [1.0] * 63 + [None], "l1", 1, "d"),
        (9004, [1.0] * 63 + [float("nan")], None, 1, "d"),
        (9005, [float("-inf")] + [1.0] * 63, "l1", 1, "d"),
        (9006, [1.0] * 12, "l1", 1, "d"),
        (9007, [0.0] * 64, "l1", 1, "d"),
    ]
    return rows


def test_clusters_against_brute_force(spark):
    rows = odd_vectors(np.random.default_rng(5))
    kept = [(i, np.floor(64 * np.array(e)).astype("i8").tolist())
            for i, e, *_ in rows if e and len(e) == 64 and None not in e and np.isfinite(e).all()]
    own, best, centers = brute_clusters(kept)
    found = centroids.clustered(spark.createDataFrame(rows, VECTORS).repartition(7)).collect()
    wanted = [
        (i, int(c), int(d), int(best[own == c].sum()), int(best.sum()), centers[c].tolist())
        for (i, _), c, d in zip(kept, own, best)
    ]
    got = [(r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid) for r in found]
    assert sorted(got) == sorted(wanted)


def test_pivots_spare_distances(spark):
    """Far fewer distances than centroids where vectors lie in groups."""
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(20, 64)) * 4
    rows = [(k, (middles[k % 20] + rng.normal(size=64) / 50).tolist(), "", 0, "") for k in range(2000)]
    found = centroids.clustered(spark.createDataFrame(rows, VECTORS))
    assert found.agg(F.avg("measured")).first()[0] < 8


def test_clusters_of_few_and_extreme_vectors(spark):
    rows = [(None, [1e300] * 64, None, None, None), (None, [-1e300] * 64, None, None, None)]
    rows += [(2, [0.5] * 64, "", 1, "")] * 3
    found = sorted(centroids.clustered(spark.createDataFrame(rows, VECTORS)).collect(), key=repr)
    assert len(found) == 5 and all(r.distance == 0 for r in found)
    assert {tuple(set(r.centroid)) for r in found} == {(32,), (1 << 26,), (-(1 << 26),)}
    empty = spark.createDataFrame([], VECTORS)
    assert centroids.clustered(empty).columns == centroids.clustered(
        spark.createDataFrame(rows, VECTORS)
    ).columns
    assert centroids.clustered(empty).collect() == []


def test_ties_go_to_the_smaller_number():
    points = np.zeros((3, 4), "i8")
    centers = np.array([[1, 0, 0, 0], [0, 1, 0, 0], [0, 0, 0, 1]])
    pivots = np.array([[5, 5, 5, 5], [0, 0, 0, 9]])
    d = np.sqrt(squared(points, pivots))
    chosen, best, _ = centroids.nearest(points, d, centers, np.sqrt(squared(centers, pivots)))
    assert chosen.tolist() == [0, 0, 0] and best.tolist() == [1, 1, 1]


def test_exact_distances_of_large_numbers():
    a = np.array([[1 << 26] * 64, [(1 << 26) - 1] * 64, [0] * 64])
    b = -a
    wanted = [[sum((int(x) - int(y)) ** 2 for x, y in zip(p, q)) for q in b] for p in a]
    assert squared(a, b).tolist() == wanted
    assert squared_rows(a, b).tolist() == [wanted[k][k] for k in range(3)]


# --- vector codes -----------------------------------------------------------------


def brute_codes(vectors, rounds=4):
    vectors = sorted(vectors, key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    points = np.array([v for _, _, v in vectors])
    error, codes, books = 0, [], []
    for part in np.split(points, 4, axis=1):
        book = part[:256].copy()
        for r in range(rounds + 1):
            d = ((part[:, None, :] - book[None, :, :]) ** 2).sum(2)
            own = d.argmin(1)
            if r < rounds:
                for c in set(own.tolist()):
                    book[c] = part[own == c].sum(0) // (own == c).sum()
        codes.append(own)
        books.append(book)
        error = error + d.min(1)
    texts = ["".join(f"{int(c):02x}" for c in row) for row in zip(*codes)]
    return vectors, texts, error, np.stack(books)


@pytest.mark.parametrize("parts", [1, 9])
def test_codes_against_brute_force(spark, parts):
    rows = odd_vectors(np.random.default_rng(8), 700)
    rows.append((None, rows[3][1], None, None, None))
    kept = [(i, label, np.floor(1024 * np.array(e)).astype("i8").tolist())
            for i, e, label, *_ in rows if e and len(e) == 64 and None not in e and np.isfinite(e).all()]
    vectors, texts, error, books = brute_codes(kept)
    by_label = defaultdict(int)
    for (_, label, _), e in zip(vectors, error):
        by_label[label] += int(e)
    found, own_books = vector_codes.compressed(spark.createDataFrame(rows, VECTORS).repartition(parts))
    wanted = [(i, label, t, int(e), by_label[label]) for (i, label, _), t, e in zip(vectors, texts, error)]
    got = [(r.vec_id, r.label, r.code, r.error, r.label_error) for r in found.collect()]
    assert (own_books == books).all()
    assert sorted(map(repr, got)) == sorted(map(repr, wanted))


@pytest.mark.parametrize("kind", ["spread", "grouped", "copies"])
def test_cover_tree(kind):
    rng = np.random.default_rng(2)
    points = rng.integers(-500, 500, size=(700, 16))
    if kind == "grouped":
        points = points[rng.integers(0, 9, 700)] + rng.integers(-3, 4, size=(700, 16))
    if kind == "copies":
        points = points[rng.integers(0, 5, 700)]
    levels = vector_codes.cover_tree(points)
    assert len(levels[0].center) == 1
    for k, level in enumerate(levels):
        centers = points[level.center]
        assert level.n.sum() == 700 and (level.total.sum(0) == points.sum(0)).all()
        far = np.sqrt(squared_rows(points, centers[level.node_of]))
        assert (far <= level.radius[level.node_of] + 1e-9).all()
        if k:
            above = levels[k - 1]
            assert (above.center == level.center[: len(above.center)]).all()
            assert (level.parent[level.node_of] == above.node_of).all()
            apart = np.sqrt(squared(centers, centers)) + 1e9 * np.eye(len(centers))
            cover = np.sqrt(squared(points, points[above.center]).min(1).max())
            assert apart.min() > 0 and cover >= 0
    book = points[rng.choice(700, 100)]
    entry, n, total, measured = vector_codes.assigned(points, levels, book)
    d = squared(points, book)
    assert (entry == d.argmin(1)).all()
    assert (n == np.bincount(entry, minlength=100)).all()
    for c in range(100):
        assert (total[c] == points[entry == c].sum(0)).all()
    if kind != "spread":
        assert measured < 700 * 100 / 2


def test_trees_are_read_as_stored():
    points = np.random.default_rng(3).integers(-90, 90, size=(300, 16))
    levels = vector_codes.cover_tree(points)
    back = vector_codes._restored(vector_codes._stored(points, levels), 16)
    assert len(back) == len(levels)
    for a, b in zip(levels, back):
        for name in ("center", "parent", "n", "total", "node_of"):
            assert (getattr(a, name) == getattr(b, name)).all()
        assert np.allclose(a.radius, b.radius)


def test_codes_of_few_and_no_vectors(spark):
    rows = [(k, [1e300 * (k - 1)] * 8, None, None, None) for k in range(3)]
    found, books = vector_codes.compressed(spark.createDataFrame(rows, VECTORS))
    assert books.shape == (4, 3, 2)
    assert [(r.vec_id, r.code, r.error) for r in found.orderBy("vec_id").collect()] == [
        (0, "00000000", 0), (1, "01010101", 0), (2, "02020202", 0)
    ]
    none, books = vector_codes.compressed(spark.createDataFrame([], VECTORS))
    assert none.collect() == [] and books is None
    useless = spark.createDataFrame([(1, None, None, 1, ""), (2, [float("nan")] * 4, "", 1, "")], VECTORS)
    assert vector_codes.compressed(useless)[0].collect() == []


def test_usable_vectors(spark):
    rows = odd_vectors(np.random.default_rng(5), 10)
    kept = integer_vectors(spark.createDataFrame(rows, VECTORS), 64, 64, "vec_id", "embedding", "label")
    assert kept.columns == ["vec_id", "v", "label"]
    assert kept.where("vec_id > 9000").select("vec_id").collect() == [(9007,)]
