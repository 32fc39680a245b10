"""Near-duplicates by order MinHash, verified by banded alignment.

Shingles are five neighbouring words (all words of a text with fewer). Each shingle is
labelled with its occurrence in the text. A sketch takes the LENGTH smallest labelled
shingles under a hash of its own and keeps them in text order, so two texts share a
sketch only if the same shingles come in the same order. Texts that share one of
SKETCHES sketches are candidates. The similarity of two texts is the size of the longest
common subsequence of their shingles over the size of their union, which equals the
shingle Jaccard similarity unless parts of the text have changed places.

At a similarity of 0.8 two texts share a sketch with probability of about 0.41, so all
sketches miss with 0.59^24, 3 in a million.

Definite results: a null text is the empty text; texts without words are copies of each
other only if they are equal; rows with a null id are documents as others are, and stand
for a class only if it has no other id; rows that repeat an id get the class of their own
text; an empty table gives no rows. Texts are read whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import Columns, id_and_text, map_columns, written
from counterfoil.llm.graph import components
from counterfoil.llm.words import mixed, window_hashes, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES, LENGTH = 24, 4
# Buckets of so many texts are compared in full at the end.
SMALL = 32
# Texts each bucket compares with its others, round by round: one first, to which most of
# a large group joins, so that the next round meets few texts of another class.
CENTERS = (1, 4)
# Texts on each side of a block, about, when what the centers left open is compared.
BLOCK = 512
# Bins of a text's histogram of shingles, by which most pairs of a block are ruled out.
BINS = 256
_SEEDS = mixed(np.arange(1, SKETCHES + 1, dtype=np.uint64))
# Elements of the table of hashes worked on at once.
_AT_ONCE = 1 << 18


def shingles(text: str) -> np.ndarray:
    """Hashes of the shingles in text order."""
    words = word_hashes(text)
    return window_hashes(words, min(SHINGLE, len(words))) if len(words) else words


def labelled(found: np.ndarray) -> np.ndarray:
    """Hashes of shingles together with the number of equal ones before them."""
    order = np.argsort(found, kind="stable")
    run = found[order]
    first = np.flatnonzero(np.r_[True, run[1:] != run[:-1]])
    if len(first) == len(found):
        return found
    nth = np.empty(len(found), np.uint64)
    nth[order] = np.arange(len(found)) - np.repeat(first, np.diff(np.r_[first, len(found)]))
    return mixed(found + nth * np.uint64(0xA24BAED4963EE407))


def histogram(found: np.ndarray) -> np.ndarray:
    """How many shingles fall into each bin, 255 standing for more too."""
    counts = np.bincount((found % np.uint64(BINS)).astype(np.int64), minlength=BINS)
    return np.minimum(counts, 255).astype(np.uint8)


def sketches(found: np.ndarray) -> list[int]:
    """The order MinHash sketches of a text's shingles, each as a signed 64-bit key."""
    if not len(found):
        return []
    values = labelled(found)
    length = min(LENGTH, len(values))
    keys = []
    step = max(1, _AT_ONCE // len(values))
    for start in range(0, SKETCHES, step):
        seeds = _SEEDS[start : start + step, None]
        ranked = mixed(values[None, :] ^ seeds)
        if length < len(values):
            chosen = np.sort(np.argpartition(ranked, length - 1, axis=1)[:, :length], axis=1)
        else:
            chosen = np.broadcast_to(np.arange(length), (len(seeds), length))
        key = seeds[:, 0].copy()
        for k in range(length):
            key = mixed(key * np.uint64(3) + values[chosen[:, k]])
        keys += key.view(np.int64).tolist()
    return keys


def common_in_order(a: np.ndarray, b: np.ndarray, least: int) -> int:
    """Size of the longest common subsequence, if it is `least` or more; else something less.

    Elements that the other side lacks are left out first, then equal ends. What remains
    is aligned bit-parallel within the band that a result of `least` can use.
    """
    a, b = a[np.isin(a, b)], b[np.isin(b, a)]
    if min(len(a), len(b)) < least:
        return 0
    if np.array_equal(a, b):
        return len(a)
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b, short = a[head:], b[head:], short - head
    differ = np.flatnonzero(a[len(a) - short :][::-1] != b[len(b) - short :][::-1])
    tail = int(differ[0]) if len(differ) else short
    a, b = a[: len(a) - tail].tolist(), b[: len(b) - tail].tolist()
    band = max(len(a), len(b)) - max(0, least - head - tail)
    places: dict[int, int] = {}
    for j, value in enumerate(b):
        places[value] = places.get(value, 0) | 1 << j
    window = (1 << 2 * band + 1) - 1
    full = (1 << len(b)) - 1
    rest = full
    for i, value in enumerate(a):
        hit = places[value] if value in places else 0
        hit &= window << i - band if i >= band else window >> band - i
        both = rest & hit
        rest = ((rest + both) | (rest - both)) & full
    return head + tail + len(b) - rest.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Of two texts' shingles, exact from `least` on and below it less than it."""
    total = len(a) + len(b)
    need = int(np.ceil(round(least * total / (1 + least), 9)))
    if min(len(a), len(b)) < max(need, 1):
        return 0.0
    common = common_in_order(a, b, need)
    return common / (total - common)


def _sketched(docs: DataFrame) -> DataFrame:
    def make(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            found = [shingles(t) for t in batch["text"]]
            yield {
                "doc_id": batch["doc_id"],
                "text_hash": [hashlib.md5(t.encode()).digest() for t in batch["text"]],
                "n_shingles": [len(f) for f in found],
                "sketches": [sketches(f) for f in found],
                "bins": [histogram(f).tobytes() for f in found],
            }

    return map_columns(
        docs, make,
        "doc_id long, text_hash binary, n_shingles int, sketches array<long>, bins binary",
    )


def _verified(pairs: DataFrame, texts: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of numbers of texts that are similar enough: a, b, similarity.

    texts: id (a number) and text_hash of the folded texts; docs: doc_id and text. Texts
    without a partner are left out by the first join. The later joins are plain ones on a
    number, so a text with very many partners is split by adaptive execution.
    """
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    keys = texts.join(ids, "id", "left_semi").select("id", F.col("text_hash").alias("own"), "first_id")
    hashed = docs.select("doc_id", F.unhex(F.md5("text")).alias("text_hash"), "text")
    # rows with the smallest id of their text: copies of a hot text are not moved
    same = (F.col("text_hash") == F.col("own")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    used = hashed.join(keys, same).groupBy("id").agg(F.first("text").alias("text"))
    used = written(used, "near-texts")
    with_b = pairs.join(used.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    with_both = with_b.join(used.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")

    def check(batches: Iterator[Columns]) -> Iterator[Columns]:
        last, own = None, np.empty(0, np.uint64)
        for batch in batches:
            out: Columns = {"a": [], "b": [], "similarity": []}
            for a, b, text_a, text_b in zip(
                batch["a"], batch["b"], batch["text_a"], batch["text_b"], strict=True
            ):
                if a != last:
                    last, own = a, shingles(text_a)
                value = similarity(own, shingles(text_b), least)
                if value >= least:
                    out["a"].append(a)
                    out["b"].append(b)
                    out["similarity"].append(value)
            yield out

    return map_columns(
        with_both.select("a", "b", "text_a", "text_b"), check, "a long, b long, similarity double"
    )


def _placed(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Buckets that hold several classes so far, with the class of each text."""
    now = buckets.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    span = now.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
    return written(now.join(span.where("lo <> hi").select("key"), "key", "left_semi"), "open")


def _as_pairs(both: DataFrame, least: float) -> DataFrame:
    """Texts of different classes whose sizes allow the similarity, smaller id first."""
    fits = F.least("n", "n_c") >= least * F.greatest("n", "n_c")
    chosen = both.where(fits & (F.col("label") != F.col("label_c")))
    return chosen.select(F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b"))


def _center_pairs(placed: DataFrame, turn: int, least: float) -> DataFrame:
    """Each text with the centers of its buckets, other ones each round.

    The smallest doc_id comes first: it is often what the others were copied from.
    """
    text = F.struct("id", "n", "label")
    last = F.lit((1 << 63) - 1)
    seeds = range(sum(CENTERS[:turn]) + 1, sum(CENTERS[: turn + 1]))
    picks = [
        F.min(F.struct(F.xxhash64("id", "key", F.lit(seed)).alias("h"), text.alias("t")))["t"]
        for seed in seeds
    ]
    first = (F.min_by if turn == 0 else F.max_by)(text, F.coalesce("first_id", last))
    centers = placed.groupBy("key").agg(F.array_distinct(F.array(first, *picks)).alias("centers"))
    # a text has at most SKETCHES buckets, so what it meets is bounded; each center once
    met = (
        placed.join(centers, "key")
        .groupBy("id", "n", "label")
        .agg(F.array_distinct(F.flatten(F.collect_list("centers"))).alias("met"))
    )
    open_ = F.filter("met", lambda t: t["label"] != F.col("label"))
    each = met.select("id", "n", "label", F.explode(open_).alias("t"))
    return _as_pairs(
        each.select(
            "id", "n", "label",
            F.col("t.id").alias("c"), F.col("t.n").alias("n_c"), F.col("t.label").alias("label_c"),
        ),
        least,
    )


def _cross_pairs(placed: DataFrame, least: float) -> DataFrame:
    """All pairs of different classes in buckets of a bounded size."""
    other = placed.select(
        "key", F.col("id").alias("c"), F.col("n").alias("n_c"), F.col("label").alias("label_c")
    )
    return _as_pairs(placed.join(other, "key").where("id < c"), least)


def may_be_similar(
    n: int, own: np.ndarray, others: np.ndarray, bins: np.ndarray, least: float
) -> np.ndarray:
    """Whether a text can be similar enough to others, from numbers of shingles and bins.

    What one bin holds more of on one side than on the other has no partner there, so the
    result is false only where the similarity is below `least`.
    """
    total = others + n
    need = np.ceil(np.round(least * total / (1 + least), 9))
    most = np.maximum(bins, own)
    here = n - (most - bins).sum(axis=1, dtype=np.int64)
    there = others - (most - own).sum(axis=1, dtype=np.int64)
    return np.minimum(here, there) >= need


def _block_pairs(placed: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """All pairs of different classes in open buckets that can be similar enough.

    Texts outside a bucket's largest class meet all texts of the bucket, in blocks by size
    band and salts: similar texts are in one band or in neighbouring ones.
    """
    width = math.log(1 / least) + 1e-9
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(width))
    classes = placed.groupBy("key", "label").agg(F.count(F.lit(1)).alias("size"))
    largest = classes.groupBy("key").agg(F.max(F.struct("size", "label"))["label"].alias("main"))
    open_ = placed.join(largest, "key").select(
        "key", "id", "n", "label", band.alias("band"), (F.col("label") != F.col("main")).alias("minor")
    )
    near = F.explode(F.array(*(F.col("band") + d for d in (-1, 0, 1)))).alias("band")
    minor = open_.where("minor").select("key", "id", "n", "label", near, "minor")
    some = minor.groupBy("key", "band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("rows"))
    all_ = open_.groupBy("key", "band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("columns"))
    # buckets' bands with both sides, and how many blocks they take
    cut = written(some.join(all_, ["key", "band"]), "blocks")

    def dealt(side: DataFrame, own: str, other: str, left: bool) -> DataFrame:
        mine = F.pmod(F.xxhash64("id", "key"), F.col(own)).alias(own[0])
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1)).alias(other[0])
        both = side.join(cut, ["key", "band"]).select(
            "key", "band", "id", "n", "label", "minor", F.lit(left).alias("left"), mine, each
        )
        return both.select("key", "band", "r", "c", "id", "n", "label", "minor", "left")

    sides = dealt(minor, "rows", "columns", True).unionByName(dealt(open_, "columns", "rows", False))
    sides = sides.join(texts.select("id", "bins"), "id")

    def meet(block: pa.Table) -> pa.Table:
        ids, n, label, is_minor, left = (
            block[c].to_numpy() for c in ("id", "n", "label", "minor", "left")
        )
        bins = np.frombuffer(b"".join(block["bins"].to_pylist()), np.uint8).reshape(-1, BINS)
        n = n.astype(np.int64)
        found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for k in np.flatnonzero(left):
            # two texts outside the largest class meet twice
            fits = ~left & (label != label[k]) & (~is_minor | (ids > ids[k]))
            fits &= np.minimum(n, n[k]) >= least * np.maximum(n, n[k])
            at = np.flatnonzero(fits)
            at = at[may_be_similar(n[k], bins[k], n[at], bins[at], least)]
            found_a.append(np.minimum(ids[at], ids[k]))
            found_b.append(np.maximum(ids[at], ids[k]))
        return pa.table({"a": np.concatenate(found_a), "b": np.concatenate(found_b)})

    return sides.groupBy("key", "band", "r", "c").applyInArrow(meet, "a long, b long")


def _new(pairs: DataFrame, compared: DataFrame | None) -> DataFrame:
    pairs = pairs.distinct()
    if compared is not None:
        pairs = pairs.join(compared, ["a", "b"], "left_anti")
    return written(pairs, "pairs")


def near_classes(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = SIMILARITY
) -> DataFrame:
    """One row per document: doc_id, class_id, kept, text_hash, class_hash.

    A class is named by the row that stands for it: the smallest doc_id (nulls last), and
    of texts with that id the one with the smallest hash, class_hash.

    Equal texts are folded first, by content hash, and numbered: texts are told apart by
    that number, never by an id, which may repeat or be null. Then come rounds, one for each number in
    CENTERS: each bucket of texts with a common sketch picks so many of its texts, other
    ones each round, and compares them with those of the bucket that are in another class
    so far. A round costs that many comparisons per text and bucket at most, however large
    the bucket. Buckets of
    at most SMALL texts that still hold several classes after the rounds before the last
    are compared in full. What larger buckets still hold of different classes after the
    rounds is compared in full as well, in blocks, so no two similar texts that share a
    sketch stay in different classes.
    """
    plain = id_and_text(docs, id_col, text_col)
    found = written(_sketched(plain), "sketches")
    # one id for each distinct text; a third of all rows with one text fold in their tasks
    texts = found.groupBy("text_hash").agg(
        F.min("doc_id").alias("first_id"),
        F.first("n_shingles").alias("n"),
        F.first("sketches").alias("sketches"),
        F.first("bins").alias("bins"),
    )
    texts = written(texts.withColumn("id", F.monotonically_increasing_id()), "near-ids")
    every = texts.select("id", "first_id", "n", F.explode("sketches").alias("key"))
    sizes = every.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    buckets = written(every.join(sizes.where("members > 1"), "key"), "buckets")

    placed = buckets.withColumn("label", F.col("id"))
    links = compared = None
    for turn in range(len(CENTERS)):
        pairs = _center_pairs(placed, turn, least)
        if turn == len(CENTERS) - 1:
            small = placed.where(F.col("members") <= SMALL)
            pairs = pairs.unionByName(_cross_pairs(small, least))
        pairs = _new(pairs, compared)
        more = written(_verified(pairs, texts, plain, least), "links")
        compared = pairs if compared is None else compared.unionByName(pairs)
        links = more if links is None else links.unionByName(more)
        labels = components(links)
        if turn < len(CENTERS) - 1:
            placed = _placed(buckets, labels)
    placed = _placed(buckets.where(F.col("members") > SMALL), labels)
    if not placed.isEmpty():
        pairs = _new(_block_pairs(placed, texts, least), compared)
        more = written(_verified(pairs, texts, plain, least), "links")
        labels = components(links.unionByName(more))
    named_by = F.struct(
        F.col("first_id").isNull().alias("unknown"), F.col("first_id").alias("id"), "text_hash"
    )
    label = F.coalesce("label", "id").alias("label")
    per_text = written(
        texts.join(labels, "id", "left").select("text_hash", "first_id", label), "near-classes"
    )
    classes = per_text.groupBy("label").agg(F.min(named_by).alias("by"))
    per_text = per_text.join(classes, "label").select(
        "text_hash", F.col("by.id").alias("class_id"), F.col("by.text_hash").alias("class_hash")
    )
    stands = F.col("doc_id").eqNullSafe(F.col("class_id")) & (
        F.col("text_hash") == F.col("class_hash")
    )
    return found.select("doc_id", "text_hash").join(per_text, "text_hash").select(
        "doc_id",
        "class_id",
        stands.alias("kept"),
        F.lower(F.hex("text_hash")).alias("text_hash"),
        F.lower(F.hex("class_hash")).alias("class_hash"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stand for their class, all columns as they came.

    Rows that equal each other in id and text stay together.
    """
    marks = near_classes(docs, id_col, text_col).where("kept").select("doc_id", "text_hash").distinct()
    own = F.md5(F.coalesce(docs[f"`{text_col}`"].cast("string"), F.lit("")))
    same = docs[f"`{id_col}`"].eqNullSafe(marks["doc_id"]) & (own == marks["text_hash"])
    return docs.join(marks, same, "left_semi")
