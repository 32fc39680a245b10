"""Repeated passages by a sparse suffix array.

Of all suffixes (by words) only those are kept that start at a minimiser: the smallest
of WINDOW neighbouring k-mer hashes. Equal passages of MIN_WORDS words have a minimiser
at the same place within their first WINDOW words, so the suffixes there agree in
PREFIX words. Suffixes are sorted by that prefix, then by what follows it, over the whole corpus;
neighbours with
equal prefixes are compared, runs of neighbours that keep their distance are joined,
and each run is extended word by word to the left and to the right. What reaches
MIN_WORDS words is a repeated passage of both documents; passages that overlap in a document are
reported as one.

Each suffix meets NEAR neighbours on each side only, so a passage in a third of all
documents costs NEAR comparisons per document. Passages that all documents of a group
share are found in each of them. Where several texts agree around a word to different
lengths, two of them may have others between them at every minimiser of their passage;
such a passage can be missed if it is not much longer than MIN_WORDS words.

Definite results: a null text is the empty text; null ids are kept; rows that repeat
both id and text count as one document; texts of fewer than MIN_WORDS words have no
passages; an empty table gives no rows. Texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from counterfoil.llm.common import Columns, id_and_text, map_columns, written
from counterfoil.llm.words import window_hashes, word_hashes

MIN_WORDS, KMER, WINDOW = 50, 5, 20
PREFIX = MIN_WORDS - WINDOW + 1
NEAR = 2  # so many neighbours on each side are compared
CONTEXT = WINDOW - 1  # a longer extension would meet the next minimiser
NO_ID = -(1 << 63)

_SUFFIX = pa.schema(
    [
        ("key", pa.int64()), ("next", pa.int32()), ("doc", pa.int64()), ("hash", pa.int64()),
        ("pos", pa.int32()),
    ]
)
_SUFFIX_TYPE = "key long, next int, doc long, hash long, pos int"
_ORDER = ["key", "next", "doc", "hash", "pos"]
_PAIR = pa.schema([*_SUFFIX, ("doc2", pa.int64()), ("hash2", pa.int64()), ("pos2", pa.int32())])


def minimisers(words: np.ndarray) -> np.ndarray:
    """Places of the minimisers that have PREFIX words after them."""
    kmers = window_hashes(words, KMER)
    if len(words) < MIN_WORDS:
        return np.empty(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(kmers, WINDOW)
    step = 1 << 16
    places = [
        start + np.arange(len(part)) + part.argmin(axis=1)
        for start in range(0, len(views), step)
        if len(part := views[start : start + step])
    ]
    found = np.unique(np.concatenate(places))
    return found[found + PREFIX <= len(words)]


def sparse_suffixes(docs: DataFrame) -> DataFrame:
    """Kept suffixes: key (hash of the prefix), next (hash of what follows it up to
    MIN_WORDS words), doc, hash (of the text), pos."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for doc, own, text in zip(*(batch[c].to_pylist() for c in range(3)), strict=True):
                words = word_hashes(text)
                places = minimisers(words)
                if len(places):
                    keys = window_hashes(words, PREFIX)[places].view(np.int64)
                    later = window_hashes(words, MIN_WORDS)
                    later = np.r_[later, np.zeros(MIN_WORDS, np.uint64)][places]
                    parts.append((keys, later.astype(np.uint32).view(np.int32), doc, own, places))
            if parts:
                sizes = [len(p[0]) for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([p[0] for p in parts])),
                        pa.array(np.concatenate([p[1] for p in parts])),
                        pa.array(np.repeat([p[2] for p in parts], sizes)),
                        pa.array(np.repeat([p[3] for p in parts], sizes)),
                        pa.array(np.concatenate([p[4] for p in parts]).astype(np.int32)),
                    ],
                    schema=_SUFFIX,
                )

    return docs.mapInArrow(make, _SUFFIX_TYPE)


def _neighbours(suffixes: DataFrame) -> DataFrame:
    """Neighbours with equal prefix in the sorted order, the two of one partition and of two.

    Rows are dealt by ranges of the whole sort key, so suffixes with one very common
    prefix are spread over as many partitions as they fill. Each partition also gives its
    first and last suffix (without a partner), which are compared among themselves.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = [batch[c].to_numpy(zero_copy_only=False) for c in range(len(_ORDER))]
            if last is None:
                yield _rows([c[:1] for c in now], None)
                last = [c[:0] for c in now]
            new = len(now[0])
            now = [np.concatenate([p, c]) for p, c in zip(last, now, strict=True)]
            for away in range(1, NEAR + 1):
                start = max(0, len(now[0]) - new - away)
                left = [c[start : len(c) - away] for c in now]
                right = [c[start + away :] for c in now]
                same = left[0] == right[0]
                same &= ~np.logical_and.reduce([a == b for a, b in zip(left[2:], right[2:])])
                if same.any():
                    yield _rows([c[same] for c in left], [c[same] for c in right[2:]])
            last = [c[-NEAR:].copy() for c in now]
        if last is not None:
            yield _rows([c[-1:] for c in last], None)

    def _rows(own: list[np.ndarray], other: list[np.ndarray] | None) -> pa.RecordBatch:
        if other is None:
            rest = [pa.nulls(len(own[0]), f.type) for f in list(_PAIR)[len(_ORDER) :]]
        else:
            rest = [pa.array(c) for c in other]
        return pa.RecordBatch.from_arrays([*map(pa.array, own), *rest], schema=_PAIR)

    ranged = suffixes.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    found = written(
        ranged.mapInArrow(compare, _SUFFIX_TYPE + ", doc2 long, hash2 long, pos2 int"), "neighbours"
    )
    # two rows per partition, whatever the table
    along = Window.orderBy(*_ORDER)
    ends = found.where("doc2 IS NULL").select(
        *_ORDER, *(F.lead(c).over(along).alias(f"{c}2") for c in _ORDER)
    )
    across = ends.where("key = key2 AND NOT (doc = doc2 AND hash = hash2 AND pos = pos2)")
    return found.where("doc2 IS NOT NULL").unionByName(across.drop("key2", "next2"))


def _runs(pairs: DataFrame) -> DataFrame:
    """Neighbours that keep their distance, joined: first and last place in the first text."""
    same = ["doc", "hash", "doc2", "hash2", "shift"]
    shifted = pairs.select(
        "doc", "hash", "doc2", "hash2", (F.col("pos2") - F.col("pos")).alias("shift"), "pos"
    )
    along = Window.partitionBy(*same).orderBy("pos")
    parted = shifted.withColumn(
        "new", F.coalesce(F.col("pos") - F.lag("pos").over(along) > PREFIX, F.lit(True))
    ).withColumn("run", F.sum(F.col("new").cast("int")).over(along))
    return parted.groupBy(*same, "run").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))


def _context(words: np.ndarray, first: int, last: int) -> tuple[bytes, bytes]:
    """Hashes of the words before first, nearest first, and after the prefix at last."""
    before = words[max(0, first - CONTEXT) : first][::-1]
    after = words[last + PREFIX : last + PREFIX + CONTEXT]
    return before.astype("<u4").tobytes(), after.astype("<u4").tobytes()


def _agree(a: bytes, b: bytes) -> int:
    size = min(len(a), len(b))
    differ = np.flatnonzero(np.frombuffer(a[:size], "<u4") != np.frombuffer(b[:size], "<u4"))
    return int(differ[0]) if len(differ) else size // 4


def _with_text(rows: DataFrame, docs: DataFrame, doc: str, own: str) -> DataFrame:
    """Rows gathered by text (at most one per suffix of it), beside the text."""
    rest = [c for c in rows.columns if c not in (doc, own)]
    gathered = rows.groupBy(F.col(doc).alias("doc"), F.col(own).alias("hash")).agg(
        F.collect_list(F.struct(*rest)).alias("rows")
    )
    once = docs.join(gathered, ["doc", "hash"])
    return once.select("doc", "hash", "text", "rows")


def repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Passages of MIN_WORDS words or more that stand elsewhere too, in words from 0:
    doc_id, start_word, end_word (exclusive), n_words, other_doc_id (the smallest met).
    """
    plain = id_and_text(docs, id_col, text_col).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc"), F.xxhash64("text").alias("hash"), "text"
    )
    suffixes = written(sparse_suffixes(plain), "suffixes")
    runs = written(_runs(_neighbours(suffixes)), "runs")

    def first_side(batches: Iterator[Columns]) -> Iterator[Columns]:
        names = ("doc2", "hash2", "shift", "first", "last")
        for batch in batches:
            out: Columns = {k: [] for k in ("doc", "hash", *names, "before", "after")}
            for doc, own, text, rows in zip(*batch.values(), strict=True):
                words = word_hashes(text)
                for row in rows:
                    before, after = _context(words, row["first"], row["last"])
                    for k, v in (("doc", doc), ("hash", own), ("before", before), ("after", after)):
                        out[k].append(v)
                    for k in names:
                        out[k].append(row[k])
            yield out

    def second_side(batches: Iterator[Columns]) -> Iterator[Columns]:
        for batch in batches:
            out: Columns = {k: [] for k in ("doc", "hash", "start", "end", "other")}
            for doc, own, text, rows in zip(*batch.values(), strict=True):
                words = word_hashes(text)
                for row in rows:
                    at, stop = row["first"] + row["shift"], row["last"] + row["shift"]
                    before, after = _context(words, at, stop)
                    start = row["first"] - _agree(before, row["before"])
                    end = row["last"] + PREFIX + _agree(after, row["after"])
                    if end - start < MIN_WORDS:
                        continue
                    shift = row["shift"]
                    for values in (
                        (row["doc"], row["hash"], start, end, doc),
                        (doc, own, start + shift, end + shift, row["doc"]),
                    ):
                        for k, v in zip(out, values, strict=True):
                            out[k].append(v)
            yield out

    run_type = "doc2 long, hash2 long, shift int, first int, last int, before binary, after binary"
    begun = map_columns(
        _with_text(runs.drop("run"), plain, "doc", "hash"), first_side,
        f"doc long, hash long, {run_type}",
    )
    spans = map_columns(
        _with_text(
            begun.withColumnsRenamed({"doc": "doc1", "hash": "hash1"}), plain, "doc2", "hash2"
        ).withColumn(
            "rows",
            F.transform(
                "rows",
                lambda r: F.struct(
                    r["doc1"].alias("doc"), r["hash1"].alias("hash"), r["shift"].alias("shift"),
                    r["first"].alias("first"), r["last"].alias("last"),
                    r["before"].alias("before"), r["after"].alias("after"),
                ),
            ),
        ),
        second_side,
        "doc long, hash long, start int, end int, other long",
    )
    return _merged(spans)


def _merged(spans: DataFrame) -> DataFrame:
    """Spans that overlap in a text as one."""
    along = Window.partitionBy("doc", "hash").orderBy("start", "end")
    reach = F.max("end").over(along.rowsBetween(Window.unboundedPreceding, -1))
    parted = spans.distinct().withColumn("new", F.coalesce(F.col("start") > reach, F.lit(True)))
    numbered = parted.withColumn("part", F.sum(F.col("new").cast("int")).over(along))
    found = numbered.groupBy("doc", "hash", "part").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min("other").alias("other")
    )

    def as_id(c: str):
        return F.nullif(F.col(c), F.lit(NO_ID))

    return found.select(
        as_id("doc").alias("doc_id"),
        F.col("start").cast("long").alias("start_word"),
        F.col("end").cast("long").alias("end_word"),
        (F.col("end") - F.col("start")).cast("long").alias("n_words"),
        as_id("other").alias("other_doc_id"),
    )
