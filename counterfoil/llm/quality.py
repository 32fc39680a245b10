"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the corpus.

Words and pairs of neighbouring words are hashed into a fixed number of buckets. Two
multinomials over the buckets, one of trusted documents and one of all documents, give
each bucket a log ratio; a document's score is the mean ratio of its n-grams. Ratios are
rounded to whole millionths, so scores do not depend on the order of any sum, and every
document is kept or rejected by the same threshold: a low quantile of the scores that
trusted documents get when their own n-grams are taken out of the target. The target and
the threshold rest on every trusted document, however many there are. In those scores the
logarithms of a bucket's counts and of the target's sum are rounded one by one.

Base counts and buckets are worked out once per document and written below the shared
folder; counts, threshold and scores are taken from there.

Definite results: a null text has no words and fails the base rules; null ids are kept;
repeated rows are judged one by one and count in the corpus as often as they stand
there; without trusted documents the score of every document is zero, which is kept;
an empty table gives no rows. Result columns start with `q_`; where a column of the input
does too, they start with `q__` (and so on), and the input's columns stay as they are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from counterfoil.llm.common import free_prefix, named, written

BUCKETS = 1 << 13
# The share of trusted documents that pass the base rules which may lie below the threshold.
LOST_SHARE = 0.0001
_MICRO = 1_000_000

BLANKS = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    """Whole words, also of very long texts; of a null none."""
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), BLANKS), "")


def _pair_hashes(words: str) -> Column:
    """Hash of each word with its right neighbour, by where it stands; of the last word alone."""
    return F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1)))


def _first(array: str, n: Column) -> Column:
    return F.slice(array, 1, F.greatest(n, F.lit(0)))


def _grams(words: str, pairs: str, buckets: int) -> Column:
    """Buckets of all words and of all pairs of neighbours, two bytes each where they fit."""
    kind = "short" if buckets <= 1 << 15 else "int"

    def bucket(found: Column) -> Column:
        return F.pmod(found, F.lit(buckets)).cast(kind)

    return F.concat(
        F.transform(words, lambda w: bucket(F.xxhash64(w))),
        F.transform(_first(pairs, F.size(words) - 1), bucket),
    )


def _beside_equal(rows: Column, field: str) -> Column:
    """The rows whose field is that of a row next to them."""

    def equal(row: Column, k: Column) -> Column:
        return (row[field] == F.get(rows, k - 1)[field]) | (row[field] == F.get(rows, k + 1)[field])

    return F.filter(rows, equal)


def _prepared(docs: DataFrame, text_col: str, p: str) -> DataFrame:
    """docs with the arrays that the counts are taken from, under names that start with p.

    Windows of three words are told apart by hashes; those that share theirs with another
    are compared as texts (`same`, null where no hash repeats), so counts stay exact.
    """
    lines = F.filter(
        F.split(F.coalesce(named(text_col), F.lit("")), "\n"),
        lambda line: line.rlike(r"[^\x20\x09-\x0D]"),
    )
    prepared = docs.withColumns(
        {
            f"{p}text": F.coalesce(named(text_col).cast("string"), F.lit("")),
            f"{p}lines": lines,
        }
    ).withColumn(f"{p}words", words_of(F.col(f"{p}text")))
    words, pairs, keys, ordered = (p + name for name in ("words", "pairs", "keys", "ordered"))
    prepared = prepared.withColumn(pairs, _pair_hashes(words))
    prepared = prepared.withColumn(
        keys,
        F.transform(
            _first(pairs, F.size(words) - 2), lambda h, i: F.xxhash64(h, F.get(pairs, i + 1))
        ),
    )
    prepared = prepared.withColumn(
        ordered,
        F.when(
            F.size(keys) > F.size(F.array_distinct(keys)),
            F.sort_array(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    shared = _beside_equal(F.col(ordered), "h")

    def window(i: Column) -> Column:
        return F.concat_ws(" ", *(F.get(words, i + d) for d in range(3)))

    return prepared.withColumn(
        f"{p}same",
        F.sort_array(
            F.transform(shared, lambda x: F.struct(window(x["i"]).alias("w"), x["i"].alias("i")))
        ),
    )


def _base_counts(p: str) -> Column:
    words, lines, same = (F.col(p + name) for name in ("words", "lines", "same"))
    # equal windows stand next to each other; each one covers three words
    places = _beside_equal(same, "w")
    covered = F.flatten(
        F.transform(places, lambda x: F.array(*(x["i"] + d for d in range(3)))),
    )
    counts = {
        "n_words": F.size(words).cast("long"),
        "word_chars": F.length(F.array_join(words, "")).cast("long"),
        "n_symbols": F.regexp_count(f"{p}text", F.lit("[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
        "n_repeat_words": F.when(
            same.isNull(), F.lit(0)
        ).otherwise(F.size(F.array_distinct(covered))).cast("long"),
    }
    return F.struct(*(v.alias(k) for k, v in counts.items()))


def only_once(*columns: Column) -> Column:
    """Columns as one struct that is worked out once per row.

    Made by a generator, so that a filter on the result is not pushed below it, where it
    would repeat the work of every array it rests on for each of their elements.
    """
    return F.explode(F.array(F.struct(*columns)))


def base_failed(base: str) -> Column:
    n = F.col(f"{base}.n_words")
    return (n < 50) | (100 * F.col(f"{base}.n_repeat_words") > 50 * n)


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Ids of all documents labelled good, each once."""
    good = labels.where((named("quality") == 1) & named("doc_id").isNotNull())
    return good.select(named("doc_id").cast("long").alias("trusted_id")).distinct()


def measured(
    docs: DataFrame, buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Per row of docs its columns `keep` (default: all), base, buckets, id and row, after a prefix.

    row: a number of its own, counted up from row to row; it is settled once the result is written.
    """
    p = free_prefix(docs, "q_")
    prepared = _prepared(docs, text_col, p).withColumns(
        {f"{p}grams": _grams(f"{p}words", f"{p}pairs", buckets), f"{p}counts": _base_counts(p)}
    )
    own = only_once(
        F.col(f"{p}counts").alias(f"{p}base"),
        F.col(f"{p}grams").alias(f"{p}buckets"),
        named(id_col).cast("long").alias(f"{p}id"),
    )
    columns = docs.columns if keep is None else keep
    found = prepared.withColumn(f"{p}all", own).select(*map(named, columns), f"{p}all.*")
    return found.withColumn(f"{p}row", F.monotonically_increasing_id())


def trusted_marks(rows: DataFrame, trusted: DataFrame, p: str = "q_") -> DataFrame:
    """group, mask: a bit for each trusted row of a written `measured`, 64 neighbours to a group.

    Only ids and row numbers are moved, and what is handed on is some 64 times smaller than ids.
    """
    own = rows.select(F.col(f"{p}id").alias("id"), F.col(f"{p}row").alias("row"))
    own = own.join(trusted, F.col("id") == F.col("trusted_id"), "left_semi")
    bit = F.expr("shiftleft(1L, int(row & 63L))")
    return own.groupBy(F.shiftright("row", 6).alias("group")).agg(F.bit_or(bit).alias("mask"))


def marked(rows: DataFrame, marks: DataFrame, p: str = "q_") -> DataFrame:
    """rows with the flag trusted; whether the marks are broadcast is left to Spark."""
    bit = F.expr(f"shiftright(mask, int({p}row & 63L)) & 1L") == 1
    return rows.join(marks, F.shiftright(f"{p}row", 6) == F.col("group"), "left").select(
        f"{p}base", f"{p}buckets", F.coalesce(bit, F.lit(False)).alias(f"{p}trusted")
    )


def bucket_counts(rows: DataFrame, p: str = "q_") -> DataFrame:
    """Per bucket that occurs in rows of `marked`: bucket, raw and target counts."""
    each = rows.select(F.col(f"{p}trusted").alias("own"), F.explode(f"{p}buckets").alias("bucket"))
    return each.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("raw"), F.count_if("own").alias("target")
    )


class Ratios:
    """The counts of all buckets, and their log ratios in millionths, each count raised by one.

    counts: rows of bucket_counts; one per bucket, a number fixed by `buckets`.
    """

    def __init__(self, counts: DataFrame, buckets: int = BUCKETS) -> None:
        rows = {r["bucket"]: (r["raw"], r["target"]) for r in counts.collect()}
        self.buckets = buckets
        self.raw = [rows.get(b, (0, 0))[0] for b in range(buckets)]
        self.target = [rows.get(b, (0, 0))[1] for b in range(buckets)]
        self.raw_sum, self.target_sum = sum(self.raw) + buckets, sum(self.target) + buckets
        self.known = any(self.target)

    def table(self) -> list[int]:
        if not self.known:
            return [0] * self.buckets
        return [
            round(_MICRO * (math.log((t + 1) / self.target_sum) - math.log((r + 1) / self.raw_sum)))
            for r, t in zip(self.raw, self.target, strict=True)
        ]

    def without_own(self, ordered: str, again: str, ends: str) -> Column:
        """The sum of ratios of a trusted document's buckets, its own counts taken from the target.

        ordered: its sorted buckets, again: of these each equal to the next one, ends: the last
        place there of each run. Buckets that stand once are looked up, and others put right.
        """
        raw = [math.log((r + 1) / self.raw_sum) for r in self.raw]
        # before the sum of what is left of the target, which is taken off at the end
        once = [round(_MICRO * (math.log(t or 1) - r)) for t, r in zip(self.target, raw, strict=True)]
        first, target = _numbers(once, "long"), _numbers(self.target, "long")
        whole = _numbers(raw, "double")

        def more(end: Column, k: Column) -> Column:
            n = end - F.coalesce(F.get(ends, k - 1), F.lit(-1)) + 1
            bucket = F.get(again, end)
            own = F.log(F.get(target, bucket) - n + 1) - F.get(whole, bucket)
            return n * (F.rint(_MICRO * own).cast("long") - F.get(first, bucket))

        zero = F.lit(0).cast("long")
        looked_up = F.aggregate(ordered, zero, lambda s, b: s + F.get(first, b))
        put_right = F.aggregate(F.transform(ends, more), zero, lambda s, found: s + found)
        rest = F.log((F.lit(self.target_sum) - F.size(ordered)).cast("double"))
        return looked_up + put_right - F.size(ordered) * F.rint(_MICRO * rest).cast("long")


def _numbers(values: Sequence[int | float], kind: str) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


def left_out_means(rows: DataFrame, ratios: Ratios, p: str = "q_") -> DataFrame:
    """mean: the leave-one-out score of each trusted row of `marked` that passes the base rules."""
    own = rows.where(F.col(f"{p}trusted") & ~base_failed(f"{p}base"))
    # compact: of arrays that cannot hold nulls the numbers are sorted as such
    ordered = own.select(F.sort_array(F.array_compact(f"{p}buckets")).alias("ordered"))
    again = ordered.withColumn(
        "again", F.filter("ordered", lambda b, k: b == F.get("ordered", k + 1))
    )
    runs = again.withColumn(
        "ends",
        F.array_compact(
            F.transform(
                "again", lambda b, k: F.when(~b.eqNullSafe(F.get("again", k + 1)), k)
            )
        ),
    )
    sums = only_once(
        ratios.without_own("ordered", "again", "ends").alias("total"),
        F.size("ordered").alias("grams"),
    )
    return runs.select(sums.alias("own")).select(
        F.expr("(own.total - pmod(own.total, own.grams)) div own.grams").alias("mean")
    )


def quantile(values: DataFrame, share: float) -> int | None:
    """The least whole number in the only column that at least this share of its rows does not exceed.

    Exact: counts by steps of 8,192 tell in which step it lies, counts of the values in that
    step which it is. For mean ratios both counts have some 10,000 rows at most.
    """
    column = F.col(values.columns[0])
    place, value = None, None
    for step in (F.shiftright(column, 13), column):
        counts = sorted(map(tuple, values.groupBy(step.alias("step")).count().collect()))
        if place is None:
            place = max(1, math.ceil(share * sum(n for _, n in counts)))
        for value, n in counts:
            if place <= n:
                break
            place -= n
        values = values.where(step == value)
    return value


def judged(
    docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS, lost_share: float = LOST_SHARE,
    id_col: str = "doc_id", text_col: str = "text", keep: Sequence[str] | None = None,
) -> DataFrame:
    """docs with q_base, q_ratio (sum in millionths), q_grams, q_failed and q_kept.

    trusted: all trusted ids, in column trusted_id. keep: the columns of docs that the result
    holds, all by default. Reads docs once and writes tables of its own.
    """
    p = free_prefix(docs, "q_")
    rows = written(measured(docs, buckets, id_col, text_col, keep), "quality")
    known = marked(rows, written(trusted_marks(rows, trusted, p), "quality-trusted"), p)
    ratios = Ratios(bucket_counts(known, p), buckets)
    threshold = 0
    if ratios.known:
        least = quantile(written(left_out_means(known, ratios, p), "quality-means"), lost_share)
        threshold = -_MICRO if least is None else least
    table = _numbers(ratios.table(), "long")
    ratio = F.aggregate(f"{p}buckets", F.lit(0).cast("long"), lambda s, b: s + F.get(table, b))
    grams = F.size(f"{p}buckets").cast("long")
    found = rows.select(
        *map(named, docs.columns if keep is None else keep),
        only_once(
            F.col(f"{p}base"), ratio.alias(f"{p}ratio"), grams.alias(f"{p}grams")
        ).alias(f"{p}all"),
    )
    found = found.select(*map(named, found.columns[:-1]), f"{p}all.*")
    enough = F.col(f"{p}ratio") >= F.lit(threshold).cast("long") * F.col(f"{p}grams")
    return found.withColumn(f"{p}failed", base_failed(f"{p}base")).withColumn(
        f"{p}kept", ~F.col(f"{p}failed") & enough
    )


def passed(
    docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows that are kept, all columns as they came."""
    found = judged(docs, trusted, id_col=id_col, text_col=text_col)
    return found.where(f"{free_prefix(docs, 'q_')}kept").select(*map(named, docs.columns))
