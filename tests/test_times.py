"""ISO texts against the parser of the Python standard library."""

import re
from datetime import datetime, timezone

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from counterfoil.functions.times import is_iso, iso_instant
from counterfoil.operators.ingest import drift_timestamp
from counterfoil.operators.staging import stg_server_logs
from counterfoil.sources import CLIENT

TEXTS = [
    "2026-01-01", "2026-01-01T10", "2026-01-01T10:00", "2026-01-01x10:00:00",
    "2026-01-01T10:00:00+02", "2026-01-01T10:00:00+0200", "2026-01-01T10:00:00+02:00:30",
    "2026-01-01T10:00:00.1", "2026-01-01T10:00:00.1234567890", "2026-01-01T10:00:00,123",
    "2026-01-01T10:00Z", "2026-01-01T10Z", "2026-01-01T1000", "20260101", "20260101T100000",
    "20260101T100000.5-0130", "2026-W01-1", "2026-W01", "2026W017T10", "2020-W53-7", "2026-W53-7",
    "2021-W53", "2026-W54-1", "2026-W00-1", "2026-W01-8", "2026-W01-0", "2026-01-01T24:30:00",
    "2026-01-01T10:00:00z", "2026-01-01T10:00:00+25:00", "2026-01-01T10:00:00-23:59",
    "2026-02-29", "2024-02-29", "0000-01-01", "9999-12-31T23:59:59.999999", "2026-01-01T10:60",
    "2026-01-01T10:00:60", "2026-1-1", "2026-01-01T", "2026-01-01T10:00:00.", "2026-01", "2026",
    "now", " 2026-01-01", "2026-01-01 ", "2026-01-01T10:00:00+18:30", "2026-001", "2026-13-01",
    "2026-01-01T10:00:00+02:0", "2026-01-01Z", "2026-01-01T10:00:00+02:00:30.123456",
    "2026-01-01T10:00:0", "1969-12-31T23:59:59.5", "2026-0101", "202601-01", "2026-01-01T10:0000",
    "", "Z", "epoch", "2026-06-30T12:00:00+05:30",
]


# Valid, but reported as bad: dates by week or with a bare Z, offsets of more than 18
# hours or with seconds.
REPORTED = re.compile(r"W|^.{10}Z$|[+-]\d\d:\d\d:\d\d|[+-](18:30|2\d:\d\d)$")


def standard(text):
    if REPORTED.search(text):
        return None
    try:
        parsed = datetime.fromisoformat(text.replace("Z", "+00:00"))
    except ValueError:
        return None
    parsed = parsed if parsed.tzinfo else parsed.replace(tzinfo=timezone.utc)
    try:
        return parsed.astimezone(timezone.utc).replace(tzinfo=None)
    except OverflowError:
        return None


def read(spark, texts):
    table = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = table.select(
        "t", is_iso(F.col("t")).alias("iso"), iso_instant(F.col("t")).cast("string").alias("at")
    ).collect()
    return {r.t: r.at if r.iso else None for r in rows}


def as_text(moment):
    if moment is None:
        return None
    whole = moment.strftime("%Y-%m-%d %H:%M:%S").rjust(19, "0")
    fraction = f"{moment.microsecond:06d}".rstrip("0")
    return f"{whole}.{fraction}" if fraction else whole


def test_texts_read_as_the_standard_library_does(spark):
    assert read(spark, TEXTS) == {t: as_text(standard(t)) for t in TEXTS}


def test_flagged_texts_are_those_it_rejects(spark):
    table = spark.createDataFrame([(t, t) for t in TEXTS if t], "event_id string, timestamp string")
    flagged = {r.rec_id for r in drift_timestamp(table, CLIENT).collect()}
    assert flagged == {t for t in TEXTS if t and standard(t) is None}


def test_staging_reads_what_is_not_flagged(spark):
    table = spark.createDataFrame(
        [(t, t, "u", "completed", 1.0, None) for t in TEXTS],
        "tx_id string, timestamp string, user_id string, status string, amount double, ext_id string",
    ).withColumn("_extracted_at", F.current_timestamp())
    staged = stg_server_logs(table).select("transaction_id", F.col("transaction_at").cast("string"))
    rows = {r[0]: r[1] for r in staged.collect()}
    readable = {t: as_text(standard(t)) for t in TEXTS if standard(t)}
    assert {t: rows[t] for t in readable} == readable


FLAGGED = ("T12:30", "12:30", "2026", "2026-1-5", " 2026-01-05 ", "2026-01-05T10:00:00 America/New_York")


def test_staging_reads_nothing_that_is_flagged(spark):
    texts = [t for t in [*TEXTS, *FLAGGED] if t and standard(t) is None]
    table = spark.createDataFrame(
        [(t, t, "u", "completed", 1.0, None) for t in texts],
        "tx_id string, timestamp string, user_id string, status string, amount double, ext_id string",
    ).withColumn("_extracted_at", F.current_timestamp())
    assert set(FLAGGED) <= set(texts)
    assert stg_server_logs(table).where("transaction_at IS NOT NULL").isEmpty()


moments = st.datetimes(min_value=datetime(1, 1, 2), max_value=datetime(9999, 12, 30))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(moments, min_size=30, max_size=60))
def test_any_moment(spark, times):
    texts = []
    for i, moment in enumerate(times):
        at = moment.time()
        clock = (f"{at:%H:%M}", f"{at:%H%M%S}", at.isoformat(), f"{at:%H}")
        dates = (
            moment.date().isoformat(),
            moment.date().isoformat().replace("-", ""),
        )
        offset = ("", "Z", "+05:30", "-0930", "+17")[i % 5]
        texts.append(f"{dates[i % 2]}{'T x'[i % 3]}{clock[(i // 2) % 4]}{offset}")
    assert read(spark, texts) == {t: as_text(standard(t)) for t in texts}
