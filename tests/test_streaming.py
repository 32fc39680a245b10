"""Streams over several files give what batch gives."""

import json
import os
import re
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from counterfoil import streaming
from counterfoil.operators.ingest import dedup
from counterfoil.operators.journey import user_journey
from counterfoil.sources import CLIENT, read_records
from counterfoil.streaming.dedup import fold_batch

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return registry.Tables(spark, FOLDER)


def in_order(folder, parts):
    """Give the files of a stream rising modification times."""
    for i, path in enumerate(sorted(parts)):
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


def test_repeats_in_later_files(spark, tmp_path):
    def record(name, minute):
        return {
            "event_id": name,
            "timestamp": f"2026-01-01T10:{minute:02d}:00Z",
            "user_id": "u1",
            "event_name": "page_view",
            "properties": {},
        }

    folder = tmp_path / "feed"
    folder.mkdir()
    batches = [
        [record("a", 0), record("b", 1), record("b again", 1)],
        [record("a again", 0), record("c", 2)],
        [record("c again", 2), {"event_id": "no key"}, {"event_id": "no key either"}],
    ]
    for i, batch in enumerate(batches):
        (folder / f"{i}.json").write_text("".join(json.dumps(r) + "\n" for r in batch))
    feed = in_order(folder, folder.glob("*.json"))

    records = streaming.stream_records(spark, feed, CLIENT, files_per_trigger=1)
    kept = streaming.drain(streaming.stream_dedup(records, CLIENT.key), "test-dedup")
    keys = [F.to_json(c).alias(c) for c in CLIENT.key]
    batch = dedup(read_records(spark, feed, CLIENT, lines=True), CLIENT.key).select(*keys)
    ours = kept.select(*keys)
    assert ours.count() == batch.count() == 4
    assert ours.exceptAll(batch).isEmpty()


def test_upsert_keeps_what_batch_keeps_in_any_order_of_arrival(spark, tmp_path):
    """A file that sorts before all others comes last, after a restart."""
    folder, table = tmp_path / "feed", str(tmp_path / "kept")
    folder.mkdir()

    def write(name, rows):
        lines = [r if isinstance(r, str) else json.dumps(
            {"event_id": f"{name}{k}", "timestamp": r[0], "user_id": r[1], "event_name": "x",
             "properties": {"from": name}}) for k, r in enumerate(rows)]
        (folder / f"{name}.json").write_text("".join(line + "\n" for line in lines))
        moment = 1_700_000_000 + len(list(folder.iterdir()))
        os.utime(folder / f"{name}.json", (moment, moment))

    def batch():
        records = read_records(spark, str(folder), CLIENT, lines=True)
        return dedup(records, CLIENT.key).select(*CLIENT.types)

    def same(ours):
        texts = [F.to_json(c).alias(c) for c in CLIENT.types]
        a, b = ours.select(*texts), batch().select(*texts)
        return a.count() == b.count() and a.exceptAll(b).isEmpty()

    write("c", [("t1", "u"), ("t2", "u"), ("t2", "u"), "{broken"])
    write("d", [("t1", "u"), ("t3", None)])
    first = streaming.upsert_records(spark, str(folder), CLIENT, table, 1)
    assert same(first.kept) and first.late.isEmpty()
    assert [r.unreadable for r in first.unreadable.collect()] == ["{broken"]

    write("a", [("t3", None), ("t9", "v"), ("t3", None)])
    write("b", [("t1", "u"), ("t3", None)])
    second = streaming.upsert_records(spark, str(folder), CLIENT, table, 1)
    assert same(second.kept)
    replaced = {r.event_id.toPython(): r.replaced.file[-6:] for r in second.late.collect()}
    assert replaced == {"b0": "c.json", "a0": "d.json"}

    # a batch that is done again replaces what it wrote
    number, late = second.late.agg(F.max("batch"), F.count("*")).first()
    again = spark.read.parquet(f"{table}-incoming")
    held = str(tmp_path / "held")
    again.select("*", "pos.file", "pos.block").drop("pos").write.parquet(held)
    fold_batch(spark.read.parquet(held), number, table, CLIENT)
    third = streaming.upsert_records(spark, str(folder), CLIENT, table, 1)
    assert same(third.kept) and third.late.count() == late


def test_journey_over_files(spark, tmp_path, tables):
    """Files in time order: candidates are complete, and events without any appear in time."""

    def as_stream(df, name, time_col):
        path = str(tmp_path / name)
        df.repartitionByRange(6, time_col).sortWithinPartitions(time_col).write.parquet(path)
        in_order(path, (tmp_path / name).glob("part-*.parquet"))
        reader = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1)
        return reader.parquet(path)

    candidates = streaming.drain(
        streaming.stream_journey(
            as_stream(tables.client, "client", "event_at"),
            as_stream(tables.server, "server", "transaction_at"),
            delay="6 days",
        ),
        "test-journey",
    )
    batch = user_journey(tables.client, tables.server)
    ours = streaming.best_candidates(candidates)
    matched = ours.where("transaction_id IS NOT NULL")
    expected = batch.where("transaction_id IS NOT NULL")
    assert matched.count() == expected.count() > 0
    assert matched.exceptAll(expected).isEmpty()
    unmatched = ours.where("transaction_id IS NULL")
    assert unmatched.count() > 500
    assert unmatched.exceptAll(batch).isEmpty()
    assert ours.groupBy("event_id").count().where("count > 1").isEmpty()
    # with the staged events, one of them without a time, nothing is missing
    some = tables.client.limit(1).select(
        *[F.lit(None).cast("timestamp").alias(c) if c == "event_at" else F.concat(c, F.lit("-x")).alias(c) if c == "event_id" else F.col(c) for c in tables.client.columns]
    )
    staged = tables.client.unionByName(some)
    whole = streaming.best_candidates(candidates, staged)
    expected = user_journey(staged, tables.server)
    assert whole.count() == expected.count() and whole.exceptAll(expected).isEmpty()


def test_landing_goes_on_and_spans_join_up(spark, tmp_path, tables):
    """Files that come after the first run are added; spans give what one batch gives."""
    border = datetime(2024, 1, 15, 12, 30, tzinfo=UTC)

    def landed(df, name, time_col):
        source, table = str(tmp_path / name), str(tmp_path / f"{name}-landed")
        df.where(F.col(time_col) < F.lit(border)).write.parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        first = streaming.land(stream, time_col, table).count()
        df.where(F.col(time_col) >= F.lit(border)).write.mode("append").parquet(source)
        stream = spark.readStream.schema(df.schema).parquet(source)
        result = streaming.land(stream, time_col, table)
        assert 0 < first < result.count() == df.count()
        return result

    client = landed(tables.client, "client", "event_at")
    server = landed(tables.server, "server", "transaction_at")
    batch = user_journey(tables.client, tables.server)
    ends = [datetime(2024, 1, d, tzinfo=UTC) for d in (1, 22, 31)]
    ends = [ends[0], border, ends[1], ends[2]]
    spans = [
        streaming.journey_between(client, server, a, b) for a, b in zip(ends, ends[1:])
    ]
    ours = spans[0].unionByName(spans[1]).unionByName(spans[2])
    assert ours.count() == batch.count()
    assert ours.exceptAll(batch).isEmpty()
    plan = spans[1]._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[(.*?)\]", plan)
    assert filters and all("hour" in f for f in filters)


def test_late_rows_are_matched_again_and_counted(spark, tmp_path, tables):
    """Files out of order give what one batch gives; only hours that changed are matched again."""
    n = F.pmod(F.xxhash64("user_id"), F.lit(50))
    day = F.to_date("at").cast("string")
    pieces = [day >= "2024-01-10", (day < "2024-01-10") & (n != 0), (day < "2024-01-10") & (n == 0)]
    path = str(tmp_path / "matched")
    seen = []
    for piece in pieces:
        landed = []
        for name, df, time_col in (("client", tables.client, "event_at"), ("server", tables.server, "transaction_at")):
            folder = str(tmp_path / name)
            df.withColumn("at", F.col(time_col)).where(piece).drop("at").write.mode("append").parquet(folder)
            stream = spark.readStream.schema(df.schema).parquet(folder)
            landed.append(streaming.land(stream, time_col, f"{folder}-landed"))
        found = streaming.match_landed(*landed, path)
        whole = user_journey(*(t.select(*df.columns) for t, df in zip(landed, (tables.client, tables.server))))
        assert found.count() == whole.count() and found.exceptAll(whole).isEmpty()
        seen.append(spark.read.parquet(f"{path}/hours").count())
    assert found.count() == tables.client.count()
    hours = landed[0].select("hour").distinct().count()
    assert seen[0] < seen[1] and seen[2] < seen[1] + hours
    for table, df, time_col in zip(landed, (tables.client, tables.server), ("event_at", "transaction_at")):
        late = {r.batch: r.late_rows for r in streaming.late_rows(table).collect()}
        assert sum(late.values()) == df.where(F.to_date(time_col) < F.lit("2024-01-10")).count()
        assert table.count() == df.count()
    last = [df.agg(F.date_format(F.max(c), "yyyy-MM-dd-HH")).first()[0]
            for df, c in ((tables.client, "event_at"), (tables.server, "transaction_at"))]
    assert streaming.frontier(*landed) == min(last)


def test_nothing_has_landed(spark, tmp_path, tables):
    landed = []
    for name, df, time_col in (("c", tables.client, "event_at"), ("s", tables.server, "transaction_at")):
        df.where("false").write.parquet(str(tmp_path / name))
        stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / name))
        landed.append(streaming.land(stream, time_col, str(tmp_path / f"{name}-landed")))
    assert streaming.frontier(*landed) is None
    assert streaming.late_rows(landed[0]).isEmpty()
    assert streaming.match_landed(*landed, str(tmp_path / "matched")).isEmpty()
