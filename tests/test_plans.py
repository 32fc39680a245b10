"""Whole runs over files, and the command line."""

import json

from pyspark.sql import functions as F

from counterfoil import __main__ as command
from counterfoil.plans import derive_models, extract_feeds, report_findings
from counterfoil.sources import CLIENT, SERVER, read_clean
from counterfoil.sources.sinks import published, save_models, save_version
from tests.test_ingest import CLIENT_RECORDS, SERVER_RECORDS, as_array


def lines(path):
    return [json.loads(line) for f in path.glob("part-*") for line in f.read_text().splitlines()]


def test_extract_models_audit(spark, tmp_path):
    client = as_array(tmp_path / "client.json", CLIENT_RECORDS)
    server = as_array(tmp_path / "server.json", SERVER_RECORDS)
    out = tmp_path / "out"

    counts = [tuple(r) for r in extract_feeds(spark, client, server, str(out)).collect()]
    assert counts == [("client_events", 5, 1, 6, 4), ("server_logs", 4, 1, 2, 3)]
    written = {r["event_id"]: r for r in lines(out / "client_events_clean")}
    assert written["e3"]["user_id"] == 7 and written[None]["properties"] == {}
    assert list(written["e1"]) == [
        "event_id",
        "timestamp",
        "user_id",
        "event_name",
        "properties",
        "_source",
        "_extracted_at",
    ]
    links = {r["tx_id"]: r["ext_id"] for r in lines(out / "server_logs_clean")}
    assert links == {"t1": "e1", "t2": None, "t3": "  "}
    found = lines(out / "schema_drift")
    assert len(found) == 8 and {"idx:4"} < {r["rec_id"] for r in found}

    rows, snapshot = derive_models(spark, str(out), str(out))
    assert [tuple(r) for r in rows.collect()] == [
        ("stg_client_events", 4),
        ("stg_server_logs", 3),
        ("int_user_journey", 4),
        ("mart_reconciliation", 3),
        ("mart_revenue_summary", 1),
    ]
    assert {r.attribution_category: r.transactions for r in snapshot.collect()} == {
        "finance_only": 1,
        "neither": 2,
    }
    mart = {r["transaction_id"]: r for r in lines(out / "mart_reconciliation")}
    assert mart["t1"]["transaction_at"] == "2026-01-01T10:00:30.000000Z"
    assert mart["t1"]["client_reported_amount"] is None
    assert spark.table("mart_reconciliation").count() == 3

    report = report_findings(spark, str(out), str(out / "mart_reconciliation"), str(out)).collect()
    assert [(r.anomaly_id, r.category, r.verdict) for r in report] == [
        ("A001", "DARK_REVENUE", "confirmed"),
        ("A002", "TRACKING_GAP", "confirmed"),
        ("A003", "REVENUE_VARIANCE", "confirmed"),
    ]
    again = report_findings(
        spark,
        str(out),
        str(out / "mart_reconciliation"),
        str(tmp_path / "second"),
        history=str(out / "findings"),
    )
    assert again.isEmpty()


def test_models_as_tables(spark, tmp_path):
    out = str(tmp_path / "out")
    extract_feeds(
        spark,
        as_array(tmp_path / "client.json", CLIENT_RECORDS),
        as_array(tmp_path / "server.json", SERVER_RECORDS),
        out,
    )
    rows, _ = derive_models(spark, out, out, db="recon_test")
    assert rows.count() == 5
    assert spark.table("recon_test.int_user_journey").count() == 4


def test_readers_see_one_whole_version(spark):
    """Before, during and after a run; the version before the last stays for those at work."""
    db = "versions_test"

    def models(n):
        return {name: spark.range(n).withColumn("n", F.lit(n)) for name in ("first", "second")}

    def seen():
        return [(spark.table(f"{db}.{m}").count(), spark.table(f"{db}.{m}").agg(F.max("n")).first()[0])
                for m in ("first", "second")]

    assert published(spark, db) == 0
    save_models(models(3), db)
    assert seen() == [(3, 3), (3, 3)] and published(spark, db) == 1
    open_ = spark.table(f"{db}.first")
    for name, df in models(5).items():
        save_version(df, db, name, 2)
        assert seen() == [(3, 3), (3, 3)]
    # a run that failed half-way is replaced by the next one
    save_models(models(7), db)
    assert seen() == [(7, 7), (7, 7)] and published(spark, db) == 2
    assert open_.count() in (3, 7)
    save_models(models(9), db)
    assert seen() == [(9, 9), (9, 9)]
    kept = [r[0] for r in spark.sql(f"SHOW PARTITIONS {db}.first_versions").collect()]
    assert sorted(kept) == ["version=2", "version=3"]
    plan = spark.table(f"{db}.first")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(version" in plan


def test_command_line(spark, tmp_path, capsys):
    out = str(tmp_path / "out")
    client = as_array(tmp_path / "client.json", CLIENT_RECORDS)
    server = as_array(tmp_path / "server.json", SERVER_RECORDS)
    command.main(["extract", "--client", client, "--server", server, "--out", out])
    command.main(["models", "--clean", out, "--out", out])
    command.main(["audit", "--clean", out, "--mart", f"{out}/mart_reconciliation", "--out", out])
    assert "DARK_REVENUE" in capsys.readouterr().out


def test_empty_feeds(spark, tmp_path):
    client = as_array(tmp_path / "client.json", [])
    server = as_array(tmp_path / "server.json", [])
    out = str(tmp_path / "out")
    counts = [tuple(r) for r in extract_feeds(spark, client, server, out).collect()]
    assert counts == [("client_events", 0, 0, 0, 0), ("server_logs", 0, 0, 0, 0)]
    assert read_clean(spark, f"{out}/client_events_clean", CLIENT).count() == 0
    assert read_clean(spark, f"{out}/server_logs_clean", SERVER).count() == 0
    rows, _ = derive_models(spark, out, out)
    assert {r.row_count for r in rows.collect()} == {0}
