"""Input that is no record, and amounts that no sum can hold."""

import json

import pytest
from pyspark.sql import functions as F

from counterfoil.operators.audit import audit_findings, verify
from counterfoil.operators.ingest import drift, normalize_server, unreadable
from counterfoil.operators.marts import attribution_snapshot, reconcile
from counterfoil.operators.staging import stg_client_events, stg_server_logs
from counterfoil.plans import extract_feeds
from counterfoil.sources import CLIENT, SERVER, land_records, read_records, readable
from tests.test_ingest import CLIENT_RECORDS, SERVER_RECORDS, as_array, as_lines
from tests.test_plans import lines


def test_cut_array(spark, tmp_path):
    whole = json.dumps([{"event_id": str(i)} for i in range(50)])
    path = tmp_path / "cut.json"
    path.write_text(whole[:-40])
    landed = land_records(spark, str(path), CLIENT)
    assert readable(landed).count() == 0
    assert [r.unreadable for r in landed.collect()] == [whole[:-40]]
    with pytest.raises(Exception, match="(?i)malformed"):
        land_records(spark, str(path), CLIENT, strict=True)


def test_bad_lines_are_listed_and_counted_apart(spark, tmp_path):
    good = [json.dumps(r) for r in CLIENT_RECORDS]
    client = tmp_path / "client.json"
    client.write_text("\n".join([good[0], '{"event_id": "x', *good[1:], "no json"]) + "\n")
    server = as_lines(tmp_path / "server.json", SERVER_RECORDS)
    out = tmp_path / "out"
    counts = extract_feeds(spark, str(client), server, str(out), lines=True).collect()
    assert tuple(counts[0])[1:3] == (len(good), 1)
    listed = [r for r in lines(out / "schema_drift") if r["kind"] == "UNREADABLE_RECORD"]
    assert {(r["rec_id"], r["value"]) for r in listed} == {
        ("idx:2", '{"event_id": "x'),
        (f"idx:{len(good) + 2}", "no json"),
    }
    assert lines(out / "unreadable_records") == [
        {"source": "client_events", "unreadable_records": 2}
    ]
    with pytest.raises(Exception, match="(?i)malformed"):
        extract_feeds(spark, str(client), server, str(out), lines=True, strict=True)


def test_places_hold_when_splits_change(spark, tmp_path):
    """Files are split anew between two steps; the places of bad lines stay the same."""
    texts = ["broken" if i % 100 == 0 else json.dumps({"event_id": str(i)}) for i in range(1, 2001)]
    path = tmp_path / "big.json"
    path.write_text("\n".join(texts) + "\n")
    landed = land_records(spark, str(path), CLIENT, lines=True)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = {r.rec_id for r in unreadable(landed, CLIENT).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == {f"idx:{i}" for i in range(100, 2001, 100)}


def test_absurd_amount(spark, tmp_path):
    records = [SERVER_RECORDS[0], {**SERVER_RECORDS[0], "tx_id": "big", "amount": 1e300}]
    raw = read_records(spark, as_array(tmp_path / "s.json", records), SERVER)
    found = [(r.rec_id, r.kind, r.field) for r in drift(raw, SERVER).collect()]
    assert found == [("big", "AMOUNT_OUT_OF_RANGE", "amount")]
    clean = normalize_server(raw)
    server = stg_server_logs(clean)
    assert {r.transaction_id: r.transaction_amount for r in server.collect()} == {
        "t1": SERVER_RECORDS[0]["amount"],
        "big": 0.0,
    }
    events = [{**CLIENT_RECORDS[0], "event_name": "purchase_intent", "properties": {"value": 1e300}}]
    raw = read_records(spark, as_array(tmp_path / "c.json", events), CLIENT)
    assert "AMOUNT_OUT_OF_RANGE" in {r.kind for r in drift(raw, CLIENT).collect()}
    client = stg_client_events(raw.withColumn("_extracted_at", F.current_timestamp()))
    assert client.first().event_value == 0.0
    assert attribution_snapshot(reconcile(server, client)).count() > 0
    with pytest.raises(Exception, match="out of range"):
        stg_server_logs(clean, strict=True).collect()


def test_gap_that_comes_from_spelling(spark, tmp_path):
    events = [{**CLIENT_RECORDS[0], "event_name": "Session_Start"}]
    raw = read_records(spark, as_array(tmp_path / "c.json", events), CLIENT)
    clean = raw.withColumn("_extracted_at", F.current_timestamp())
    client = stg_client_events(clean)
    server = stg_server_logs(
        normalize_server(read_records(spark, as_array(tmp_path / "s.json", SERVER_RECORDS), SERVER))
    )
    findings = audit_findings(reconcile(server, client), clean)
    gap = verify(findings, client, server).where("rule_id = 'R-GAP'").first()
    assert not gap.verified and gap.verdict == "modeling_artifact"
