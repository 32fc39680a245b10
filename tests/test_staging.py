import json

import pytest

from counterfoil.operators.staging import stg_client_events, stg_server_logs
from counterfoil.sources import CLIENT, SERVER, read_clean
from tests.helpers import by


def clean(spark, tmp_path, feed, records):
    path = tmp_path / f"{feed.name}.json"
    path.write_text("".join(json.dumps(r) + "\n" for r in records))
    return read_clean(spark, str(path), feed)


CLIENT_CLEAN = [
    {
        "event_id": "e1",
        "timestamp": "2026-01-01T10:00:00Z",
        "user_id": "u1",
        "event_name": "Purchase_Intent",
        "properties": {"value": "10.5", "product_id": 7, "url": "/a", "extra": {"x": None}},
    },
    {"event_id": 2, "timestamp": "2026-01-01T10:00:00", "user_id": None, "properties": {}},
    {"event_id": "e3", "timestamp": "2026-01-01T12:00:00+02:00", "properties": {"value": None}},
]


def test_client_columns(spark, tmp_path):
    staged = stg_client_events(clean(spark, tmp_path, CLIENT, CLIENT_CLEAN))
    assert staged.columns == [
        "event_id",
        "user_id",
        "event_at",
        "event_name",
        "event_value",
        "product_id",
        "page_url",
        "traffic_source",
        "properties_raw",
        "_source",
        "_extracted_at",
        "is_conversion_client",
    ]
    rows = by(staged, "event_id")
    first = rows["e1"]
    assert (first.event_name, first.event_value, first.product_id) == ("purchase_intent", 10.5, "7")
    assert (first.page_url, first.traffic_source, first.is_conversion_client) == ("/a", "", True)
    assert json.loads(first.properties_raw) == CLIENT_CLEAN[0]["properties"]
    assert rows["2"].event_at == first.event_at == rows["e3"].event_at
    assert rows["2"].event_value == 0.0 and rows["2"].is_conversion_client is False
    assert rows["e3"].event_value == 0.0


SERVER_CLEAN = [
    {"tx_id": "t1", "status": "Completed", "amount": 10, "ext_id": " e1 "},
    {"tx_id": "t2", "status": None, "amount": None, "ext_id": "   "},
    {"tx_id": "t3", "status": "disputed", "amount": "12.5", "ext_id": None},
    {"tx_id": "t4", "status": "refunded", "amount": True, "ext_id": "\t"},
]


def test_server_columns(spark, tmp_path):
    rows = by(stg_server_logs(clean(spark, tmp_path, SERVER, SERVER_CLEAN)), "transaction_id")
    assert rows["t1"].client_event_id == " e1 " and rows["t1"].is_revenue_recognized is True
    assert rows["t2"].client_event_id is None and rows["t2"].transaction_amount == 0.0
    flags = ("is_completed", "is_failed", "is_refunded", "is_revenue_recognized")
    assert all(rows["t2"][f] is None for f in flags)
    assert all(rows["t3"][f] is False for f in flags) and rows["t3"].transaction_amount == 12.5
    assert rows["t4"].client_event_id == "\t" and rows["t4"].transaction_amount == 1.0


def test_unreadable_values(spark, tmp_path):
    bad = [{"event_id": "e1", "timestamp": "not-a-date", "properties": {"value": "much"}}]
    table = clean(spark, tmp_path, CLIENT, bad)
    row = stg_client_events(table).first()
    assert row.event_at is None and row.event_value == 0.0
    with pytest.raises(Exception):
        stg_client_events(table, strict=True).collect()


def test_bag_as_text_or_struct(spark):
    columns = "_extracted_at, event_id, user_id, event_name, timestamp, properties"
    as_text = spark.sql(
        "SELECT now() _extracted_at, 'e' event_id, 'u' user_id, 'search' event_name, "
        "timestamp'2026-01-01 00:00:00' timestamp, '{\"value\": 3}' properties"
    )
    as_struct = spark.sql(
        "SELECT now() _extracted_at, 'e' event_id, 'u' user_id, 'search' event_name, "
        "timestamp'2026-01-01 00:00:00' timestamp, "
        "named_struct('value', 3, 'url', CAST(NULL AS STRING)) properties"
    )
    assert columns
    assert stg_client_events(as_text).first().event_value == 3.0
    row = stg_client_events(as_struct).first()
    assert row.event_value == 3.0 and row.page_url == ""
    assert json.loads(row.properties_raw) == {"value": 3, "url": None}
