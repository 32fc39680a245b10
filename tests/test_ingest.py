"""Raw JSON records with hand-worked expectations."""

import json
from dataclasses import replace

import pytest

from counterfoil.operators.ingest import (
    dedup,
    drift,
    drift_enum,
    drift_timestamp,
    extraction_stats,
    normalize_client,
    normalize_server,
)
from counterfoil.sources import CLIENT, SERVER, number_records, read_records

CLIENT_RECORDS = [
    {
        "event_id": "e1",
        "timestamp": "2026-01-01T10:00:00Z",
        "user_id": "u1",
        "event_name": "page_view",
        "properties": {"url": "/a"},
    },
    {
        "event_id": "e2",
        "timestamp": "2026-01-01T10:00:00Z",
        "user_id": "u1",
        "event_name": "page_view",
        "properties": 5,
    },
    {
        "event_id": "e3",
        "timestamp": "not-a-date",
        "user_id": 7,
        "event_name": "Purchase_Intent",
        "properties": {"value": 10.5},
    },
    {"event_id": None, "timestamp": None, "user_id": "u2", "properties": []},
    {
        "event_id": "e5",
        "timestamp": "",
        "user_id": "u3",
        "event_name": "signup",
        "properties": {},
    },
]

SERVER_RECORDS = [
    {
        "tx_id": "t1",
        "timestamp": "2026-01-01T10:00:30+00:00",
        "user_id": "u1",
        "status": "completed",
        "amount": 10.5,
        "meta": {"ext_id": "e1"},
    },
    {
        "tx_id": "t1",
        "timestamp": "2026-01-01T10:00:30+00:00",
        "user_id": "u1",
        "status": "completed",
        "amount": 99,
        "meta": {"ext_id": "e1"},
    },
    {
        "tx_id": "t2",
        "timestamp": "2026-01-01",
        "user_id": "u2",
        "status": "Disputed",
        "amount": "12",
        "meta": None,
    },
    {
        "tx_id": "t3",
        "timestamp": "2026-01-01T11:00:00Z",
        "user_id": "u3",
        "status": "failed",
        "amount": True,
        "meta": {"ext_id": "  "},
    },
]


def as_array(path, records):
    path.write_text(json.dumps(records, indent=2))
    return str(path)


def as_lines(path, records):
    path.write_text("".join(json.dumps(r) + "\n" for r in records))
    return str(path)


@pytest.fixture(params=["array", "lines"])
def read(request, spark, tmp_path):
    def go(feed, records):
        writer = as_array if request.param == "array" else as_lines
        path = writer(tmp_path / f"{feed.name}.json", records)
        return read_records(spark, path, feed, lines=request.param == "lines")

    return go


def found(df):
    return sorted((r.rec_id, r.kind, r.field, r.expected, r.actual) for r in df.collect())


ENUM = "['add_to_cart', 'checkout', 'page_view', 'purchase', 'purchase_intent', 'search', 'session_start']"


def test_client_violations(read):
    records = read(CLIENT, CLIENT_RECORDS)
    result = drift(dedup(records, CLIENT.key), CLIENT, records)
    assert found(result) == sorted(
        [
            ("e3", "TYPE_MISMATCH", "user_id", "str", "int"),
            ("e3", "UNKNOWN_ENUM", "event_name", ENUM, "str"),
            ("e3", "BAD_TIMESTAMP", "timestamp", "ISO 8601", "str"),
            ("idx:4", "MISSING_FIELD", "event_name", "str", None),
            ("idx:4", "TYPE_MISMATCH", "properties", "dict", "list"),
            ("e5", "UNKNOWN_ENUM", "event_name", ENUM, "str"),
        ],
        key=lambda v: tuple(v[:3]),
    )
    messages = {r.message for r in result.collect()}
    assert "TYPE_MISMATCH field=user_id expected=str actual=int record=e3" in messages
    assert "MISSING_FIELD field=event_name record=idx:4" in messages
    assert "BAD_TIMESTAMP value='not-a-date' record=e3" in messages
    assert f"UNKNOWN_ENUM field=event_name value='signup' allowed={ENUM} record=e5" in messages


def test_server_violations(read):
    records = read(SERVER, SERVER_RECORDS)
    assert found(drift(dedup(records, SERVER.key), SERVER)) == [
        ("t2", "TYPE_MISMATCH", "amount", "int/float", "str"),
        (
            "t2",
            "UNKNOWN_ENUM",
            "status",
            "['completed', 'failed', 'pending', 'refunded']",
            "str",
        ),
    ]


def test_counts(read):
    client = extraction_stats(read(CLIENT, CLIENT_RECORDS), CLIENT).first()
    assert tuple(client) == ("client_events", 5, 1, 6, 4)
    server = extraction_stats(read(SERVER, SERVER_RECORDS), SERVER).first()
    assert tuple(server) == ("server_logs", 4, 1, 2, 3)


def test_empty_feed_counts_zero(spark, tmp_path):
    path = as_array(tmp_path / "none.json", [])
    records = read_records(spark, path, CLIENT)
    assert records.count() == 0
    assert tuple(extraction_stats(records, CLIENT).first()) == ("client_events", 0, 0, 0, 0)


def test_first_record_survives(read):
    kept = normalize_client(dedup(read(CLIENT, CLIENT_RECORDS), CLIENT.key))
    ids = {None if r.event_id is None else r.event_id.toPython() for r in kept.collect()}
    assert ids == {"e1", "e3", None, "e5"}
    server = normalize_server(dedup(read(SERVER, SERVER_RECORDS), SERVER.key)).collect()
    amounts = {r.tx_id.toPython(): r.amount.toPython() for r in server}
    assert float(amounts["t1"]) == 10.5 and amounts["t2"] == "12" and amounts["t3"] is True


def test_normalised_bag_and_link(read):
    client = normalize_client(read(CLIENT, CLIENT_RECORDS))
    assert client.columns == [
        "event_id",
        "timestamp",
        "user_id",
        "event_name",
        "properties",
        "_source",
        "_extracted_at",
    ]
    bags = [r.properties.toPython() for r in client.collect()]
    assert bags[0] == {"url": "/a"} and bags[3] == {} and bags[4] == {}
    server = normalize_server(read(SERVER, SERVER_RECORDS)).collect()
    links = [None if r.ext_id is None else r.ext_id.toPython() for r in server]
    assert links == ["e1", "e1", None, "  "]


def test_key_of_absent_null_and_number(read):
    records = [
        {"tx_id": 5},
        {"tx_id": "5"},
        {"tx_id": None},
        {"tx_id": "None"},
        {},
        {"tx_id": ""},
        {"tx_id": True},
        {"tx_id": "True"},
    ]
    kept = dedup(read(SERVER, records), SERVER.key, copies="copies").collect()
    assert sorted(r.copies for r in kept) == [2, 2, 2, 2]


def test_columns_of_the_key_do_not_run_together(read):
    records = [
        {"user_id": "a|b", "event_name": "c", "timestamp": "d"},
        {"user_id": "a", "event_name": "b|c", "timestamp": "d"},
    ]
    assert dedup(read(CLIENT, records), CLIENT.key).count() == 2


@pytest.mark.parametrize(
    ("value", "accepted"),
    [
        ("2026-01-01", True),
        ("2026-01-01T10", True),
        ("2026-01-01T10:00", True),
        ("2026-01-01 10:00:00", True),
        ("2026-01-01T10:00:00.123456+02:00", True),
        ("2026-01-01T10:00:00,5Z", True),
        ("20260101T100000", True),
        ("2026-W01-1", False),
        ("2026-W54-1", False),
        ("2026-01-01T10:00Z", True),
        ("2026-01-01T24:30", False),
        ("2026-02-30", False),
        ("2026-13-01T00:00:00Z", False),
        ("2026", False),
        ("now", False),
        ("01/02/2026", False),
        (20260101, True),
        (7, False),
        (True, False),
        ("", True),
        (None, True),
        (0, True),
        (False, True),
        ([], True),
    ],
)
def test_timestamps(spark, tmp_path, value, accepted):
    path = as_array(tmp_path / "t.json", [{"event_id": "e", "timestamp": value}])
    records = read_records(spark, path, CLIENT)
    assert drift_timestamp(records, CLIENT).isEmpty() == accepted


def test_enum_with_odd_values(spark, tmp_path):
    records = [{"event_id": str(i), "event_name": v} for i, v in enumerate([None, 3, [], {"a": 1}])]
    path = as_array(tmp_path / "t.json", records)
    rows = drift_enum(read_records(spark, path, CLIENT), CLIENT).collect()
    assert {(r.rec_id, r.value) for r in rows} == {("1", "3"), ("2", "[]"), ("3", '{"a":1}')}


def test_checks_over_typed_columns(spark):
    table = spark.createDataFrame(
        [("e1", "purchase"), ("e2", "nonsense"), ("e3", None)], "event_id string, event_name string"
    )
    assert [r.rec_id for r in drift_enum(table, CLIENT).collect()] == ["e2"]


def test_optional_keys(spark, tmp_path):
    feed = replace(SERVER, optional={"currency": ("str",)})
    records = [
        {**SERVER_RECORDS[0], "currency": "EUR"},
        {**SERVER_RECORDS[2], "currency": None, "status": "failed", "amount": 1, "meta": {}},
        {**SERVER_RECORDS[3], "currency": 978},
        {**SERVER_RECORDS[3], "tx_id": "t4"},
    ]
    path = as_array(tmp_path / "t.json", records)
    rows = drift(read_records(spark, path, feed), feed).collect()
    assert [(r.rec_id, r.kind, r.field, r.actual) for r in rows] == [
        ("t3", "TYPE_MISMATCH", "currency", "int")
    ]


def test_places_in_several_files(spark, tmp_path):
    for name in ("a", "b", "c"):
        as_lines(tmp_path / f"{name}.json", [{"event_id": f"{name}{i}"} for i in range(1, 6)])
    records = read_records(spark, str(tmp_path), CLIENT, lines=True)
    rows = number_records(records, records).collect()
    assert len(rows) == 15
    assert all(int(r.event_id.toPython()[1:]) == r.record_no for r in rows)


def test_places_over_file_blocks(spark, tmp_path):
    """A file cut into many blocks still counts and orders its records as written."""
    path = as_lines(
        tmp_path / "big.json", [{"event_id": str(i), "user_id": "u"} for i in range(1, 4001)]
    )
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        records = read_records(spark, path, CLIENT, lines=True)
        assert records.select("pos.block").distinct().count() > 5
        rows = number_records(records, records).collect()
        assert all(int(r.event_id.toPython()) == r.record_no for r in rows)
        # All share one key: the first in file order stays.
        kept = dedup(records, CLIENT.key, copies="copies").collect()
        assert [(r.event_id.toPython(), r.copies) for r in kept] == [("1", 4000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
