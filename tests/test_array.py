"""One large JSON array, read by many tasks."""

import json
import random

import pytest

from counterfoil.operators.ingest import dedup
from counterfoil.plans import extract_feeds
from counterfoil.sources import CLIENT, SERVER, land_array, number_records, read_array
from counterfoil.sources.records import array_texts

rng = random.Random(3)


@pytest.fixture
def blocks(spark):
    """Files are cut into blocks of a few hundred bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def text():
    return "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", ":", "é", "\U0001f600", " ", "a", "\n"])
                   for _ in range(rng.randrange(25)))


def value(depth=0):
    kinds = [text, lambda: rng.randrange(99), lambda: None, lambda: True]
    if depth < 3:
        kinds += [lambda: {text(): value(depth + 1) for _ in range(rng.randrange(3))},
                  lambda: [value(depth + 1) for _ in range(rng.randrange(3))]]
    return rng.choice(kinds)()


def records(n):
    return [{"event_id": f"e{k}", "user_id": text(), "properties": value()} for k in range(n)]


def plain(row):
    return {c: None if row[c] is None else row[c].toPython() for c in ("event_id", "user_id", "properties")}


@pytest.mark.parametrize("indent", [None, 1])
def test_array_in_many_blocks(spark, tmp_path, blocks, indent):
    wanted = records(250)
    for ascii_ in (True, False):
        path = tmp_path / f"{ascii_}.json"
        path.write_text(json.dumps(wanted, indent=indent, ensure_ascii=ascii_), encoding="utf-8")
        landed = land_array(spark, str(path), CLIENT)
        assert spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions() > 20
        rows = number_records(landed, landed).orderBy("record_no").collect()
        assert [plain(r) for r in rows] == wanted
        assert [r.record_no for r in rows] == list(range(1, 251))
        assert all(r.unreadable is None for r in rows)


@pytest.mark.parametrize("cut", [3, 400, 2001, 7777])
def test_records_before_a_break_are_kept(spark, tmp_path, blocks, cut):
    whole = json.dumps(records(120))
    path = tmp_path / "cut.json"
    path.write_text(whole[:cut])
    before = 0
    decoder, at = json.JSONDecoder(), 1
    wanted = []
    while at < cut:
        try:
            found, at = decoder.raw_decode(whole[:cut], at)
        except ValueError:
            break
        wanted.append(found)
        before, at = at, at + 2
    rows = land_array(spark, str(path), CLIENT).collect()
    assert sorted((plain(r) for r in rows if r.unreadable is None), key=repr) == sorted(wanted, key=repr)
    rest = "".join(r.unreadable for r in sorted(rows, key=lambda r: r.pos.row) if r.unreadable is not None)
    assert rest.replace(" ", "").lstrip(",[") == whole[before:cut].replace(" ", "").lstrip(",[")
    if rest:
        with pytest.raises(Exception, match="unreadable"):
            land_array(spark, str(path), CLIENT, strict=True)


def test_odd_arrays(spark, tmp_path):
    for name, text_ in {"a": "[]", "b": " [ ] ", "c": "", "d": '[{}, 5, {"event_id": "x"}, "y"]',
                        "e": '[[{"event_id": "deep"}]]', "f": '[{"event_id": 1}]\n'}.items():
        (tmp_path / f"{name}.json").write_text(text_)
    rows = land_array(spark, str(tmp_path), CLIENT).collect()
    found = sorted((r.pos.file[-6], r.event_id and r.event_id.toPython(), r.unreadable) for r in rows if r.unreadable is None)
    assert found == [("d", None, None), ("f", 1, None)]
    assert sorted(r.pos.file[-6] for r in rows if r.unreadable is not None) == ["d", "d", "e", "e"]
    assert read_array(spark, str(tmp_path), CLIENT).count() == 2


def test_files_keep_their_order(spark, tmp_path, blocks):
    for name in ("b", "a"):
        rows = [{"event_id": f"{name}{k}", "user_id": "u"} for k in range(60)]
        (tmp_path / f"{name}.json").write_text(json.dumps(rows))
    kept = dedup(read_array(spark, str(tmp_path), CLIENT), CLIENT.key, copies="copies").collect()
    assert [(r.event_id.toPython(), r.copies) for r in kept] == [("a0", 120)]


def test_extraction_from_split_arrays(spark, tmp_path):
    client = [{"event_id": f"e{k}", "timestamp": "2026-01-01", "user_id": f"u{k % 5}", "event_name": "search",
               "properties": {}} for k in range(30)]
    (tmp_path / "c.json").write_text(json.dumps(client)[:-40])
    (tmp_path / "s.json").write_text("[]")
    out = str(tmp_path / "out")
    stats = extract_feeds(spark, str(tmp_path / "c.json"), str(tmp_path / "s.json"), out, split=True)
    counts = {r.source: (r.total_ingested, r.clean_records_written) for r in stats.collect()}
    assert counts == {CLIENT.name: (29, 5), SERVER.name: (0, 0)}
    broken = spark.read.json(f"{out}/unreadable_records").collect()
    assert [(r.source, r.unreadable_records) for r in broken] == [(CLIENT.name, 1)]


def test_pieces_are_elements_only_when_they_end(spark, tmp_path):
    (tmp_path / "x.json").write_text('[{"a": "}"}, {"b": {"c": 1}')
    rows = sorted((r.place, r.text, r.whole) for r in array_texts(spark, str(tmp_path / "x.json")).collect())
    assert rows == [(0, '[{"a": "}"}', True), (1, ', {"b": {"c": 1}', False)]
