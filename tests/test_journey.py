"""Time matching against hand-worked cases and brute force."""

import random

import pytest

from counterfoil.operators import journey
from counterfoil.operators.corrections import session_check
from counterfoil.operators.journey import user_journey
from counterfoil.operators.timeline import borders, count_before, nearest, with_part
from tests.helpers import at, by, client_table, server_table


def tx(name, user, link, when, status="completed", amount=1.0):
    return (name, user, link, when, amount, status)


def ev(name, user, when, kind="page_view", value=0.0):
    return (name, user, when, kind, value)


def test_window_is_inclusive_to_the_microsecond(spark):
    client = client_table(
        spark,
        [ev("exact", "u1", at(0)), ev("over", "u2", at(0)), ev("before", "u3", at(0))],
    )
    server = server_table(
        spark,
        [
            tx("t1", "u1", None, at(300)),
            tx("t2", "u2", None, at(300.000001)),
            tx("t3", "u3", None, at(-300)),
        ],
    )
    rows = by(user_journey(client, server), "event_id")
    assert rows["exact"].transaction_id == "t1" and rows["exact"].time_delta_seconds == 300.0
    assert rows["over"].transaction_id is None and rows["over"].is_unmatched_client_event
    assert rows["over"].time_delta_seconds is None
    assert rows["before"].transaction_id == "t3"


def test_ties(spark):
    client = client_table(spark, [ev("e", "u", at(0)), ev("f", "u", at(1000))])
    server = server_table(
        spark,
        [
            tx("later", "u", None, at(10)),
            tx("b", "u", None, at(-10)),
            tx("a", "u", None, at(-10)),
            tx("y", "u", None, at(1000)),
            tx("x", "u", None, at(1000)),
        ],
    )
    rows = by(user_journey(client, server), "event_id")
    assert rows["e"].transaction_id == "a" and rows["f"].transaction_id == "x"


def test_conflicting_link(spark):
    client = client_table(spark, [ev("e1", "u", at(0)), ev("e2", "u", at(5)), ev("e3", "v", at(0))])
    server = server_table(spark, [tx("t", "u", "e1", at(1)), tx("s", "v", None, at(1))])
    rows = by(user_journey(client, server), "event_id")
    assert rows["e1"].has_conflicting_ext_id is False
    assert rows["e2"].has_conflicting_ext_id is True and rows["e2"].transaction_id == "t"
    assert rows["e3"].has_conflicting_ext_id is False


def test_missing_keys(spark):
    client = client_table(
        spark,
        [
            ev("no user", None, at(0)),
            ev("no time", "u", None),
            ev(None, "u", at(0)),
            ev(None, "u", at(2)),
            ev("twice", "u", at(100)),
            ev("twice", "u", at(1)),
        ],
    )
    server = server_table(spark, [tx("t", "u", None, at(1)), tx("s", None, None, at(0))])
    rows = user_journey(client, server).collect()
    assert len(rows) == 4
    named = {r.event_id: r for r in rows}
    assert named["no user"].is_unmatched_client_event
    assert named["no time"].is_unmatched_client_event
    assert named["twice"].time_delta_seconds == 0.0
    assert named[None].transaction_id == "t"


def test_link_comes_first(spark):
    client = client_table(spark, [ev("e1", "u", at(0)), ev("e2", "u", at(0)), ev("e3", "w", at(0))])
    server = server_table(
        spark,
        [
            tx("far", "u", "e1", at(5000)),
            tx("linked elsewhere", "u", "gone", at(0)),
            tx("near", "u", None, at(20)),
        ],
    )
    rows = by(user_journey(client, server, prefer_link=True), "event_id")
    assert rows["e1"].transaction_id == "far"
    assert rows["e2"].transaction_id == "near"
    assert rows["e3"].transaction_id is None


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_nearest_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    # Steps of 50 s from before 1970 give many ties, shared instants and cell edges.
    def moment():
        return rng.randrange(-200, 200) * 50_000_000 + rng.choice([0, 0, 1, -1])

    def near(when):
        return (when if rng.random() > 0.1 else None)

    probes = [(k, rng.choice("abc"), near(moment()), rng.choice([None, 300_000_000])) for k in range(400)]
    targets = [(rng.choice("abc"), near(moment()), f"t{i:03d}") for i in range(150)]
    got = nearest(
        spark.createDataFrame(probes, "n long, key string, at_us long, reach_us long").selectExpr(
            "1 AS space", "key", "at_us", "reach_us", "n AS tie", "named_struct('n', n) AS row"
        ),
        spark.createDataFrame(targets, "key string, at_us long, id string").selectExpr(
            "1 AS space", "*", "named_struct('name', id) AS target"
        ),
    )
    expected = {}
    for n, key, when, reach in probes:
        expected[n] = None
        own = [(t, name) for k, t, name in targets if k == key]
        timed = [(abs(when - t), t, name) for t, name in own if when is not None and t is not None]
        if timed:
            gap, _, name = min(timed)
            if reach is None or gap <= reach:
                expected[n] = name
        elif reach is None:
            expected[n] = min((t is not None, t or 0, name) for t, name in own)[2]
    rows = got.collect()
    assert len(rows) == len(expected)
    assert {r.row.n: r.target and r.target.name for r in rows} == expected


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_count_before_equals_brute_force(spark, seed):
    rng = random.Random(seed)

    def moment():
        return rng.randrange(-100, 100) * 600_000_000 + rng.choice([0, 0, 1, -1])

    probes = [(n, rng.choice("abc"), moment()) for n in range(300)]
    activity = [(n, rng.choice("abc"), moment(), rng.choice([0, 1, 2])) for n in range(400)]
    got = count_before(
        spark.createDataFrame(probes, "tie long, key string, at_us long").selectExpr(
            "*", "named_struct('n', tie) AS row"
        ),
        spark.createDataFrame(activity, "tie long, key string, at_us long, weight int"),
        3600,
    )
    expected = {
        n: sum(w for _, k, t, w in activity if k == key and when - 3_600_000_000 <= t < when)
        for n, key, when in probes
    }
    result = got.collect()
    assert len(result) == len(expected) and sum(expected.values()) > 50
    assert {r.row.n: r.preceding for r in result} == expected


def test_parts_of_one_busy_hour(spark):
    """One user holds a third of all rows within one hour, half of those at one instant."""
    n = 60_000
    rows = spark.range(n).selectExpr(
        "0 AS space",
        "IF(id % 3 = 0, 'busy', concat('u', id % 1000)) AS key",
        "CASE WHEN id % 6 = 0 THEN 1800000000 WHEN id % 3 = 0 THEN id * 60000 ELSE id * 7000000 END AS at_us",
        "1 AS kind",
        "xxhash64(id) AS tie",
    )
    cuts = borders(rows)
    sizes = [r["count"] for r in with_part(rows, cuts).groupBy("part").count().collect()]
    assert len(sizes) == len(cuts) + 1 >= 24
    assert max(sizes) < 2.5 * n / len(sizes)
    ordered = with_part(rows, cuts).orderBy("space", "key", "at_us", "kind", "tie").select("part").collect()
    assert [r.part for r in ordered] == sorted(r.part for r in ordered)


def test_parts_follow_the_order_of_any_place(spark):
    places = [(0, k, at, kind, tie) for k in (None, "", "a", "é", "\U0001f600") for at in (None, -5, 0, 7)
              for kind in (0, 1) for tie in (-(1 << 63), 3)]
    rows = spark.createDataFrame(places, "space int, key string, at_us long, kind int, tie long")
    ordered = [tuple(r) for r in rows.orderBy("key", "at_us", "kind", "tie").collect()]
    cuts = ordered[3::7]
    parts = {tuple(r)[:5]: r.part for r in with_part(rows, cuts).collect()}
    assert [parts[p] for p in ordered] == [sum(ordered.index(c) <= k for c in cuts) for k in range(len(ordered))]


def links_by_brute_force(events, transactions):
    """Rows of (id, user, time) and (id, user, link, time) to the transaction of each event id."""
    best = {}
    for event, user, when in events:
        pairs = [(0, None if when is None or t is None else abs(when - t), t, name)
                 for name, _, link, t in transactions if link is not None and link == event]
        pairs += [(1, abs(when - t), t, name) for name, u, link, t in transactions
                  if link is None and None not in (when, t, u) and u == user and abs(when - t) <= 300]
        pairs.append((2, None, None, None))
        for kind, gap, t, name in pairs:
            key = (kind != 0, gap is None, gap or 0, t is not None, t or 0, name or "", when is not None,
                   when or 0, user or "")
            if event not in best or key < best[event][0]:
                best[event] = (key, name)
    return {event: name for event, (_, name) in best.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_links_equal_brute_force(spark, seed):
    rng = random.Random(seed)

    def maybe(value):
        return value if rng.random() > 0.15 else None

    events = [(maybe(f"e{rng.randrange(40)}"), maybe(rng.choice("uvw")), maybe(rng.randrange(3000)))
              for _ in range(150)]
    transactions = [(f"t{k:03d}", maybe(rng.choice("uvw")), maybe(f"e{rng.randrange(50)}"),
                     maybe(rng.randrange(3000))) for k in range(120)]
    client = client_table(spark, [ev(e, u, w if w is None else at(w)) for e, u, w in events])
    server = server_table(spark, [tx(i, u, l, t if t is None else at(t)) for i, u, l, t in transactions])
    found = user_journey(client, server, prefer_link=True).collect()
    wanted = links_by_brute_force(events, transactions)
    assert {r.event_id: r.transaction_id for r in found} == wanted
    assert len(found) == len(wanted)


def test_links_of_a_repeated_id_form_no_pairs(spark, monkeypatch):
    """300 copies of one event and 400 transactions that name it: 700 rows, not 120,000."""
    client = client_table(spark, [ev("e", f"u{k}", at(10 * k)) for k in range(300)])
    server = server_table(spark, [tx(f"t{k}", "x", "e", at(100_000 - 7 * k)) for k in range(400)])
    seen = []

    def counted(probes, targets):
        rows = [df.where("space = 1").count() for df in (probes, targets)]
        found = nearest(probes, targets)
        seen.append((rows, found.where("target IS NOT NULL").count()))
        return found

    monkeypatch.setattr(journey, "nearest", counted)
    rows = user_journey(client, server, prefer_link=True).collect()
    assert [(r.event_at, r.transaction_id) for r in rows] == [(at(2990), "t399")]
    assert seen == [([300, 400], 300)]


def test_busy_user_is_spread_over_parts(spark):
    """One user holds every row; the rows still reach many tasks, and the result is whole."""
    n = 20_000
    client = spark.range(n).selectExpr(
        "concat('e', id) AS event_id", "'u' AS user_id",
        "timestamp_micros(1767225600000000 + id * 60000000) AS event_at",
        "'page_view' AS event_name", "0.0D AS event_value", "'' AS product_id", "'' AS page_url",
        "'' AS traffic_source", "false AS is_conversion_client",
    )
    server = spark.range(n).selectExpr(
        "concat('t', id) AS transaction_id", "'u' AS user_id", "CAST(NULL AS STRING) AS client_event_id",
        "timestamp_micros(1767225600000000 + id * 60000000 + 7000000) AS transaction_at",
        "1.0D AS transaction_amount", "'completed' AS transaction_status", "true AS is_completed",
        "false AS is_failed", "false AS is_refunded", "true AS is_revenue_recognized",
    )
    matched = user_journey(client, server)
    row = matched.selectExpr(
        "count(*) AS n", "count_if(substr(event_id, 2) = substr(transaction_id, 2)) AS same",
        "max(time_delta_seconds) AS gap",
    ).first()
    assert tuple(row) == (n, n, 7.0)
    plan = matched._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(part" in plan
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_close_rows_of_one_user(spark):
    """The work is one pass, not a comparison of all pairs, and parts join without a seam."""
    n = 300_000
    rows = spark.range(n).selectExpr(
        "0 AS space", "'u' AS key", "1767225600000000 + id * 100 AS at_us", "300000000L AS reach_us",
        "id AS tie", "named_struct('id', id) AS row", "1L AS weight",
    )
    targets = rows.selectExpr(
        "space", "key", "at_us + 30 AS at_us", "concat('t', tie) AS id",
        "named_struct('place', tie) AS target",
    )
    found = nearest(rows, targets).selectExpr(
        "count(*) AS n", "count_if(target.place = row.id) AS right"
    )
    assert tuple(found.first()) == (n, n)
    counted = count_before(rows, rows, 3600).selectExpr("count(*) AS n", "sum(preceding) AS total")
    assert tuple(counted.first()) == (n, n * (n - 1) // 2)


def test_no_targets_and_no_rows(spark):
    client = client_table(spark, [ev("e", "u", at(0))])
    none = server_table(spark, [])
    assert [r.transaction_id for r in user_journey(client, none, prefer_link=True).collect()] == [None]
    assert user_journey(client.limit(0), none).collect() == []
    assert session_check(client.limit(0)).collect() == []
