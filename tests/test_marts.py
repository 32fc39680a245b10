import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from counterfoil.operators import corrections, marts, summaries
from counterfoil.functions import spread
from tests.helpers import at, by, client_table, server_table

DAY = 86_400


@pytest.fixture(scope="module")
def tables(spark):
    client = client_table(
        spark,
        [
            ("e1", "u", at(0), "purchase_intent", 10.0),
            ("e2", "u", at(1), "page_view", 5.0),
            ("e3", "u", at(DAY), "purchase_intent", 20.0),
            ("e4", "u", at(0), "purchase_intent", 0.0),
            ("e5", None, at(0), "purchase_intent", 1.0),
            (None, "u", at(0), "purchase_intent", 1.0),
        ],
    )
    server = server_table(
        spark,
        [
            ("both", "u", "e1", at(5), 10.0, "completed"),
            ("again", "u", "e1", at(6), 12.5, "completed"),
            ("no link", "u", None, at(7), 7.0, "completed"),
            ("free", "u", None, at(8), 0.0, "pending"),
            ("dangling", "u", "gone", at(9), 3.0, "completed"),
            ("other event", "u", "e2", at(10), 5.0, "completed"),
            ("failed", "u", "e3", at(DAY), 20.0, "failed"),
            ("unknown", "u", "e4", at(11), 4.0, None),
            ("refund", "u", "e4", at(2 * DAY), 4.0, "refunded"),
        ],
    )
    return client, server


@pytest.fixture(scope="module")
def mart(tables):
    client, server = tables
    return marts.reconcile(server, client)


def test_categories(mart):
    rows = by(mart, "transaction_id")
    assert len(rows) == mart.count() == 9
    assert {name: row.attribution_category for name, row in rows.items()} == {
        "both": "both",
        "again": "both",
        "no link": "finance_only",
        "free": "neither",
        "dangling": "finance_only",
        "other event": "finance_only",
        "failed": "marketing_only",
        "unknown": "neither",
        "refund": "marketing_only",
    }
    assert rows["again"].variance == 2.5 and rows["again"].is_reconciled is False
    assert rows["free"].is_reconciled is True and rows["free"].client_reported_amount is None
    assert rows["dangling"].client_event_id is None and rows["dangling"].has_client_event is False
    assert rows["unknown"].conversion_definition_finance is None
    assert rows["unknown"].conversion_definition_marketing is True


def test_rows_without_link_do_not_share_a_join_key(mart, tables):
    key = spread(F.col("client_event_id"), F.col("transaction_id"))
    unlinked = tables[1].where("client_event_id IS NULL").select(key)
    assert unlinked.distinct().count() == unlinked.count()


def test_daily(mart):
    finance = by(marts.finance_daily(mart), "report_date")
    assert [r.transaction_count for r in finance.values()] == [5]
    marketing = by(marts.marketing_daily(mart), "report_date")
    assert len(marketing) == 3
    summary = marts.revenue_summary(mart).collect()
    assert [str(r.report_date) for r in summary] == ["2026-01-01", "2026-01-02", "2026-01-03"]
    first, second, _ = summary
    assert first.finance_revenue == 37.5 and first.marketing_revenue == 20.0
    assert first.revenue_variance == 17.5 and first.revenue_variance_pct == 46.67
    assert first.finance_reconciled_revenue == 10.0
    assert first.conversion_count_variance == -2
    assert second.finance_revenue is None and second.finance_transaction_count is None
    assert second.revenue_variance is None and second.revenue_variance_pct is None
    nulls = marts.revenue_summary(mart, reference_dates=True).collect()
    assert [r.report_date is None for r in nulls] == [False, True, True]


def test_summary_is_the_pivot_of_the_long_form(spark):
    mart = registry.Tables(spark, "/root/testdata/sf0.01").mart
    long = marts.revenue_by_source(mart)
    pivot = (
        long.groupBy("report_date")
        .pivot("revenue_source", ["finance", "marketing"])
        .agg(F.first("gross_revenue").alias("r"), F.first("transaction_count").alias("n"))
        .orderBy("report_date")
        .collect()
    )
    wide = marts.revenue_summary(mart).collect()
    assert [tuple(r) for r in pivot] == [
        (
            r.report_date,
            r.finance_revenue,
            r.finance_transaction_count,
            r.marketing_revenue,
            r.marketing_transaction_count,
        )
        for r in wide
    ]
    both = marts.finance_daily(mart).unionByName(marts.marketing_daily(mart))
    assert long.exceptAll(both).isEmpty() and both.exceptAll(long).isEmpty()


def test_known_totals(spark):
    mart = registry.Tables(spark, "/root/testdata/sf0.01").mart
    rows = [tuple(r) for r in marts.attribution_snapshot(mart).collect()]
    assert rows == [
        ("finance_only", 1130, 57503.85, 0.0),
        ("both", 1057, 50795.13, 50975.5),
        ("marketing_only", 514, 25119.63, 24267.23),
        ("neither", 271, 13203.38, 432.45),
    ]


def test_corrected_flags(mart):
    rows = by(corrections.correct_marketing(mart), "transaction_id")
    flags = {
        name: (r.conversion_definition_marketing_corrected, r.was_overcounted_by_marketing)
        for name, r in rows.items()
    }
    assert flags["failed"] == (False, True)
    assert flags["both"] == (True, False)
    assert flags["unknown"] == (True, None)
    assert flags["no link"] == (False, False)


def test_channels(tables):
    rows = by(corrections.tag_channel(tables[1]), "transaction_id")
    assert rows["no link"].attribution_channel == "unattributed"
    assert rows["dangling"].is_dark_transaction is False


def test_decomposition(mart):
    rows = [tuple(r)[:3] for r in corrections.revenue_decomposition(mart).collect()]
    assert rows == [
        ("finance_completed", 5, 37.5),
        ("marketing_purchase_intents", 5, 40.0),
        ("variance_dark_revenue", 3, 15.0),
        ("variance_failed_but_tracked", 2, 20.0),
    ]
    empty = [tuple(r)[1:3] for r in corrections.revenue_decomposition(mart.limit(0)).collect()]
    assert empty == [(0, None)] * 4


def test_session_check(spark):
    client = client_table(
        spark,
        [
            ("p", "u", at(3600), "purchase_intent", 1.0),
            ("start", "u", at(0), "page_view", 0.0),
            ("too early", "u", at(-0.000001), "page_view", 0.0),
            ("same time", "u", at(3600), "add_to_cart", 0.0),
            ("other kind", "u", at(10), "search", 0.0),
            ("other user", "v", at(10), "page_view", 0.0),
            (None, "u", at(20), "page_view", 0.0),
            ("q", "w", at(3600), "purchase_intent", 1.0),
            ("no user", None, at(3600), "purchase_intent", 1.0),
            ("no time", "u", None, "purchase_intent", 1.0),
        ],
    )
    rows = by(corrections.session_check(client), "event_id")
    assert {k: r.preceding_event_count for k, r in rows.items()} == {
        "p": 1,
        "q": 0,
        "no user": 0,
        "no time": 0,
    }
    assert rows["p"].has_preceding_session_activity is True
    assert rows["q"].has_preceding_session_activity is False


def test_summaries_of_nothing(mart, spark):
    assert tuple(summaries.summary_mart(mart.limit(0)).first()) == (0, 0.0, 0.0, 0.0, 0, 0.0, 0, 0.0)
    registered = registry.Tables(spark, "/root/testdata/sf0.001")
    assert tuple(summaries.summary_client(registered.clean_client.limit(0)).first()) == (
        0,
        False,
        0,
        0.0,
    )
    assert tuple(summaries.summary_server(registered.clean_server.limit(0)).first()) == (
        0,
        0,
        0,
        0.0,
    )


def test_samples(mart):
    names = [r.transaction_id for r in summaries.sample(mart, "finance_only", 2).collect()]
    assert names == ["no link", "dangling"]


def test_row_counts(mart):
    counts = marts.model_row_counts({"a": mart, "b": mart.limit(2)}).collect()
    assert [tuple(r) for r in counts] == [("a", 9), ("b", 2)]


def test_session_check_without_event_id(spark):
    """A purchase without an id has no preceding activity, whatever its user did."""
    from counterfoil.operators.corrections import session_check

    client = spark.sql(
        "SELECT * FROM VALUES ('e1', 'u', timestamp'2024-01-01 10:00:00', 'page_view', 0d),"
        " (null, 'u', timestamp'2024-01-01 10:10:00', 'purchase_intent', 1d),"
        " ('e3', 'u', timestamp'2024-01-01 10:20:00', 'purchase_intent', 1d)"
        " AS t(event_id, user_id, event_at, event_name, event_value)"
    )
    found = {r.event_id: r.preceding_event_count for r in session_check(client).collect()}
    assert found == {None: 0, "e3": 1}
