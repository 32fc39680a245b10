"""Plans and results that must hold however large or lopsided the tables are."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from counterfoil.operators import audit, corrections, ingest, journey, marts, summaries
from counterfoil.plans.tables import written
from counterfoil.sources.feeds import CLIENT

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return registry.Tables(spark, FOLDER)


@pytest.fixture(scope="module")
def staged(tables):
    """Staging tables as files, as a run leaves them."""
    return written(tables.client, "client"), written(tables.server, "server")


@pytest.fixture
def no_broadcast(spark):
    """Plans as for sides too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange (?:hash|range|round|Single)", plan(df)))


FORBIDDEN = ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas")


@pytest.mark.parametrize(
    "name", [n for n in registry._QUERIES if not n.startswith(("write", "stream", "save", "read"))]
)
def test_no_pairing_of_everything_and_no_python(spark, name):
    text = plan(registry.queries()[name](spark, FOLDER))
    assert not any(operator in text for operator in FORBIDDEN)


def test_mart_reads_two_client_columns_of_purchases_only(staged):
    client, server = staged
    text = plan(marts.reconcile(server, client))
    scan = next(s for s in text.split("FileScan") if s.startswith(" parquet [event_id"))
    assert "EqualTo(event_name,purchase_intent)" in scan
    assert "ReadSchema: struct<event_id:string,event_name:string,event_value:double>" in scan


def test_shuffles(staged, no_broadcast):
    client, server = staged
    mart = marts.reconcile(server, client)
    assert exchanges(mart) == 2
    assert exchanges(marts.finance_daily(mart)) == 3
    assert exchanges(marts.revenue_by_source(mart)) == 3
    assert exchanges(corrections.revenue_decomposition(mart)) == 3
    assert exchanges(summaries.summary_mart(mart)) == 3
    assert exchanges(corrections.correct_marketing(mart)) == 2
    assert exchanges(corrections.tag_channel(server)) == 0
    assert exchanges(corrections.session_check(client)) == 1
    assert exchanges(journey.user_journey(client, server, unique_ids=True)) == 3
    assert exchanges(journey.user_journey(client, server)) == 4
    assert exchanges(journey.user_journey(client, server, prefer_link=True)) == 4


def test_dedup_decides_on_narrow_rows(tables):
    """Records are neither sorted nor shuffled; hash and position alone are grouped."""
    kept = ingest.dedup(tables.raw_client, CLIENT.key)
    text = plan(kept)
    assert exchanges(kept) == 1 and "partial_min(_order" in text
    assert text.count("BroadcastExchange") == 2
    for text in (text, plan(ingest.extraction_stats(tables.raw_client, CLIENT))):
        assert not re.search(r"SortAggregate|ObjectHashAggregate|Sort \[", text)
    assert exchanges(ingest.extraction_stats(tables.raw_client, CLIENT)) == 2
    assert exchanges(ingest.drift(tables.raw_client, CLIENT)) == 0


def test_dedup_without_broadcast_never_sorts_whole_groups(tables, no_broadcast):
    text = plan(ingest.dedup(tables.raw_client, CLIENT.key))
    assert "Aggregate" in text and "SortAggregate" not in text


def test_a_third_of_the_records_share_a_key(spark):
    hot = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('t', id) END AS tx_id",
        "id AS amount",
        "9000000000 - id AS pos",
    )
    kept = ingest.dedup(hot, ["tx_id"], copies="copies")
    row = kept.selectExpr("count(*)", "sum(copies)", "min_by(amount, tx_id = 'hot')", "max(copies)")
    last = kept.where("tx_id = 'hot'").select("amount", "copies").collect()
    assert tuple(row.first())[:2] == (20_001, 30_000) and [tuple(r) for r in last] == [(29_997, 10_000)]


def test_sample_is_a_top_k(tables):
    assert "TakeOrderedAndProject" in plan(summaries.sample(tables.mart, "both"))


def test_verification_groups_before_it_joins(tables, no_broadcast):
    figures = audit._source_figures(tables.client, tables.server)
    below_join = plan(figures).split("Join [link", 1)[1]
    assert "keys=[client_event_id" in below_join and "partial_sum" in below_join


def test_same_results_without_broadcast(tables, no_broadcast, spark):
    for name in ("mart_reconciliation", "int_user_journey", "session_check", "audit_verified"):
        query = registry.queries()[name]
        first = query(spark, FOLDER)
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        second = query(spark, FOLDER)
        difference = first.exceptAll(second).count() + second.exceptAll(first).count()
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert difference == 0


def test_lopsided_keys(spark, tables):
    """A third of the transactions name one event, a third name none; nothing is lost."""
    third = F.pmod(F.xxhash64("transaction_id"), F.lit(3))
    some_event = tables.client.where("event_name = 'purchase_intent'").agg(F.min("event_id"))
    hot = some_event.first()[0]
    server = tables.server.withColumn(
        "client_event_id",
        F.when(third == 0, hot).when(third == 1, F.lit(None)).otherwise(F.col("client_event_id")),
    )
    mart = marts.reconcile(server, tables.client)
    assert mart.count() == server.count()
    assert mart.where(F.col("client_event_id") == hot).count() >= server.where(third == 0).count()
    verified = audit.verify(audit.audit_findings(mart, tables.client), tables.client, server)
    assert all(r.verified for r in verified.collect())
    linked = journey.user_journey(tables.client, server, prefer_link=True)
    assert linked.count() == tables.client.count()


def test_totals_do_not_depend_on_partitioning(tables):
    few = marts.revenue_summary(tables.mart.coalesce(1)).collect()
    many = marts.revenue_summary(tables.mart.repartition(37)).collect()
    assert few == many
