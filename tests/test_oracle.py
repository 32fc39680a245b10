"""Every query over `events` against its SQL, over whole tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as registry
from oracle_queries import ORACLES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{FOLDER}/events.parquet'")
    return con


def rows(pdf: pd.DataFrame) -> list[tuple]:
    def plain(value):
        if pd.isna(value):
            return None
        if hasattr(value, "item"):
            value = value.item()
        if hasattr(value, "isoformat"):
            return pd.Timestamp(value).isoformat()
        if isinstance(value, float) and value.is_integer():
            return int(value)
        return value

    ordered = pdf[sorted(pdf.columns)].astype(object)
    return sorted(
        (tuple(plain(v) for v in row) for row in ordered.itertuples(index=False)), key=repr
    )


@pytest.mark.parametrize("name", sorted(registry._QUERIES))
def test_query_matches_sql(spark, duck, name):
    ours = registry.queries()[name](spark, FOLDER).toPandas()
    theirs = duck.execute(registry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) > 0
    assert rows(ours) == rows(theirs)


def test_every_query_has_an_oracle():
    assert set(registry._QUERIES) == set(ORACLES)
    assert set(registry._QUERIES) <= set(registry.queries())
    assert set(ORACLES) <= set(registry.oracle_sql())


def test_entry(spark):
    assert registry.entry(spark).count() == 4
