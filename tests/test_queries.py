"""Every registered chart query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

from chartloom.plans import oracle
from chartloom.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


@pytest.fixture(scope="module")
def tables():
    c = duckdb.connect()
    for name in os.listdir(FOLDER):
        c.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{name}'")
    return c


def rows(found, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([r[i] for i in order]) for r in found)


@pytest.mark.parametrize("name", ["weekly_trend", "weekly_enriched", "dedupe_week_title", "missing_weeks", "upsert_weekly", "legacy_link_result", "health_integrity", "parse_chart_pages", "match_decision"])
def test_against_sql(spark, tables, name):
    made = QUERIES[name](spark, FOLDER)
    by_sql = tables.execute(oracle.oracle_sql()[name])
    columns = [c[0] for c in by_sql.description]
    assert sorted(columns) == sorted(made.columns)
    assert rows(by_sql.fetchall(), columns) == rows(made.collect(), made.columns)


def test_entry_without_the_corpus_operators(spark):
    import __spark_entry__

    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(oracle.SQL) <= set(__spark_entry__.oracle_sql())
    assert set(oracle.SQL) <= set(QUERIES)


def test_no_all_pairs_plan(spark):
    """The gap check joins on days, not on a range."""
    plan = QUERIES["missing_weeks"](spark, FOLDER)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
