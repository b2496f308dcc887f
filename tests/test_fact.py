"""The fact is dealt out by its rows."""

import os
import re

import pytest
from pyspark.sql import functions as F

from chartloom.operators import merge
from chartloom.operators import relational as R
from chartloom.plans.queries import QUERIES
from chartloom.scratch import Scratch
from chartloom.sources import dataset

FOLDER = "/root/testdata/sf0.001"


def test_parts_grow_with_the_rows(spark, monkeypatch):
    least = spark.sparkContext.defaultParallelism
    assert dataset.tasks(spark, 0) == dataset.tasks(spark, dataset.TASK_ROWS) == least
    assert dataset.tasks(spark, 1000 * dataset.TASK_ROWS + 1) == 1001


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
def test_a_task_of_the_fact_holds_a_share(spark, monkeypatch):
    """Neither a few names nor packed bytes join what the rows have parted."""
    monkeypatch.setattr(dataset, "TASK_ROWS", 100)
    fact = dataset.fact(spark, FOLDER)
    n = -(-dataset.table(spark, FOLDER, "lineitem").count() // 100)
    sizes = [len(x) for x in fact.rdd.glom().collect()]
    assert len(sizes) == n and max(sizes) < 6 * 100 and sum(sizes) == fact.count()


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
def test_lines_meet_sellers_and_keys_in_as_many_parts(spark, monkeypatch):
    """The session's number of parts does not bound those that hold all lines or all rows of a load."""
    monkeypatch.setattr(dataset, "TASK_ROWS", 100)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        n = dataset.tasks(spark, dataset.table(spark, FOLDER, "lineitem").count())
        plan = QUERIES["upsert_weekly"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert set(re.findall(r"hashpartitioning\(l_suppkey#\d+L, (\d+)\)", plan)) == {str(n)}
        assert set(re.findall(r"hashpartitioning\([^()]*title_key#\d+, (\d+)\)", plan)) == {str(n)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_more_parts_than_the_session_makes(spark):
    rows = spark.range(40).selectExpr("id", "id % 4 as rank", "'box' as source_name", "concat('x', id % 2) as territory", "id % 9 as week_start", "concat('t', id % 3) as title_key")
    assert R.dedupe(rows, 37).rdd.getNumPartitions() == 37
    assert sorted(R.dedupe(rows, 37).collect()) == sorted(R.dedupe(rows, 2).collect()) == sorted(R.dedupe(rows).collect())


@pytest.fixture
def plain_exchanges(spark):
    """Plans with exchanges as they are planned, and no broadcast."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)


def exchanges(df):
    """Keys and number of parts of each exchange."""
    return [(k, int(n)) for k, n in re.findall(r"hashpartitioning\((.*), (\d+)\), [A-Z_]+", df._jdf.queryExecution().executedPlan().toString())]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
def test_legacy_repair_moves_the_fact_to_parts_by_the_rows(spark, monkeypatch, plain_exchanges):
    found, keep = {}, Scratch.keep
    monkeypatch.setattr(Scratch, "keep", lambda self, df, label: (found.update({label: exchanges(df)}), keep(self, df, label))[1])
    rows = QUERIES["legacy_link_films"](spark, FOLDER).count()
    few = found
    found = {}
    monkeypatch.setattr(dataset, "TASK_ROWS", 100)
    n = dataset.tasks(spark, dataset.table(spark, FOLDER, "lineitem").count())
    assert QUERIES["legacy_link_films"](spark, FOLDER).count() == rows
    for label in ("fact-2", "fact-3", "fact-4"):
        assert few[label] and {parts for _, parts in few[label]} == {4}
        assert {parts for _, parts in found[label]} == {n}
    for label in ("films-2", "films-4"):
        assert n in {parts for _, parts in found[label]}
    assert any("coalesce" in k for k, _ in found["fact-2"])  # rows without film do not meet in one task


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
def test_counts_of_the_repair_make_the_fact_once(spark, monkeypatch, plain_exchanges):
    """Rows bring what they had; films meet films in parts by the rows."""
    one = QUERIES["legacy_link_counts"](spark, FOLDER).collect()
    monkeypatch.setattr(dataset, "TASK_ROWS", 100)
    counts = QUERIES["legacy_link_counts"](spark, FOLDER)
    assert counts.collect() == one and None not in one[0]
    n = dataset.tasks(spark, dataset.table(spark, FOLDER, "lineitem").count())
    assert "l_partkey" not in counts._jdf.queryExecution().executedPlan().toString()
    assert [parts for k, parts in exchanges(counts) if re.fullmatch(r"(old_)?id#\d+L", k)] == [n, n]
    assert sorted(parts for k, parts in exchanges(counts) if k.startswith("source_movie_ref")) == [4, n, n]  # 4: counts of a task


def test_rows_without_film_are_spread(spark, plain_exchanges):
    rows = spark.createDataFrame([(i, None, i + 1) for i in range(1000)], "id long, source_movie_ref long, movie_id long")
    films = spark.range(1000).selectExpr("id", "'auto' as match_status", "-1L as movie_id")
    made = merge.propagate_match(rows, films)
    assert max(len(x) for x in made.rdd.glom().collect()) < 500
    assert made.filter("changed or movie_id <> id + 1").count() == 0 and made.count() == 1000


def test_adoptable_films_have_one_movie(spark):
    rows = spark.createDataFrame([(1, 7), (1, 7), (1, None), (2, 7), (2, 8), (3, None), (None, 7)], "source_movie_ref long, movie_id long")
    assert [tuple(r) for r in merge.adoptable(rows).collect()] == [tuple(r) for r in merge.adoptable(rows, 9).collect()] == [(1, 7)]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
def test_weeks_go_round_the_parts(spark, monkeypatch):
    """No part of the fact's sums and ranks has more than its share of the weeks, and no second exchange follows."""
    monkeypatch.setattr(dataset, "TASK_ROWS", 50)
    lines = dataset.table(spark, FOLDER, "lineitem").withColumn("week_start", dataset.chart_week(F.col("l_shipdate").cast("date")))
    weeks = lines.select("week_start").distinct().crossJoin(spark.range(5).withColumnRenamed("id", "r_regionkey"))
    n = dataset.tasks(spark, lines.count())
    held = [r["count"] for r in weeks.withColumn("part", dataset.week_part(n)).groupBy("part").count().collect()]
    assert len(held) == n and max(held) <= -(-sum(held) // n) + 2
    plan = dataset.fact(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"shufflepartitionidpassthrough\S*\(part#\d+\), %d\)" % n, plan)) == 1
    assert not re.findall(r"hashpartitioning\([^()]*week_start#", plan)


def test_rows_of_one_film_are_spread(spark, plain_exchanges):
    """Rows of crowded films meet them first; the result is as without."""
    rows = spark.range(3000).selectExpr("id", "case when id < 2000 then id % 2 when id < 2900 then id end as source_movie_ref", "case when id % 3 > 0 then id % 5 end as movie_id")
    films = spark.range(2950).selectExpr("id", "case when id = 1 then 'unmatched' else 'auto' end as match_status", "case when id <> 2001 then -id end as movie_id")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        few = spark.createDataFrame(films.filter("id < 2").collect(), films.schema)
        plain, apart = merge.propagate_match(rows, films.hint("merge")), merge.propagate_match(rows, films.hint("merge"), crowded=F.broadcast(few))
        assert sorted(apart.collect()) == sorted(plain.collect())
        assert max(len(x) for x in plain.rdd.glom().collect()) > 1200 > 900 > max(len(x) for x in apart.rdd.glom().collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")
def test_repair_tells_crowded_films_apart(spark, monkeypatch):
    wanted = sorted(QUERIES["legacy_link_result"](spark, FOLDER).collect())
    found, match = [], merge.propagate_match
    monkeypatch.setattr(merge, "propagate_match", lambda fact, films, parts, crowded: (found.append(crowded.count()), match(fact, films, parts, crowded))[1])
    monkeypatch.setattr(merge, "CROWD", 40)
    assert sorted(QUERIES["legacy_link_result"](spark, FOLDER).collect()) == wanted and found[0] > 0
