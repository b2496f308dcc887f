"""Loads into the fact by week: what they touch, what they leave, and what is left when one is killed."""

from datetime import date, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from chartloom.sources.weeks import SchemaChanged, Weeks

FACT = (
    "id long, source_name string, territory string, week_start date, week_end date, rank long, title string, title_key string, distributor string, weekly_gross long, "
    "total_gross long, screen_count long, weeks_in_release long, movie_id long, source_movie_ref long"
)
FIRST = date(2026, 9, 3)


def row(id, title, week, gross=1000, movie=None, ref=1):
    start = FIRST + timedelta(7 * week)
    return id, "box", "IT", start, start + timedelta(3), id, title, title.lower(), "D", gross, 9000, 100, 1, movie, ref


def rows(spark, *values):
    return spark.createDataFrame(list(values), FACT)


def pages(spark):
    return spark.createDataFrame([("u", "abc")], "url string, content_sha256 string")


def files(root):
    return {str(p.parent.name): p.name for p in sorted(Path(root, "fact").rglob("*.parquet"))}


def test_only_touched_weeks_are_written(spark, tmp_path):
    w = Weeks(spark, str(tmp_path))
    w.merge(rows(spark, *[row(10 * k + i, t, k, movie=5) for k in range(3) for i, t in enumerate("AB")]), 1, at=100)
    before = files(tmp_path)
    w.merge(rows(spark, row(10, "A", 1, gross=7), row(19, "C", 1)), 2, at=200)
    after = files(tmp_path)
    assert {k for k in after if after[k] != before.get(k)} == {f"week_start={FIRST + timedelta(7)}"}
    got = {r["id"]: (r["weekly_gross"], r["movie_id"], r["ingestion_run_id"], r["created_at"], r["updated_at"]) for r in w.fact().collect()}
    assert got[10] == (7, 5, 2, 100, 200) and got[19] == (1000, None, 2, 200, 200) and got[11] == (1000, 5, 1, 100, 100) and got[0] == (1000, 5, 1, 100, 100)
    w.merge(rows(spark, row(10, "A", 1, gross=7), row(19, "C", 1)), 2, at=200)
    assert {r["id"]: (r["weekly_gross"], r["movie_id"], r["ingestion_run_id"], r["created_at"], r["updated_at"]) for r in w.fact().collect()} == got


def test_a_load_parts_its_rows_and_counts_them(spark, tmp_path):
    w = Weeks(spark, str(tmp_path))
    assert w.load("chart", pages(spark), rows(spark, row(1, "A", 0), row(2, "B", 0, gross=None), row(3, "C", 0, ref=None)), 7, at=50) == {"read": 3, "refused": 2}
    assert [r["id"] for r in w.fact().collect()] == [1]
    refused = spark.read.parquet(w.path("refused")).select("id", "reason", "run_id").collect()
    assert sorted(map(tuple, refused)) == [(2, "no gross", 7), (3, "no film", 7)]
    assert [tuple(r)[:3] + tuple(r)[4:6] for r in w.runs().collect()] == [(7, "chart", "success", 3, 2)]


def test_a_killed_load_leaves_snapshots_and_an_open_run(spark, tmp_path, monkeypatch):
    w = Weeks(spark, str(tmp_path))
    w.load("chart", pages(spark), rows(spark, row(1, "A", 0)), 1)

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(w, "stage", killed)
    with pytest.raises(KeyboardInterrupt):
        w.load("chart", pages(spark), rows(spark, row(2, "B", 0)), 2)
    assert {r["run_id"]: r["status"] for r in w.runs().collect()} == {1: "success", 2: "running"}
    assert sorted(r["run_id"] for r in spark.read.parquet(w.path("snapshots")).collect()) == [1, 2]
    assert [r["id"] for r in w.fact().collect()] == [1]
    assert w.sweep(2**62) == 1 and w.sweep(2**62) == 0
    assert {r["run_id"]: r["status"] for r in w.runs().collect()} == {1: "success", 2: "failed"}


def test_a_failed_load_says_why(spark, tmp_path):
    w = Weeks(spark, str(tmp_path))
    w.load("chart", pages(spark), rows(spark, row(1, "A", 0)), 1)
    with pytest.raises(SchemaChanged, match="distributor, extra"):
        w.load("chart", pages(spark), rows(spark, row(2, "B", 0)).drop("distributor").withColumn("extra", F.lit(1)).withColumn("distributor", F.lit(1)), 2)
    last = {r["run_id"]: r for r in w.runs().collect()}
    assert last[2]["status"] == "failed" and "extra" in last[2]["error_message"] and [r["id"] for r in w.fact().collect()] == [1]


def test_late_weeks_by_stream_are_the_batch_result(spark, tmp_path):
    values = [row(10 * k + i, t, k, gross=100 + k) for k in (2, 0, 1) for i, t in enumerate("AB")]
    revised = [row(10, "A", 1, gross=1), row(1, "B", 0, gross=2)]
    source = str(tmp_path / "source")
    for part in ([*values[:2]], values[2:4], values[4:], revised[:1], revised[1:]):
        rows(spark, *part).coalesce(1).write.mode("append").parquet(source)
    w = Weeks(spark, str(tmp_path / "stream"))
    batches = spark.readStream.schema(FACT).option("maxFilesPerTrigger", 1).parquet(source)
    w.stream(batches, str(tmp_path / "checkpoint")).awaitTermination()
    assert {r["id"]: r["weekly_gross"] for r in w.fact().collect()} == {20: 102, 21: 102, 0: 100, 1: 2, 10: 1, 11: 101}
    before = files(tmp_path / "stream")
    w.stream(batches, str(tmp_path / "checkpoint")).awaitTermination()  # nothing new
    assert files(tmp_path / "stream") == before
