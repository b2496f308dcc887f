from datetime import date

import pytest
from pyspark.sql import functions as F

from chartloom.operators import calendar, matching, merge, quality
from chartloom.operators import relational as R
from chartloom.plans import export
from chartloom.sources import catalogue, pages
from chartloom.sources.store import Store
from chartloom.streaming.charts import merge_stream

FACT = (
    "id long, source_name string, territory string, week_start date, week_end date, rank long, title string, title_key string, distributor string, weekly_gross long, "
    "total_gross long, screen_count long, weeks_in_release long, movie_id long, source_movie_ref long"
)
FILMS = "id long, source_name string, source_movie_id string, title string, title_key string, movie_id long, match_status string, match_method string, match_confidence long"


def row(id, title="A", rank=1, week=date(2026, 9, 17), gross=1000, total=2000, movie=None, ref=None, territory="IT"):
    return id, "box", territory, week, date(2026, 9, 20), rank, title, title.strip().lower(), "D", gross, total, 100, 1, movie, ref


def fact(spark, *rows):
    return spark.createDataFrame(list(rows), FACT)


def ids(df, c="id"):
    return sorted(r[c] for r in df.collect())


def test_dedupe_keeps_the_lowest_rank(spark):
    f = fact(spark, row(1, "Cars: Motori Ruggenti", 2), row(2, "  cars: motori ruggenti  ", 1), row(3, "Blue"), row(4, "Blue Film"), row(5, "Blue", week=date(2026, 9, 24)))
    assert ids(R.dedupe(f)) == [2, 3, 4, 5]


def test_upsert_is_idempotent_and_keeps_links(spark):
    old = fact(spark, row(1, "A", movie=7, ref=70), row(2, "B"))
    new = fact(spark, row(9, "A", rank=3, gross=5), row(8, "C"))
    once = merge.upsert_chart(old, new)
    once = spark.createDataFrame(once.collect(), once.schema)
    twice = merge.upsert_chart(once, new)
    got = {r["title_key"]: (r["id"], r["rank"], r["weekly_gross"], r["movie_id"], r["source_movie_ref"]) for r in once.collect()}
    assert got == {"a": (1, 3, 5, 7, 70), "b": (2, 1, 1000, None, None), "c": (8, 1, 1000, None, None)}
    assert sorted(once.collect()) == sorted(twice.collect())


def test_legacy_link_is_idempotent(spark):
    films = spark.createDataFrame([
        (1, "box", "legacy:michael", "Michael", "michael", 555, "auto", "x", 900), (2, "box", "9001", "Michael", "michael", None, "unmatched", None, None),
        (3, "box", "legacy:other", "Other", "other", 777, "auto", "x", 900), (4, "box", "9002", "Other", "other", 778, "auto", "x", 900),
    ], FILMS)
    f = fact(spark, row(1, "Michael", ref=1), row(2, "Other", ref=3), row(3, "New", movie=5), row(4, "Michael", week=date(2026, 9, 24)))
    f1, s1 = merge.link_legacy(f, films)
    again = [spark.createDataFrame(x.collect(), x.schema) for x in (f1, s1)]
    f2, s2 = merge.link_legacy(*again)
    got = {r["id"]: (r["source_movie_ref"], r["movie_id"]) for r in f1.collect()}
    assert got[1] == got[4] == (2, 555) and got[2] == (3, 777)
    assert {r["source_movie_id"]: r["match_status"] for r in s1.collect()} == {"9001": "auto", "legacy:other": "auto", "9002": "auto", "legacy:new": "auto"}
    assert sorted(f1.collect(), key=str) == sorted(f2.collect(), key=str) and sorted(s1.collect(), key=str) == sorted(s2.collect(), key=str)


def test_missing_week(spark):
    last = date(2026, 9, 17)
    f = fact(spark, *(row(i, week=date.fromordinal(last.toordinal() - d)) for i, d in enumerate((28, 21, 7, 0))))
    assert ids(calendar.missing_weeks(f), "expected") == [date(2026, 9, 3)]
    assert calendar.missing_weeks(f.limit(0)).count() == 0


def test_order_violation_skips_missing_gross(spark):
    f = fact(spark, *(row(i, f"t{i}", i, gross=g) for i, g in enumerate([1000, 900, 800, 50, 700, None, 600], 1)))
    assert ids(quality.order_violations(f)) == [5]
    assert ids(quality.anomalies(f)) == [5]


def test_batch_warnings(spark):
    f = fact(spark, row(1, "A", 1), row(2, "A", 1), row(3, "B", 2, total=1))
    w = quality.batch_warnings(f).first()
    assert (w["odd_size"], w["double_ranks"], w["double_titles"], w["low_totals"]) == (True, 1, 1, 1)


RUNS = "id long, pipeline_name string, started_at long, finished_at long, status string"
DAY = 86_400_000_000


@pytest.mark.parametrize(
    ("runs", "level"),
    [([], "FAIL"), ([(1, 1, 1, "success")], "OK"), ([(1, -19, -19, "success")], "FAIL"), ([(1, 1, 1, "success"), (2, 2, 2, "failed")], "FAIL"), ([(1, 1, 1, "success"), (2, 2, None, "running")], "WARN")],
)
def test_last_run(spark, runs, level):
    df = spark.createDataFrame([(i, "weekly_chart", s * DAY, f and f * DAY, st) for i, s, f, st in runs], RUNS)
    assert quality.last_run(df, F.lit(3 * DAY)).first()["level"] == level


def test_levels_of_an_empty_chart(spark):
    f = fact(spark)
    assert quality.latest_week_level(f, F.lit("2026-01-01").cast("date")).first()["level"] == "FAIL"
    assert quality.coverage_level(f).first()["level"] == "WARN"
    assert quality.gap_level(f).first()["level"] == "OK"


def test_relevant_lines(spark):
    log = spark.createDataFrame([(1, i, f"line {i}") for i in range(9)] + [(1, 20, " "), (2, 1, "ok"), (2, 2, "ValueError: x"), (2, 3, "end")], "log_id long, seq long, line string")
    got = quality.relevant_lines(log).collect()
    assert sorted(r["seq"] for r in got if r["log_id"] == 1) == [3, 4, 5, 6, 7, 8]
    assert [r["line"] for r in got if r["log_id"] == 2] == ["ValueError: x"]
    exits = spark.createDataFrame([(1, 0, 0), (2, 1, 2)], "log_id long, pipeline_exit long, health_exit long")
    assert [tuple(r) for r in quality.failure_reports(exits, log).collect()] == [(2, "pipeline: exit code 1; health check: exit code 2\nValueError: x")]


PAGE = """<html><body><h1>Classifica dal 2 febbraio 2024 al 8 febbraio 2024</h1>
<div><div><span>1</span><a href="/film/film-test/123/scheda/" title="Film Test"><img src="x"></a>
<p>Settimane: 4 Distribuzione: Warner
 Bros. Inc. weekend: &euro;1.234.567 Schermi: 600 Inc. totale: &euro;2.345.678</p></div></div>
<div><div><div><div><a href="/film/other/9/scheda/">no fields</a></div></div></div></div></body></html>"""


def test_chart_page(spark):
    df = spark.createDataFrame([(1, PAGE), (2, "<p>nothing"), (3, None)], "page_id long, html string")
    (r,) = pages.chart_pages(df, "https://charts.example").collect()
    assert (r["week_start"], r["rank"], r["title"], r["distributor"]) == (date(2024, 2, 2), 1, "Film Test", "Warner Bros.")
    assert (r["weekly_gross"], r["total_gross"], r["screen_count"], r["weeks_in_release"], r["source_movie_id"]) == (123456700, 234567800, 600, 4, "123")
    assert r["source_url"] == "https://charts.example/film/film-test/123/scheda/"
    assert pages.chart_pages(df, "", F.lit("2024-03-01").cast("date")).count() == 0


def test_catalogue_json(spark):
    answer = '{"results":[{"iso_3166_1":"IT","release_dates":[{"type":3,"release_date":"2026-07-16T00:00:00Z"},{"type":1,"release_date":"2026-05-10"},{"type":4,"release_date":"2026-01-01"},{"type":2,"release_date":"boh"}]},{"iso_3166_1":"US","release_dates":[{"type":3,"release_date":"2020-01-01"}]}]}'
    df = spark.createDataFrame([(answer, '{"titles":[{"title":"A"},{"title":""},{}]}'), (None, "{}")], "a string, t string")
    got = df.select(catalogue.release_dates(F.col("a"), "IT").alias("d"), catalogue.alternative_titles(F.col("t")).alias("t")).collect()
    assert [tuple(r) for r in got] == [([date(2026, 5, 10), date(2026, 7, 16)], ["A"]), ([], [])]


def test_two_pass(spark):
    titles = spark.createDataFrame([("The Odyssey", date(2026, 7, 16)), ("Odissea Finale", date(2026, 7, 16)), ("Nulla", None)], "title string, estimated date")
    movies = spark.createDataFrame([(42, "The Odyssey", "The Odyssey", date(2026, 7, 15), 300.0), (43, "Final Odyssey", "Finale", date(2026, 7, 15), 3.0)], "id long, title string, original_title string, release_date date, popularity double")
    names = spark.createDataFrame([(43, "Odissea Finale")], "id long, name string")
    dates = spark.createDataFrame([(42, [date(2026, 7, 16)])], "id long, dates array<date>")
    got = {r["title"]: (r["status"], r["movie_id"]) for r in matching.two_pass(titles, movies, names, dates).collect()}
    assert got["The Odyssey"] == ("auto", 42) and got["Nulla"] == ("no_match", None)
    assert got["Odissea Finale"][0] in ("auto", "needs_review")


def test_equal_homonyms_go_to_review(spark):
    titles = spark.createDataFrame([("Solo", date(2026, 7, 16))], "title string, estimated date")
    movies = spark.createDataFrame([(i, "Solo", "Solo", date(2026, 7, 15), 3.0) for i in (1, 2)], "id long, title string, original_title string, release_date date, popularity double")
    none = spark.createDataFrame([], "id long, name string")
    dates = spark.createDataFrame([(2, [date(2026, 7, 16)])], "id long, dates array<date>")
    assert matching.two_pass(titles, movies, none, dates.limit(0)).first()["status"] == "needs_review"


GOOD = {
    "generated_at": "2026-09-21T10:00:00+00:00", "source": "box", "territory": "IT", "currency": "EUR", "latest_week": "2026-09-17", "has_quality_warnings": False, "note": "n",
    "weekly_trend": [{"week_start": "2026-09-17", "total_gross": 1, "titles": 2}], "top_titles": [{"rank": 1, "title": "A", "weekly_gross": 1, "screen_count": None}],
}


@pytest.mark.parametrize(("change", "n"), [({}, 0), ({"source": ""}, 1), ({"has_quality_warnings": 1}, 1), ({"latest_week": "x"}, 1), ({"weekly_trend": []}, 1), ({"top_titles": [{"rank": 1}]}, 1)])
def test_payload_contract(change, n):
    assert len(export.payload_problems(GOOD | change)) == n


def test_payload(spark):
    f = fact(spark, row(1), row(2, "B", 2))
    report = spark.createDataFrame([(1, "gaps", "WARN")], "seq long, name string, level string")
    document = export.payload(f, report, "IT", "2026-09-21T10:00:00+00:00", "n")
    assert export.payload_problems(document) == [] and document["has_quality_warnings"] and document["latest_week"] == "2026-09-17"
    with pytest.raises(SystemExit):
        export.payload(f, report.withColumn("level", F.lit("FAIL")), "IT", "", "")


def test_store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    new = fact(spark, row(1), row(2, "B", 2))
    change = lambda records: {"fact": records}
    assert store.load("weekly_chart", new, change, dry_run=True) == 0 and store.version("fact") is None
    assert store.load("weekly_chart", new, change) == 2
    check = lambda t: t["fact"].filter("rank <= 0").groupBy(F.lit("rank").alias("name")).agg(F.count("*").alias("n"))
    with pytest.raises(ValueError, match="rank: 1"):
        store.load("weekly_chart", fact(spark, row(3, "C", 0)), change, check)
    assert ids(store.read("fact")) == [1, 2]
    assert sorted((r["status"], r["records_written"]) for r in store.runs().collect()) == [("failed", 0), ("success", 2)]


def test_stream(spark, tmp_path):
    store, source = Store(spark, str(tmp_path / "store")), str(tmp_path / "in")
    for batch in ([row(1), row(2, "B", 2)], [row(3, "A", 5), row(4, "C", 3)]):
        fact(spark, *batch).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(FACT).parquet(source)
        merge_stream(stream, store, str(tmp_path / "checkpoint")).awaitTermination(60)
    assert sorted((r["id"], r["rank"]) for r in store.read("fact").collect()) == [(1, 5), (2, 2), (4, 3)]


def test_health_of_each_chart(spark):
    """A thin chart among full ones warns, an old one fails; the last run can be asked for one source."""
    rows = [("box", "IT", "2024-02-01", i) for i in range(12)] + [("box", "FR", "2024-02-01", i) for i in range(3)] + [("box", "DE", "2024-01-01", i) for i in range(12)]
    table = spark.createDataFrame(rows, "source_name string, territory string, day string, id long").withColumn("week_start", F.to_date("day"))
    found = quality.latest_week_levels(table, F.lit("2024-02-05").cast("date"))
    assert {r["territory"]: r["level"] for r in found.collect()} == {"IT": "OK", "FR": "WARN", "DE": "FAIL"}
    assert quality.latest_week_level(table, F.lit("2024-02-05").cast("date"), territory="FR").first()["level"] == "WARN"
    assert quality.worst(found).first()[0] == "FAIL" and quality.worst(found.limit(0)).first()[0] == "FAIL"
    day = 86_400_000_000
    runs = spark.createDataFrame([(1, "weekly_chart", "box", 0, day, "success"), (2, "weekly_chart", "other", 0, day, "failed")], "id long, pipeline_name string, source_name string, started_at long, finished_at long, status string")
    assert [quality.last_run(runs, F.lit(2 * day), source=s).first()["level"] for s in ("box", "other", None)] == ["OK", "FAIL", "FAIL"]


def test_null_keys_meet_again(spark):
    old = spark.createDataFrame([("a", None, 1)], "source_name string, territory string, n long")
    new = spark.createDataFrame([("a", None, 2)], "source_name string, territory string, n long")
    assert [tuple(r) for r in merge.upsert(old, new, ("source_name", "territory"), ("n",)).collect()] == [("a", None, 2)]


def test_backup_and_stale_versions(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    store.publish({"t": store.stage("t", spark.range(3))})
    for stamp in ("1", "2", "3", "4"):
        left = store.backup(str(tmp_path / "copies"), stamp, keep=2)
    assert left == ["3", "4"] and spark.read.parquet(str(tmp_path / "copies" / "4" / "t")).count() == 3
    with pytest.raises(ValueError, match="changed"):
        store.publish({"t": store.stage("t", spark.range(4))}, {"t": "another"})
    assert store.read("t").count() == 3


def test_latest_week_of_each_chart(spark):
    old, new = date(2026, 9, 10), date(2026, 9, 17)
    rows = [row(1, rank=1, week=old, movie=1), row(2, rank=2, week=new, movie=2), row(3, rank=2, week=new), row(4, rank=1, week=new), row(5, week=None, movie=5), row(6, week=old, movie=6, territory="FR")]
    f = fact(spark, *rows, row(7, week=None, territory="DE"))  # a chart without a week has no latest one
    assert ids(R.top_titles(f, 2)) == [2, 4, 6]
    assert {(r["territory"], r["week_start"], r["titles"]) for r in R.latest_week_status(f).collect()} == {("IT", new, 3), ("FR", old, 1)}
    assert {(r["territory"], r["with_movie"], r["titles"]) for r in R.movie_id_coverage(f).collect()} == {("IT", 1, 3), ("FR", 1, 1)}
    none = quality.coverage_level(f.limit(0)).first()
    assert (none["with_movie"], none["titles"], none["level"]) == (0, 0, "WARN")


def test_entries_look_outwards_only_as_far_as_needed():
    fields = "Settimane: 2 Distribuzione: D Inc. weekend: € 1.000 Schermi: 7 Inc. totale: € 2.000"
    near = f'<div><b>3</b><div><a href="/film/x/9/scheda/" title="T">x</a> {fields}</div></div>'  # the rank is the first number around, so that of the fields
    assert [e[1] for e in pages.entries(near)[1]] == [2]
    far = f'<div>{fields}<p><i><a href="/film/x/9/scheda/">T</a></i></p></div>'
    assert [(e[1], e[2], e[3]) for e in pages.entries(far)[1]] == [(2, "T", "9")]
    assert pages.entries(f"{fields}<div>{'<i>' * 3}<a href='/film/x/9/scheda/'>T</a></div>")[1] == []
