"""One query for each operator, over the tables of the chart dataset."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scores as S
from ..functions import text as T
from ..operators import calendar as C
from ..operators import matching, merge
from ..operators import quality as Q
from ..operators import relational as R
from ..sources import catalogue, dataset, pages
from ..sources.dataset import fact, films, movies, runs, table
from . import export

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

BASE_URL = "https://charts.example/weekly"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def n(c: str, as_: str | None = None) -> F.Column:
    return F.col(c).cast("long").alias(as_ or c)


def parts(spark: SparkSession, d: str) -> int:
    """Parts for later steps over the whole fact, as many as it is made in."""
    return dataset.tasks(spark, table(spark, d, "lineitem").count())


def as_of_day(f: DataFrame, days: int = 9) -> F.Column:
    """A fixed number of days after the last week, in place of today."""
    return F.date_add(f.agg(F.max("week_start")).scalar(), days)


def as_of_run(r: DataFrame) -> F.Column:
    return F.coalesce(r.agg(F.max("started_at")).scalar(), F.lit(0)) + 3 * 86_400_000_000


# -- aggregates, windows, top-k ------------------------------------------------------------------


@query
def weekly_trend(spark, d):
    return R.weekly_trend(fact(spark, d)).select("territory", "week_start", "total_gross", "titles")


@query
def latest_week(spark, d):
    return R.latest_week(fact(spark, d)).select("territory", "week_start")


@query
def latest_week_status(spark, d):
    return R.latest_week_status(fact(spark, d)).select("territory", "week_start", "titles")


@query
def movie_id_coverage(spark, d):
    return R.movie_id_coverage(fact(spark, d)).select("territory", "with_movie", "titles")


@query
def top_titles(spark, d):
    return R.top_titles(fact(spark, d)).select("territory", "rank", "title", "weekly_gross", "screen_count")


@query
def sample_latest(spark, d):
    return R.sample_latest(fact(spark, d)).select("id", "territory", "week_start", "rank", "title")


@query
def match_queue(spark, d):
    return R.status_counts(films(spark, d), ("unmatched", "needs_review"))


@query
def match_status_counts(spark, d):
    return R.status_counts(films(spark, d))


@query
def ambiguous_titles(spark, d):
    return R.ambiguous_titles(fact(spark, d))


@query
def adoptable_matches(spark, d):
    return merge.adoptable(fact(spark, d), parts(spark, d))


@query
def legacy_titles(spark, d):
    return merge.legacy_titles(fact(spark, d))


@query
def duplicate_keys(spark, d):
    return R.duplicate_keys(fact(spark, d)).select("territory", "week_start", "title_key", "n")


@query
def unlinked_rows(spark, d):
    return R.unlinked_rows(fact(spark, d))


@query
def first_real_per_title(spark, d):
    return R.first_real(films(spark, d)).select("id", "title_key")


@query
def dedupe_week_title(spark, d):
    return R.dedupe(fact(spark, d), parts(spark, d)).select("id", "territory", "week_start", "title_key", "rank")


@query
def merge_duplicates(spark, d):
    return R.merge_duplicates(fact(spark, d)).select("id", "territory", "week_start", "title_key", "movie_id", "source_movie_ref")


@query
def rank_candidates(spark, d):
    return R.rank_candidates(dataset.candidates(spark, d)).select("source_movie_id", "movie_id", "score", "place")


@query
def first_seen_distinct(spark, d):
    return R.first_seen(fact(spark, d), "movie_id", "id")


@query
def retention_prune(spark, d):
    e = table(spark, d, "events")
    backups = e.select(F.col("user_id").alias("group"), F.concat(F.lit("backup-"), F.col("event_id").cast("string")).alias("path"), F.unix_micros(F.col("ts").cast("timestamp")).alias("mtime"))
    last = backups.agg(F.max("mtime")).scalar()
    return R.prune(backups, 3, last - 10 * 86_400_000_000).select("group", "path")


@query
def top_revenue_paged(spark, d):
    return R.paged(movies(spark, d), "revenue", "id", pages=5, size=4).select("id", "revenue", "page")


# -- joins ---------------------------------------------------------------------------------------


@query
def weekly_enriched(spark, d):
    rows = R.weekly_enriched(fact(spark, d), films(spark, d), movies(spark, d))
    return rows.select("id", "territory", "week_start", "rank", "title", "weekly_gross", "screen_count", "gross_per_screen", "match_status", "movie_title", "release_date")


@query
def gross_per_screen(spark, d):
    return fact(spark, d).select("id", R.gross_per_screen(F.col("weekly_gross"), F.col("screen_count")).alias("gross_per_screen"))


@query
def movie_id_inconsistent(spark, d):
    return R.inconsistent_links(fact(spark, d), films(spark, d)).select("id", "movie_id", "film_movie_id")


@query
def first_week_per_title(spark, d):
    return R.first_weeks(films(spark, d), fact(spark, d)).select("id", "first_week", "first_weeks_in_release")


@query
def pending_matches(spark, d):
    rows = R.pending_matches(films(spark, d), fact(spark, d), ("unmatched", "no_match"))
    return rows.select("id", "match_status", "first_week", "first_weeks_in_release")


@query
def legacy_pairs(spark, d):
    return merge.legacy_pairs(films(spark, d)).select("legacy_id", "real_id", "title_key")


@query
def legacy_orphans(spark, d):
    return merge.legacy_orphans(films(spark, d), fact(spark, d)).select("id", "source_movie_id")


@query
def review_queue(spark, d):
    rows = R.review_queue(films(spark, d), dataset.candidates(spark, d))
    return rows.select("id", "title", F.array_join(F.transform("movie_ids", lambda x: x.cast("string")), ",").alias("movie_ids"))


@query
def snapshot_list(spark, d):
    return dataset.archive_index(spark, d).filter("status = 200").select("timestamp").distinct()


@query
def snapshot_candidates(spark, d):
    return C.candidate_snapshots(_recent_weeks(spark), dataset.archive_index(spark, d)).select("week_start", "trial", "timestamp")


def _recent_weeks(spark: SparkSession) -> DataFrame:
    return spark.range(6).select(F.date_add(F.lit("2023-12-28").cast("date"), (7 * F.col("id")).cast("int")).alias("week_start"))


@query
def recover_week(spark, d):
    trials = C.candidate_snapshots(_recent_weeks(spark), dataset.archive_index(spark, d))
    stored = dataset.archive_index(spark, d).filter("status = 200").select("timestamp").distinct()
    day = F.to_date(F.substring("timestamp", 1, 8), "yyyyMMdd")
    hour = F.substring("timestamp", 9, 2).cast("int")
    held = stored.select("timestamp", F.when(hour % 3 == 0, dataset.chart_week(day)).otherwise(F.date_sub(dataset.chart_week(day), 7)).alias("page_week"), (hour + 2).cast("long").alias("titles"))
    return C.recovered(trials, held)


# -- calendar ------------------------------------------------------------------------------------


@query
def missing_weeks(spark, d):
    thin = fact(spark, d).filter(F.date_diff("week_start", F.lit("1994-01-06").cast("date")) / 7 % 4 != 0)
    return C.missing_weeks(thin, weeks=400).select("territory", "expected")


@query
def backfill_weeks(spark, d):
    return C.backfill(F.lit("2000-06-29").cast("date"), 30, fact(spark, d)).select("territory", "week_start", "week_end", "titles")


# -- checks --------------------------------------------------------------------------------------


@query
def anomalies(spark, d):
    return Q.anomalies(fact(spark, d), 60).select("id", "territory", "week_start", "rank", "weekly_gross", "above", "total_gross")


@query
def validate_order(spark, d):
    return Q.order_violations(fact(spark, d)).select("id", "weekly_gross", "above")


@query
def validate_batch(spark, d):
    return Q.batch_warnings(fact(spark, d)).select("territory", "week_start", "titles", "odd_size", "double_ranks", "double_titles", "low_totals", "disordered")


@query
def constraint_violations(spark, d):
    return Q.violations(fact(spark, d), films(spark, d), movies(spark, d))


@query
def quarantine_split(spark, d):
    return Q.quarantine(fact(spark, d)).select("id", "reason")


@query
def last_success_age(spark, d):
    r = runs(spark, d)
    return Q.last_run(r, as_of_run(r)).select(F.round(F.col("age_days"), 6).alias("age_days"))


@query
def health_last_run(spark, d):
    r = runs(spark, d)
    return Q.last_run(r, as_of_run(r)).select("status", "level")


@query
def health_latest_week(spark, d):
    f = fact(spark, d)
    return Q.latest_week_levels(f, as_of_day(f)).drop("source_name")


@query
def health_gaps(spark, d):
    return Q.gap_level(fact(spark, d))


@query
def health_integrity(spark, d):
    return Q.integrity(fact(spark, d), films(spark, d))


@query
def health_coverage(spark, d):
    return Q.coverage_level(fact(spark, d))


@query
def health_report(spark, d):
    f, r = fact(spark, d), runs(spark, d)
    return Q.health_report(f, films(spark, d), r, as_of_run(r), as_of_day(f))


@query
def health_details(spark, d):
    f, r = fact(spark, d), runs(spark, d)
    return Q.health_details(f, films(spark, d), r, as_of_run(r), as_of_day(f))


@query
def export_gate(spark, d):
    return Q.gate(health_report(spark, d))


# -- mutations -----------------------------------------------------------------------------------


def _batch(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """What the fact held before, and a batch that revises some of it and adds the rest."""
    rows = R.dedupe(fact(spark, d), parts(spark, d))
    old = rows.filter("id % 3 <> 0")
    new = rows.filter("id % 3 <> 1").withColumn("weekly_gross", F.col("weekly_gross") + 1).withColumn("movie_id", F.when(F.col("id") % 2 == 0, F.col("movie_id")))
    return old, new


@query
def upsert_weekly(spark, d):
    old, new = _batch(spark, d)
    return merge.upsert_chart(old, new).select("id", "territory", "week_start", "title_key", "rank", "weekly_gross", "movie_id", "source_movie_ref")


def _loaded(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A batch of known films, renamed ones, new ones, and records without film, some with the movie id 0, by the second run."""
    old, new = _batch(spark, d)
    old = old.withColumn("ingestion_run_id", F.lit(1).cast("long")).withColumn("created_at", F.lit(100).cast("long")).withColumn("updated_at", F.lit(100).cast("long"))
    new = new.withColumn("movie_id", F.when(F.col("id") % 7 == 0, F.lit(0).cast("long")).otherwise(F.col("movie_id")))
    known = _film_state(spark, d).filter("id % 4 <> 1")
    records = new.withColumn("source_movie_id", F.col("source_movie_ref").cast("string")).withColumn("source_url", F.lit("/film"))
    return merge.load_batch(old, known, records, run_id=2, at=200)


@query
def load_batch(spark, d):
    rows, _, _ = _loaded(spark, d)
    return rows.select("id", "territory", "week_start", "title_key", "weekly_gross", "movie_id", "source_movie_ref", "ingestion_run_id", "created_at", "updated_at")


@query
def load_count(spark, d):
    return _loaded(spark, d)[2]


def _film_state(spark: SparkSession, d: str) -> DataFrame:
    return films(spark, d).withColumn("source_movie_id", F.col("id").cast("string")).withColumn("source_url", F.when(F.col("id") % 2 == 0, F.concat(F.lit("/film/"), F.col("id").cast("string"))))


@query
def upsert_source(spark, d):
    state = _film_state(spark, d)
    again = state.filter("id % 5 < 3").withColumn("title", F.upper("title")).withColumn("source_url", F.when(F.col("id") % 3 == 0, F.lit("/new"))).withColumn("match_status", F.lit("unmatched"))
    batch = again.withColumn("seq", F.lit(1)).unionByName(again.withColumn("title", F.lit("later")).withColumn("seq", F.lit(2)))
    return merge.upsert_films(state.filter("id % 5 > 0"), batch).select("source_movie_id", "title", "source_url", "match_status")


@query
def upsert_movies(spark, d):
    m = movies(spark, d)
    return merge.upsert_movies(m.filter("id % 3 > 0"), m.filter("id % 3 < 2").withColumn("popularity", F.col("popularity") + 1)).select("id", "title", "popularity")


@query
def insert_absent(spark, d):
    m = movies(spark, d)
    return merge.insert_absent(m.filter("id % 3 > 0"), m.withColumn("popularity", F.lit(0.0)), ("id",)).select("id", "popularity")


@query
def replace_candidates(spark, d):
    c = dataset.candidates(spark, d).select("source_movie_id", "movie_id", "score")
    parents = c.filter("source_movie_id % 4 < 2").select("source_movie_id")  # those with the remainder 1 get none
    return merge.replace_children(c, c.filter("source_movie_id % 4 = 0").withColumn("score", F.col("score") + 1), "source_movie_id", parents)


@query
def propagate_match(spark, d):
    return merge.propagate_match(fact(spark, d), films(spark, d), parts(spark, d)).select("id", "movie_id", "changed")


@query
def manual_override(spark, d):
    decisions = films(spark, d).filter("id % 10 = 3").select("id", F.when(F.col("id") % 4 == 3, F.col("id") + 1).alias("movie_id"))
    return merge.manual_override(films(spark, d), decisions).select("id", "movie_id", "match_status", "match_method", "match_confidence")


@query
def legacy_link_result(spark, d):
    rows, _ = merge.link_legacy(fact(spark, d), films(spark, d), parts(spark, d))
    return rows.select("id", "source_movie_ref", "movie_id")


@query
def legacy_link_films(spark, d):
    _, state = merge.link_legacy(fact(spark, d), films(spark, d), parts(spark, d))
    return state.select("id", "source_movie_id", "movie_id", "match_status", "match_method")


@query
def legacy_link_counts(spark, d):
    rows, f, k = fact(spark, d), films(spark, d), parts(spark, d)
    after, state = merge.link_legacy(rows.withColumns({"was": F.col("source_movie_ref"), "had": F.col("movie_id")}), f, k)  # what a row had goes with it
    of_rows = after.agg(
        F.count_if(F.col("was").isNull()).alias("linked"), F.count_if(F.col("was").isNotNull() & (F.col("was") != F.col("source_movie_ref"))).alias("promoted"),
        F.count_if(~F.col("had").eqNullSafe(F.col("movie_id"))).alias("synced"),
    )
    legacy = F.col("source_movie_id").startswith("legacy:")
    held = state.select(F.col("id").alias("source_movie_ref"), legacy.alias("to_legacy"))
    by_film = after.filter("was is null").groupBy("source_movie_ref").agg(F.count("*").alias("rows"))
    linked = R.dealt(by_film, k, "source_movie_ref").join(held, "source_movie_ref")
    of_links = linked.agg(*[F.coalesce(F.sum(F.when(c, F.col("rows"))), F.lit(0)).alias(name) for name, c in (("linked_to_real", ~F.col("to_legacy")), ("linked_to_legacy", F.col("to_legacy")))])
    old = R.dealt(f.select(F.col("id").alias("old_id"), F.col("match_method").alias("old_method")), k, "old_id")
    both = old.join(state.select("id", "match_method"), F.col("old_id") == F.col("id"), "full_outer")
    adopted = (F.col("match_method") == "legacy_exact_title") & ~F.col("old_method").eqNullSafe(F.lit("legacy_exact_title"))
    of_films = both.agg(F.count_if(F.col("old_id").isNull()).alias("legacy_created"), F.count_if(F.col("id").isNull()).alias("legacy_removed"), F.count_if(adopted).alias("adopted"))
    counts = of_rows.unionByName(of_links, allowMissingColumns=True).unionByName(of_films, allowMissingColumns=True)
    return counts.agg(*[F.sum(c).alias(c) for c in counts.columns])


# -- records and pages ---------------------------------------------------------------------------


@query
def normalize_records(spark, d):
    records = fact(spark, d).drop("territory").withColumn("source_name", F.lit("other"))
    return catalogue.normalise_records(records, "box").select("id", "source_name", "territory", "title", "title_key")


@query
def title_key(spark, d):
    return films(spark, d).select("id", T.title_key(F.when(F.col("id") % 9 != 0, F.col("title"))).alias("title_key"))


@query
def genres_join(spark, d):
    genres = F.array(F.struct(F.col("p_type").alias("name")), F.struct(F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("name")))
    return table(spark, d, "part").select("p_partkey", catalogue.joined_genres(genres).alias("genres"))


@query
def normalize_movie(spark, d):
    m = movies(spark, d)
    answers = m.select("id", "title", F.when(F.col("id") % 3 == 0, "").otherwise(F.date_format("release_date", "yyyy-MM-dd")).alias("release_date"), F.when(F.col("id") % 2 == 0, F.col("revenue")).alias("revenue"), F.lit(None).cast("long").alias("budget"), "popularity")
    return catalogue.normalise_movie(answers)


@query
def archive_urls(spark, d):
    days = fact(spark, d).select("week_start").distinct()
    return days.select("week_start", F.posexplode(T.archive_urls(BASE_URL, F.col("week_start"))).alias("priority", "url")).select("week_start", n("priority"), "url")


@query
def release_dates_json(spark, d):
    m = movies(spark, d)
    entry = lambda kind, add: F.struct((F.col("id") % kind + 1).cast("int").alias("type"), F.concat(F.date_format(F.date_add("release_date", add), "yyyy-MM-dd"), F.lit("T00:00:00.000Z")).alias("release_date"))
    answer = F.to_json(F.struct(F.array(F.struct(F.lit("IT").alias("iso_3166_1"), F.array(entry(5, 9), entry(2, 0)).alias("release_dates")), F.struct(F.lit("US").alias("iso_3166_1"), F.array(entry(2, 3)).alias("release_dates"))).alias("results")))
    dates = catalogue.release_dates(answer, "IT")
    return m.select("id", F.array_join(F.transform(dates, lambda x: F.date_format(x, "yyyy-MM-dd")), ",").alias("dates"))


@query
def raw_snapshot_digest(spark, d):
    return pages.snapshots(table(spark, d, "pages"))


@query
def page_links(spark, d):
    return pages.page_links(table(spark, d, "pages"))


def chart_html(spark: SparkSession, d: str) -> DataFrame:
    """Pages of the site's form for each territory and week, made of the fact's rows with a gross. A page has
    ranks of two digits, so a longer chart goes on at rank 1 of the next page."""
    euro = lambda c: F.replace(F.format_number((F.col(c) / 100).cast("long"), 0), F.lit(","), F.lit("."))
    f = fact(spark, d).filter("weekly_gross is not null").withColumn("part", F.floor((F.col("rank") - 1) / 99)).withColumn("rank", (F.col("rank") - 1) % 99 + 1)
    month = F.element_at(F.array(*map(F.lit, T.MONTHS)), F.month("week_end"))
    row = F.concat(F.lit("<div><span>"), F.col("rank").cast("string"), F.lit('</span><a href="/film/x/'), F.floor(F.col("id") / 10000).cast("string"), F.lit('/scheda/" title="'), F.col("title"), F.lit('">x</a><p>Settimane: '), F.col("weeks_in_release").cast("string"), F.lit(" Distribuzione: "), F.col("distributor"), F.lit(" Inc. weekend: &euro; "), euro("weekly_gross"), F.lit(" Schermi: "), F.col("screen_count").cast("string"), F.lit(" Inc. totale: &euro; "), euro("total_gross"), F.lit("</p></div>"))
    head = F.concat(F.lit("<html><body><h1>dal "), F.dayofmonth("week_start").cast("string"), F.lit(" "), F.element_at(F.array(*map(F.lit, T.MONTHS)), F.month("week_start")), F.lit(" "), F.year("week_start").cast("string"), F.lit(" al "), F.dayofmonth("week_end").cast("string"), F.lit(" "), month, F.lit(" "), F.year("week_end").cast("string"), F.lit("</h1>"))
    page = ("territory", "week_start", "week_end", "part")
    bodies = f.repartition(parts(spark, d), *page).groupBy(*page).agg(F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("rank", row.alias("row")))), lambda x: x["row"])).alias("body"))
    return bodies.select(F.xxhash64("territory", "week_start", "part").alias("page_id"), "territory", "part", F.col("week_start").alias("page_week"), F.concat(head, "body", F.lit("</body></html>")).alias("html"))


@query
def parse_chart_pages(spark, d):
    rows = pages.chart_pages(chart_html(spark, d).select("page_id", "territory", "page_week", "html"), "https://charts.example", F.col("page_week"))
    return rows.select("territory", "week_start", "week_end", "rank", "title", "distributor", "weekly_gross", "total_gross", "screen_count", "weeks_in_release", "source_movie_id", "source_url")


@query
def refused_pages(spark, d):
    """Pages of the chart that are asked for by the right day, by one of another week, and without their week."""
    made = chart_html(spark, d)
    k = F.dayofyear("page_week") % 4
    html = F.when(k == 1, F.replace("html", F.lit("<h1>dal "), F.lit("<h1>"))).when(k == 2, F.replace("html", F.lit("/film/"), F.lit("/other/"))).otherwise(F.col("html"))
    asked = F.when(k != 3, F.col("page_week")).otherwise(F.date_add("page_week", 30))
    refused = pages.dead_letters(made.withColumn("html", html).withColumn("asked", asked), F.col("asked"))
    return refused.select("territory", "page_week", F.col("part").cast("long").alias("part"), "reason")


@query
def first_page(spark, d):
    made = chart_html(spark, d)
    tried = made.select(F.concat_ws("/", "territory", F.year("page_week")).alias("request"), F.dayofyear("page_week").alias("priority"), "page_id", "page_week", "html")
    return pages.first_page(tried).select("request", "page_week")


@query
def parse_euro(spark, d):
    amounts = fact(spark, d).select("id", F.concat(F.lit("€ "), F.replace(F.format_number(F.col("total_gross") % 10_000_000, 0), F.lit(","), F.lit(".")), F.lit(","), F.lpad((F.col("id") % 100).cast("string"), 2, "0")).alias("text"))
    return amounts.select("id", T.parse_euro(F.col("text")).alias("cents"))


@query
def parse_int(spark, d):
    return fact(spark, d).select("id", T.parse_int(F.replace(F.format_number("total_gross", 0), F.lit(","), F.lit("."))).alias("value"))


def _spelt(c: str) -> F.Column:
    return F.element_at(F.array(*map(F.lit, T.MONTHS)), F.month(c))


@query
def parse_it_date(spark, d):
    days = fact(spark, d).select("week_start").distinct()
    return days.select("week_start", T.parse_date(F.dayofmonth("week_start").cast("string"), F.upper(_spelt("week_start")), F.year("week_start").cast("string")).alias("parsed"))


@query
def week_range(spark, d):
    days = fact(spark, d).select("week_start", "week_end").distinct()
    day = lambda c: F.dayofmonth(c).cast("string")
    year = lambda c: F.year(c).cast("string")
    same = F.concat_ws(" ", F.lit("dal"), day("week_start"), F.lit("al"), day("week_end"), _spelt("week_end"), year("week_end"))
    one = F.concat_ws(" ", F.lit("Classifica DAL"), day("week_start"), _spelt("week_start"), F.lit("al"), day("week_end"), _spelt("week_end"), year("week_end"))
    both = F.concat_ws(" ", F.lit("dal"), day("week_start"), _spelt("week_start"), year("week_start"), F.lit("al"), day("week_end"), _spelt("week_end"), year("week_end"))
    text = F.when(F.month("week_start") == F.month("week_end"), same).when(F.year("week_start") == F.year("week_end"), one).otherwise(both)
    return days.select("week_start", T.week_range(text).alias("r")).select("week_start", F.col("r.week_start").alias("parsed_start"), F.col("r.week_end").alias("parsed_end"))


def log_lines(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("Error: "), "props")).when(F.col("event_type") == "signup", " ").otherwise(F.concat(F.lit("step "), "event_type"))
    return e.select(F.col("user_id").alias("log_id"), F.col("event_id").alias("seq"), text.alias("line"))


@query
def relevant_log_lines(spark, d):
    return Q.relevant_lines(log_lines(spark, d))


@query
def failure_report(spark, d):
    exits = table(spark, d, "events").select(F.col("user_id").alias("log_id")).distinct().select("log_id", (F.col("log_id") % 3).alias("pipeline_exit"), (F.col("log_id") % 2).alias("health_exit"))
    return Q.failure_reports(exits, log_lines(spark, d))


@query
def site_payload(spark, d):
    return export.payload_rows(fact(spark, d)).select("territory", F.sha2("document", 256).alias("document_sha256"), F.length("document").alias("n_chars"))


@query
def payload_problems(spark, d):
    """The documents before they get their time, note and warnings, which is what is wrong with them."""
    return export.problem_rows(export.payload_rows(fact(spark, d)))


# -- matching ------------------------------------------------------------------------------------


@query
def normalize_title(spark, d):
    return films(spark, d).select("id", T.normalise_title("title").alias("normalised"))


@query
def strip_articles(spark, d):
    return movies(spark, d).select("id", T.without_articles(F.lower(F.concat(F.when(F.col("id") % 2 == 0, "il the ").otherwise(""), "original_title"))).alias("bare"))


@query
def query_variants(spark, d):
    named = films(spark, d).select("id", F.concat(F.when(F.col("id") % 4 == 0, "...").otherwise(""), "title", F.when(F.col("id") % 3 == 0, " - part two").when(F.col("id") % 3 == 1, ": a story").otherwise("")).alias("title"))
    return named.select("id", F.array_join(T.query_variants(F.col("title")), "|").alias("variants"))


@query
def estimated_release(spark, d):
    return fact(spark, d).select("id", S.estimated_release(F.col("week_start"), F.when(F.col("id") % 7 != 0, F.col("weeks_in_release"))).alias("estimated"))


@query
def date_score(spark, d):
    rows = R.weekly_enriched(fact(spark, d), films(spark, d), movies(spark, d))
    return rows.select("id", F.round(S.date_score(F.col("week_start"), F.col("release_date")), 9).alias("score"))


@query
def local_release_score(spark, d):
    m = movies(spark, d)
    estimated = F.when(F.col("id") % 5 != 0, F.date_add("release_date", (F.col("id") % 70).cast("int")))
    dates = F.array("release_date", F.date_add("release_date", 21))
    return m.select("id", F.round(S.local_release_score(estimated, dates), 9).alias("score"))


@query
def popularity_score(spark, d):
    return table(spark, d, "part").select("p_partkey", F.round(S.popularity_score(F.col("p_retailprice") - 910), 9).alias("score"))


@query
def match_decision(spark, d):
    return matching.decide(R.rank_candidates(dataset.candidates(spark, d))).select("source_movie_id", "status")


@query
def match_summary(spark, d):
    return matching.summary(match_decision(spark, d))


def _titles(spark: SparkSession, d: str) -> DataFrame:
    f = films(spark, d).select("id", F.concat("title", F.when(F.col("id") % 5 == 1, " - the return").otherwise("")).alias("title"))
    first = fact(spark, d).groupBy(F.col("source_movie_ref").alias("id")).agg(F.min("week_start").alias("estimated"))
    return f.join(first, "id").groupBy("title").agg(F.min("estimated").alias("estimated"))


def _found(spark: SparkSession, d: str) -> DataFrame:
    """Titles with the films that a search finds, once for each title."""
    t = _titles(spark, d)
    return matching.search(t, movies(spark, d)).join(t, "title").withColumn("ref", F.col("title"))


@query
def title_similarity(spark, d):
    """The similarity wherever the forms of two names decide it, and how many of the other pairs a bound rules out."""
    named = movies(spark, d).select("id", F.col("title").alias("movie_title"))
    pairs = _found(spark, d).join(named, "id").withColumn("a", T.normalise_title("title")).withColumn("b", T.normalise_title("movie_title"))
    pairs = pairs.select("title", "movie_title", T.title_forms(F.col("a")).alias("a"), T.title_forms(F.col("b")).alias("b"))
    least, most = T.similarity_bounds(F.col("a"), F.col("b"))
    score = F.when(least == most, F.round(least, 9))
    return pairs.select("title", "movie_title", score.alias("score"), F.round(least, 9).alias("least"), F.round(most, 9).alias("most"))


@query
def match_search(spark, d):
    return matching.sharing(_titles(spark, d), movies(spark, d)).select("title", "id", n("variant"))


@query
def score_candidates(spark, d):
    return matching.scored(_found(spark, d), movies(spark, d)).select("title", "id", "title_score", "date_score", "score")


@query
def score_parts(spark, d):
    """What SQL can check of a candidate's score: the date and popularity parts, and the title's where it is not a ratio."""
    rows = matching.scored(_found(spark, d), movies(spark, d))
    rows = rows.withColumn("tier", F.when(F.col("title_part").isin(1.0, T.SAME_BUT_ARTICLES), F.col("title_part")))
    exact = F.when(F.col("tier").isNotNull(), S.total_score(F.col("tier"), F.col("date_part"), F.col("popularity_part")))
    return rows.select("title", "id", "tier", F.round("date_part", 9).alias("date_part"), F.round("popularity_part", 9).alias("popularity_part"), F.round(exact, 9).alias("exact_score"))


def _local(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The catalogue, other names of some of its films, and own dates of some."""
    m = movies(spark, d)
    alternatives = m.filter("id % 2 = 0").select("id", F.concat("title", F.lit(" - the return")).alias("name"))
    return m, alternatives, m.filter("id % 3 = 0").select("id", F.array("release_date", F.date_add("release_date", 30)).alias("dates"))


@query
def match_two_pass(spark, d):
    return matching.two_pass(_titles(spark, d), *_local(spark, d))


def _resolution(spark: SparkSession, d: str) -> tuple[DataFrame, ...]:
    """What decisions about the films that wait for one change: some have no title, and some no candidates."""
    f, m, stored = films(spark, d), movies(spark, d), dataset.candidates(spark, d)
    waiting = R.pending_matches(f, fact(spark, d), ("unmatched", "needs_review")).select(F.col("id").alias("ref"), F.when(F.col("id") % 13 != 0, F.col("title")).alias("title"))
    fresh = stored.filter("seq < 2").withColumn("score", 300 + F.col("score") * 7 % 700)
    fresh = R.rank_candidates(fresh)
    best = matching.decide(fresh).select(F.col("source_movie_id").alias("ref"), "movie_id", F.col("best").alias("score"), "status")
    rows = waiting.join(best, "ref", "left").withColumn("error", F.when(F.col("title").isNull(), "the film has no title"))
    known = F.col("error").isNull()
    status = F.when(known, F.coalesce("status", F.lit("no_match")))
    decisions = rows.select("ref", status.alias("status"), F.when(status == "auto", F.col("movie_id")).alias("movie_id"), F.when(known, F.col("score")).alias("score"), "error")
    details = m.select((F.col("id") * 10).alias("id"), *[c for c in m.columns if c != "id"])
    return (*matching.persist(f, fact(spark, d), m, stored, fresh, decisions, details), matching.resolved(decisions))


@query
def resolve_films(spark, d):
    return _resolution(spark, d)[0].select("id", "movie_id", "match_status", "match_method", "match_confidence")


@query
def resolve_rows(spark, d):
    return _resolution(spark, d)[1].select("id", "movie_id")


@query
def resolve_movies(spark, d):
    return _resolution(spark, d)[2].select("id", "title", "popularity")


@query
def resolve_candidates(spark, d):
    return _resolution(spark, d)[3].select("source_movie_id", "movie_id", "score", "seq")


@query
def resolve_pending(spark, d):
    return _resolution(spark, d)[4]


@query
def resolve_titles(spark, d):
    """The whole way from titles that wait to the films' new state, with scores by titles, dates and popularity."""
    m, alternatives, dates = _local(spark, d)
    f = films(spark, d).withColumn("title", F.when(F.col("id") % 13 != 0, F.concat("title", F.when(F.col("id") % 5 == 1, " - the return").otherwise(""))))
    state = matching.resolve_pending(f, fact(spark, d), m, dataset.candidates(spark, d), alternatives, dates, ("unmatched", "needs_review"))
    return state[0].select("id", "movie_id", "match_status", "match_method", "match_confidence")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weekly_trend(spark, sf_dir)
