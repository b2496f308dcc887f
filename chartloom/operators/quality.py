"""Checks of the chart: anomalies, batches, constraints, quarantine, the health report and failures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import Scratch
from . import relational as R
from .calendar import missing_weeks

OK, WARN, FAIL = "OK", "WARN", "FAIL"
LEAST_ROWS, MOST_ROWS = 10, 20


def anomalies(fact: DataFrame, weeks: int = 3) -> DataFrame:
    """Rows of the last weeks of a chart that gross more than the row above, or more than their total."""
    above = F.lag("weekly_gross").over(Window.partitionBy(*R.CHART, "week_start").orderBy("rank", "id"))
    odd = fact.withColumn("above", above).withColumn("odd", (F.col("weekly_gross") > F.col("above")) | (F.col("total_gross") < F.col("weekly_gross")))
    # of a week only odd rows are needed, and that it is there
    week = Window.partitionBy(*R.CHART, "week_start").orderBy("rank", "id")
    odd = odd.withColumn("first", F.row_number().over(week) == 1).filter("odd or first")
    last = F.max("week_start").over(Window.partitionBy(*R.CHART))
    return odd.withColumn("last", last).filter(F.col("odd") & (F.col("week_start") >= F.date_sub("last", 7 * weeks))).drop("last", "odd", "first")


def order_violations(fact: DataFrame) -> DataFrame:
    """Rows that gross more than the last row above that has a gross."""
    order = Window.partitionBy(*R.CHART, "week_start").orderBy("rank", "id")
    above = F.last("weekly_gross", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    return fact.withColumn("above", above).filter("weekly_gross > above")


def batch_warnings(fact: DataFrame) -> DataFrame:
    """Per chart and week (its first and last day) what is odd about it, counted; no row is dropped."""
    week = (*R.CHART, "week_start", "week_end")
    order = Window.partitionBy(*week).orderBy("rank", "id").rowsBetween(Window.unboundedPreceding, -1)
    rows = fact.withColumn("above", F.last("weekly_gross", ignorenulls=True).over(order))
    # a value's rows but the first: sorts within the week's task, where two distinct counts would deal the rows out twice
    again = lambda c: F.col(c).isNotNull() & (F.row_number().over(Window.partitionBy(*week, c).orderBy("id")) > 1)
    rows = rows.withColumn("again_rank", again("rank")).withColumn("again_title", again("title"))
    sums = rows.groupBy(*week).agg(
        F.count("*").alias("titles"), F.count_if("again_rank").alias("double_ranks"), F.count_if("again_title").alias("double_titles"),
        F.count_if(F.col("total_gross") < F.col("weekly_gross")).alias("low_totals"), F.count_if(F.col("weekly_gross") > F.col("above")).alias("disordered"),
    )
    return sums.withColumn("odd_size", ~F.col("titles").between(LEAST_ROWS, MOST_ROWS))


def violations(fact: DataFrame, films: DataFrame, movies: DataFrame) -> DataFrame:
    """(name, n) of each constraint: checks, keys and references."""
    n = lambda name, df: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
    decided = F.col("match_status").isin("auto", "manual")
    has = lambda df, key, ids: df.filter(F.col(key).isNotNull()).join(ids.select(F.col("id").alias(key)), key, "left_anti")
    checks = [
        n("week_end_before_start", fact.filter("week_end < week_start")), n("rank_not_positive", fact.filter("rank <= 0")),
        n("status_unknown", films.filter(~F.col("match_status").isin("unmatched", "auto", "manual", "needs_review", "no_match"))),
        n("confidence_out_of_range", films.filter(~F.col("match_confidence").between(0, 1000))),
        n("movie_without_decision", films.filter(F.col("movie_id").isNull() == decided)),
        n("natural_key_twice", R.duplicate_keys(fact)),
        n("source_id_twice", films.groupBy("source_name", "source_movie_id").count().filter("count > 1").drop("count")),
        n("film_missing", has(fact, "source_movie_ref", films)), n("movie_missing", has(fact, "movie_id", movies)),
    ]
    return reduce(DataFrame.unionByName, checks)


def quarantine(fact: DataFrame) -> DataFrame:
    """Each row with the reason for which it is kept aside; null for rows that are fine."""
    reason = (
        F.when(F.col("weekly_gross").isNull(), "no gross").when(F.col("total_gross") < F.col("weekly_gross"), "total below week")
        .when(F.col("screen_count") <= 0, "no screens").when(F.col("source_movie_ref").isNull(), "no film")
    )
    return fact.withColumn("reason", reason)


def check(name: str, df: DataFrame, level: Column) -> DataFrame:
    return df.select(F.lit(name).alias("name"), level.alias("level"))


def last_run(runs: DataFrame, as_of: Column, pipeline: str = "weekly_chart", days: int = 8, source: str | None = None) -> DataFrame:
    """One row: the last run's status, of one source or of all, and the age of the last success in days."""
    runs = runs.filter(F.col("source_name") == source) if source else runs
    ended = F.when(F.col("status") == "success", F.coalesce("finished_at", "started_at"))
    row = runs.filter(F.col("pipeline_name") == pipeline).agg(F.max_by("status", "id").alias("status"), ((as_of - F.max(ended)) / 86_400_000_000).alias("age_days"))
    level = (
        F.when(F.col("status").isNull() | (F.col("status") == "failed") | F.col("age_days").isNull(), FAIL).when(F.col("age_days") > days, FAIL)
        .when(F.col("status") == "running", WARN).otherwise(OK)
    )
    return row.withColumn("level", level)


def latest_week_level(fact: DataFrame, as_of: Column, source: str | None = None, territory: str | None = None) -> DataFrame:
    """One row: age of the latest week, of one source or territory or of all, and its rows."""
    fact = fact.filter(F.col("source_name") == source) if source else fact
    fact = fact.filter(F.col("territory") == territory) if territory else fact
    row = fact.groupBy("week_start").agg(F.count("*").alias("titles")).agg(F.max(F.struct("week_start", "titles")).alias("x"))
    return row.select(*_week_level(as_of))


def _week_level(as_of: Column) -> tuple[Column, ...]:
    """The columns week_start, age_days, titles and level of a struct ``x`` of the latest week and its rows."""
    age = F.date_diff(as_of, F.col("x.week_start"))
    level = F.when(F.col("x").isNull(), FAIL).when(age > 14, FAIL).when(age > 10, WARN).when(F.col("x.titles") < LEAST_ROWS, WARN).otherwise(OK)
    return F.col("x.week_start").alias("week_start"), age.cast("long").alias("age_days"), F.col("x.titles").alias("titles"), level.alias("level")


def latest_week_levels(fact: DataFrame, as_of: Column) -> DataFrame:
    """A row for each chart: age of its latest week and the rows of it."""
    rows = fact.groupBy(*R.CHART, "week_start").agg(F.count("*").alias("titles")).groupBy(*R.CHART).agg(F.max(F.struct("week_start", "titles")).alias("x"))
    return rows.select(*R.CHART, *_week_level(as_of))


def worst(levels: DataFrame) -> DataFrame:
    """One row: the worst level; a failure where there is none."""
    has = lambda x: F.coalesce(F.bool_or(F.col("level") == x), F.lit(False))
    return levels.agg(F.when((F.count("*") == 0) | has(FAIL), FAIL).when(has(WARN), WARN).otherwise(OK).alias("level"))


def gap_level(fact: DataFrame, weeks: int = 12) -> DataFrame:
    row = missing_weeks(fact, weeks).agg(F.count("*").alias("missing"))
    return row.withColumn("level", F.when(F.col("missing") > 0, WARN).otherwise(OK))


def coverage_level(fact: DataFrame) -> DataFrame:
    row = R.movie_id_coverage(fact).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("with_movie", "titles")])
    return row.withColumn("level", F.when((F.col("titles") > 0) & (100 * F.col("with_movie") >= 85 * F.col("titles")), OK).otherwise(WARN))


def integrity(fact: DataFrame, films: DataFrame) -> DataFrame:
    """One row for each of four checks with its count and level."""
    one = lambda name, df, bad: df.select(F.lit(name).alias("name"), "n", F.when(F.col("n") > 0, bad).otherwise(OK).alias("level"))
    n = lambda df: df.agg(F.count("*").alias("n"))
    parts = [
        one("links", n(R.inconsistent_links(fact, films)), FAIL), one("unlinked", n(fact.filter("source_movie_ref is null")), WARN),
        one("match queue", n(films.filter(F.col("match_status").isin("unmatched", "needs_review"))), WARN), one("ambiguous titles", n(R.ambiguous_titles(fact)), WARN),
    ]
    return reduce(DataFrame.unionByName, parts)


def _shapes(fact: DataFrame, films: DataFrame) -> DataFrame:
    """A row for each chart week, with what the checks of the fact need of it, from one pass over the rows: rows, rows
    with a movie, rows without film, links that are not their film's, odd rows."""
    above = F.lag("weekly_gross").over(Window.partitionBy(*R.CHART, "week_start").orderBy("rank", "id"))
    film = films.select(F.col("id").alias("source_movie_ref"), F.col("movie_id").alias("film_movie_id"), F.lit(True).alias("known"))
    rows = fact.withColumn("above", above).join(film, "source_movie_ref", "left")
    n = lambda c, name: F.count_if(c).alias(name)
    return rows.groupBy(*R.CHART, "week_start", "title", "movie_id").agg(
        F.count("*").alias("titles"), n(F.col("movie_id").isNotNull(), "with_movie"), n(F.col("source_movie_ref").isNull(), "unlinked"),
        n(F.col("known") & ~F.col("movie_id").eqNullSafe(F.col("film_movie_id")), "inconsistent"),
        n((F.col("weekly_gross") > F.col("above")) | (F.col("total_gross") < F.col("weekly_gross")), "odd"),
    )


#: What a message names at most: missing weeks, titles with several movies.
WEEKS_NAMED, TITLES_NAMED = 6, 4


def health_details(fact: DataFrame, films: DataFrame, runs: DataFrame, as_of_run: Column, as_of_day: Column) -> DataFrame:
    """(seq, name, level, message): the nine checks in order.

    The fact is read once: its rows are summed by week, title and movie, which is written; weeks and titles are summed
    from that."""
    scratch = Scratch(fact.sparkSession, "health")
    shapes = scratch.keep(_shapes(fact, films), "shapes")
    sums = ("titles", "with_movie", "unlinked", "inconsistent", "odd")
    weeks = scratch.keep(shapes.groupBy(*R.CHART, "week_start").agg(*[F.sum(c).alias(c) for c in sums]), "weeks")
    last = F.max("week_start").over(Window.partitionBy(*R.CHART))
    latest = F.col("week_start") == F.col("last")
    dated = weeks.withColumn("last", last)
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(name)
    facts = dated.agg(
        total("unlinked", "unlinked"), total("inconsistent", "inconsistent"), total(F.when(F.col("week_start") >= F.date_sub("last", 21), F.col("odd")), "odd"),
        total(F.when(latest, F.col("titles")), "titles"), total(F.when(latest, F.col("with_movie")), "with_movie"),
    )
    newest = dated.filter(latest).select(*R.CHART, F.struct("week_start", "titles").alias("x")).select(*R.CHART, *_week_level(as_of_day))
    some = lambda c, k: F.concat_ws(", ", F.slice(F.array_sort(F.collect_list(c)), 1, k))
    gaps = missing_weeks(weeks, 12).groupBy("expected").agg(F.count("*").alias("charts")).agg(total("charts", "n"), some(F.col("expected").cast("string"), WEEKS_NAMED).alias("named"))
    titles = shapes.filter("movie_id is not null").groupBy("title").agg(F.countDistinct("movie_id").alias("movies")).filter("movies > 1")
    first = titles.orderBy("title").limit(TITLES_NAMED).agg(some(F.col("title"), TITLES_NAMED)).scalar()
    counted = titles.agg(F.count("*").alias("n")).withColumn("named", first)
    waiting = films.agg(F.count_if(F.col("match_status").isin("unmatched", "needs_review")).alias("n"))

    row = lambda seq, name, df, level, message: df.select(F.lit(seq).cast("long").alias("seq"), F.lit(name).alias("name"), level.alias("level"), message.alias("message"))
    n, text = F.col("n"), lambda *parts: F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])
    over = lambda c, bad: F.when(c > 0, bad).otherwise(OK)
    covered = (F.col("titles") > 0) & (100 * F.col("with_movie") >= 85 * F.col("titles"))
    checks = [
        row(1, "last run", last_run(runs, as_of_run), F.col("level"), text("last run: ", F.coalesce("status", F.lit("none")))),
        row(2, "latest week", worst(newest).withColumn("n", newest.agg(F.coalesce(F.max("age_days"), F.lit(0))).scalar()), F.col("level"), text("the oldest latest week is ", n, " days old")),
        row(3, "gaps", gaps, over(n, WARN), F.when(n > 0, text(n, " missing: ", F.col("named"))).otherwise("no week is missing")),
        row(4, "links", facts, over(F.col("inconsistent"), FAIL), text(F.col("inconsistent"), " rows with another movie than their film")),
        row(5, "unlinked", facts, over(F.col("unlinked"), WARN), text(F.col("unlinked"), " rows without film")),
        row(6, "match queue", waiting, over(n, WARN), text(n, " films wait")),
        row(7, "ambiguous titles", counted, over(n, WARN), F.when(n > 0, text(n, " titles with several movies: ", F.col("named"))).otherwise("no title has several movies")),
        row(8, "coverage", facts, F.when(covered, OK).otherwise(WARN), text(F.col("with_movie"), " of ", F.col("titles"), " rows of the latest weeks have a movie")),
        row(9, "anomalies", facts, over(F.col("odd"), WARN), text(F.col("odd"), " odd rows in the last weeks")),
    ]
    report = scratch.keep(reduce(DataFrame.unionByName, checks).coalesce(1), "report")
    scratch.drop("shapes", "weeks")
    return report


def health_report(fact: DataFrame, films: DataFrame, runs: DataFrame, as_of_run: Column, as_of_day: Column) -> DataFrame:
    """(seq, name, level): the nine checks in order."""
    return health_details(fact, films, runs, as_of_run, as_of_day).select("seq", "name", "level")


def gate(report: DataFrame) -> DataFrame:
    """One row: failures, warnings, and whether the export may go on."""
    row = report.agg(F.count_if(F.col("level") == FAIL).alias("failures"), F.count_if(F.col("level") == WARN).alias("warnings"))
    return row.withColumn("export", F.col("failures") == 0)


# What marks the lines of a log that say why something failed.
MARKERS = ("Error", "ERRORE", "Traceback", "[FAIL")


def relevant_lines(log: DataFrame, most: int = 6) -> DataFrame:
    """Of (log_id, seq, line) the last lines with a marker, or the last of all where none has one; blank lines do not count."""
    marked = reduce(lambda a, b: a | b, [F.contains("line", F.lit(m)) for m in MARKERS])
    rows = log.filter(F.trim("line") != "").withColumn("marked", marked)
    rows = rows.withColumn("any", F.max("marked").over(Window.partitionBy("log_id"))).filter("marked or not any")
    place = F.row_number().over(Window.partitionBy("log_id").orderBy(F.col("seq").desc()))
    return rows.withColumn("_n", place).filter(F.col("_n") <= most).select("log_id", "seq", "line")


def failure_reports(exits: DataFrame, log: DataFrame) -> DataFrame:
    """Of (log_id, pipeline_exit, health_exit) those that failed, with a message: what failed, then the lines that say why."""
    failed = exits.filter("pipeline_exit <> 0 or health_exit <> 0")
    lines = relevant_lines(log).groupBy("log_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "line"))), lambda x: x["line"]), "\n").alias("detail"))
    said = lambda name, c: F.when(F.col(c) != 0, F.concat(F.lit(f"{name}: exit code "), F.col(c).cast("string")))
    summary = F.concat_ws("; ", said("pipeline", "pipeline_exit"), said("health check", "health_exit"))
    return failed.join(lines, "log_id", "left").select("log_id", F.concat_ws("\n", summary, "detail").alias("message"))
