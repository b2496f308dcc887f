"""Joins, aggregations, windows and top-k over the chart tables.

Every window has a total order; money is in integer cents; nulls sort where they are said to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CHART = ("source_name", "territory")
KEY = (*CHART, "week_start", "title_key")


def dealt(df: DataFrame, parts: int | None, *keys: str) -> DataFrame:
    """Dealt out by keys to that many parts where the session would make fewer; else exchanges are left to Spark."""
    return df.repartition(parts, *keys) if parts and parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def with_film(rows: DataFrame, films: DataFrame, key: str, known: Column | None = None) -> DataFrame:
    """Left join of chart rows with what is known of their film, by its id. Rows without film, and those whose film is
    ``known`` already, meet none, and are spread by their own id in place of one task."""
    ref = F.col("source_movie_ref") if known is None else F.when(~known, F.col("source_movie_ref"))
    return rows.join(films, (F.coalesce(ref, "id") == F.col(key)) & ref.isNotNull(), "left")


def first_by(df: DataFrame, keys: tuple[str, ...], *order: Column) -> DataFrame:
    """The first row of each key."""
    ranked = df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter("_n = 1").drop("_n")


def gross_per_screen(gross: Column, screens: Column) -> Column:
    """Whole cents a screen, halves up; null without screens."""
    return F.when(screens > 0, F.floor((2 * gross + screens) / (2 * screens))).cast("long")


def weekly_enriched(fact: DataFrame, films: DataFrame, movies: DataFrame) -> DataFrame:
    """The chart with the film's match and the catalogue's film; rows without either stay."""
    film = films.select(F.col("id").alias("ref"), "match_status", F.col("movie_id").alias("film_movie_id"))
    movie = movies.select(F.col("id").alias("mid"), F.col("title").alias("movie_title"), "release_date")
    joined = fact.join(film, F.col("source_movie_ref") == F.col("ref"), "left").join(movie, F.col("movie_id") == F.col("mid"), "left")
    return joined.withColumn("gross_per_screen", gross_per_screen(F.col("weekly_gross"), F.col("screen_count")))


def inconsistent_links(fact: DataFrame, films: DataFrame) -> DataFrame:
    """Rows whose movie differs from their film's; null differs from a number."""
    film = films.select(F.col("id").alias("source_movie_ref"), F.col("movie_id").alias("film_movie_id"))
    return fact.join(film, "source_movie_ref").filter(~F.col("movie_id").eqNullSafe(F.col("film_movie_id")))


def first_weeks(films: DataFrame, fact: DataFrame) -> DataFrame:
    """Each film with the first week of its chart rows, and the weeks in release there; nulls if it has none."""
    first = fact.groupBy("source_movie_ref").agg(F.min(F.struct("week_start", "id", "weeks_in_release")).alias("first"))
    joined = films.join(first, F.col("source_movie_ref") == films["id"], "left")
    return joined.select(*[films[c] for c in films.columns], F.col("first.week_start").alias("first_week"), F.col("first.weeks_in_release").alias("first_weeks_in_release"))


def pending_matches(films: DataFrame, fact: DataFrame, statuses: tuple[str, ...] = ("unmatched",), limit: int | None = None) -> DataFrame:
    """Films that wait for a match and were never decided by hand, by id; without a limit (or 0) all."""
    waiting = films.filter(F.col("match_status").isin(*statuses) & ~F.col("match_method").eqNullSafe(F.lit("manual")))
    rows = first_weeks(waiting, fact)
    return rows.orderBy("id").limit(limit) if limit else rows


def weekly_trend(fact: DataFrame, weeks: int = 8) -> DataFrame:
    """Total gross and titles of the last weeks of each chart."""
    weekly = fact.groupBy(*CHART, "week_start").agg(F.sum("weekly_gross").alias("total_gross"), F.count("*").alias("titles"))
    last = Window.partitionBy(*CHART).orderBy(F.col("week_start").desc())
    return weekly.withColumn("_n", F.row_number().over(last)).filter(F.col("_n") <= weeks).drop("_n")


def latest_week(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*CHART).agg(F.max("week_start").alias("week_start"))


def of_latest_week(fact: DataFrame, **counts: Column) -> DataFrame:
    """Aggregates over each chart's latest week, in one pass: by week first, then the last week's."""
    weekly = fact.filter("week_start is not null").groupBy(*CHART, "week_start").agg(*[c.alias(k) for k, c in counts.items()])
    return weekly.groupBy(*CHART).agg(F.max(F.struct("week_start", *counts)).alias("last")).select(*CHART, "last.*")


def latest_week_status(fact: DataFrame) -> DataFrame:
    return of_latest_week(fact, titles=F.count("*"))


def movie_id_coverage(fact: DataFrame) -> DataFrame:
    return of_latest_week(fact, with_movie=F.count("movie_id"), titles=F.count("*"))


def top_titles(fact: DataFrame, n: int = 5) -> DataFrame:
    """The first titles of each chart's latest week, in one pass: the first of every week, then the last week's."""
    order = Window.partitionBy(*CHART, "week_start").orderBy("rank", "id")
    first = fact.filter("week_start is not null").withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= n)
    last = F.rank().over(Window.partitionBy(*CHART).orderBy(F.col("week_start").desc()))  # n rows a week
    return first.withColumn("_n", last).filter("_n = 1").drop("_n")


def sample_latest(fact: DataFrame, n: int = 5) -> DataFrame:
    return fact.orderBy(F.col("week_start").desc(), "rank", "territory", "id").limit(n)


def status_counts(films: DataFrame, statuses: tuple[str, ...] | None = None) -> DataFrame:
    rows = films.filter(F.col("match_status").isin(*statuses)) if statuses else films
    return rows.groupBy("match_status").agg(F.count("*").alias("n"))


def ambiguous_titles(fact: DataFrame) -> DataFrame:
    """Titles, as spelt, that stand for more than one movie."""
    return fact.groupBy("title").agg(F.countDistinct("movie_id").alias("movies")).filter("movies > 1")


def unlinked_rows(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count_if(F.col("source_movie_ref").isNull()).alias("unlinked"), F.count("*").alias("total"))


def duplicate_keys(fact: DataFrame) -> DataFrame:
    return fact.groupBy(*KEY).agg(F.count("*").alias("n")).filter("n > 1")


def dedupe(fact: DataFrame, parts: int | None = None) -> DataFrame:
    """One row for each natural key: the lowest rank, the earlier row on ties; no rank counts as 0. Keys are dealt to
    that many parts at least, without the source: where that is a constant, Spark would deal them again."""
    return first_by(dealt(fact, parts, *KEY[1:]), KEY, F.coalesce("rank", F.lit(0)), F.col("id"))


def merge_duplicates(fact: DataFrame) -> DataFrame:
    """One row for each natural key: the latest by week in release and id, with the links that it lacks
    from the next."""
    order = Window.partitionBy(*KEY).orderBy(F.col("weeks_in_release").desc(), F.col("id").desc())
    rows = fact.withColumn("_n", F.row_number().over(order))
    for c in ("movie_id", "source_movie_ref"):
        rows = rows.withColumn(c, F.coalesce(c, F.lead(c).over(order)))
    return rows.filter("_n = 1").drop("_n")


def first_real(films: DataFrame) -> DataFrame:
    """The first film that is not a legacy one, for each title of a source."""
    return first_by(films.filter(~F.col("source_movie_id").startswith("legacy:")), ("source_name", "title_key"), F.col("id"))


def first_seen(df: DataFrame, key: str, seq: str) -> DataFrame:
    """Distinct keys in the order in which they first appear; rows without a key are left out."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(seq).alias(seq))


def review_queue(films: DataFrame, candidates: DataFrame) -> DataFrame:
    """Films to review with their candidates, the best first; none gives an empty list."""
    c = candidates.groupBy("source_movie_id").agg(F.collect_list(F.struct((-F.col("score")).alias("below"), "movie_id")).alias("found"))
    waiting = films.filter("match_status = 'needs_review'").select("id", "title")
    listed = F.transform(F.array_sort(F.coalesce("found", F.array().cast("array<struct<below:bigint,movie_id:bigint>>"))), lambda x: x["movie_id"])
    return waiting.join(c, F.col("source_movie_id") == F.col("id"), "left").select("id", "title", listed.alias("movie_ids"))


def rank_candidates(candidates: DataFrame) -> DataFrame:
    """By score, then popularity (none is 0), then as they came."""
    order = Window.partitionBy("source_movie_id").orderBy(F.col("score").desc(), F.coalesce("popularity", F.lit(0)).desc(), "seq")
    return candidates.withColumn("place", F.row_number().over(order).cast("long"))


def prune(backups: DataFrame, keep_min: int, before: Column) -> DataFrame:
    """Of (group, path, mtime): what is neither among the newest of its group nor young enough to stay."""
    order = Window.partitionBy("group").orderBy(F.col("mtime").desc(), F.col("path").desc())
    return backups.withColumn("_n", F.row_number().over(order)).filter((F.col("_n") > keep_min) & (F.col("mtime") < before)).drop("_n")


def paged(df: DataFrame, by: str, key: str, pages: int, size: int) -> DataFrame:
    """The first pages by a column, the highest first."""
    top = df.orderBy(F.col(by).desc(), key).limit(pages * size)
    place = F.row_number().over(Window.orderBy(F.col(by).desc(), key))  # pages * size rows
    return top.withColumn("page", (F.floor((place - 1) / size) + 1).cast("long"))
