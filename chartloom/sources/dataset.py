"""The chart tables (fact, films, movies, runs, snapshots, ...) derived from the star schema.

``fact`` has a row for each film, territory and chart week. Money is in integer cents, so sums do not
depend on their order. A few columns are disturbed by fixed rules on keys, so that checks for gaps,
anomalies, ambiguous titles and broken links have something to find.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import title_key
from ..operators import relational as R

SOURCE = "box"
#: Rows that a task holds when the fact is made: its hash tables and sorts then stay at some hundred MB.
TASK_ROWS = 250_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def chart_week(day: Column) -> Column:
    """The Thursday on which the chart week of a date starts."""
    return F.date_sub(day, ((F.weekday(day) + 4) % 7).cast("int"))


def tasks(spark: SparkSession, rows: int) -> int:
    """Parts that so many rows are dealt to: their number grows with the rows, not what a part holds."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def week_part(n: int) -> Column:
    """The part of a region's week: five regions of a week follow each other, and weeks go round the ``n`` parts."""
    week = F.floor(F.date_diff("week_start", F.lit("1994-01-06").cast("date")) / 7)
    return F.coalesce(F.pmod(week * 5 + F.col("r_regionkey"), F.lit(n)), F.lit(0)).cast("int")


def every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def shown_title(name: Column, key: Column) -> Column:
    """The title as the source spells it: some in capitals with spaces around, some with an accent."""
    return F.when(key % 5 == 0, F.concat(F.lit("  "), F.upper(name), F.lit(" "))).when(key % 7 == 3, F.replace(name, F.lit("o"), F.lit("ò"))).otherwise(name)


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice")


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weekly chart.

    Lines are dealt out twice, by week for sums and ranks, and by film for what runs over weeks and names; each time to as
    many parts as the rows (told by the files' footers) need, which adaptive execution, by bytes as they are packed, would join.
    Weeks are few, some for each part, and go round the parts in their order, as a hash would give some parts several times
    the weeks of others, and the more so the more parts there are.
    Sellers are dealt to as many if the session deals to fewer, and lines follow them where there is no broadcast.
    """
    places = table(spark, sf_dir, "nation").join(F.broadcast(table(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"))  # 25 rows
    sellers = table(spark, sf_dir, "supplier").join(F.broadcast(places), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "r_regionkey", "r_name")
    items = table(spark, sf_dir, "lineitem")
    n = tasks(spark, items.count())
    sellers = R.dealt(sellers, n, "s_suppkey")
    lines = items.select(
        "l_partkey", "l_suppkey", F.round(F.col("l_extendedprice") * 100).cast("long").alias("cents"),
        chart_week(F.col("l_shipdate").cast("date")).alias("week_start"),
    )
    sold = lines.join(sellers, F.col("l_suppkey") == F.col("s_suppkey")).drop("s_suppkey").withColumn("part", week_part(n)).repartitionById(n, F.col("part"))
    weekly = sold.groupBy("part", "r_regionkey", "r_name", "week_start", "l_partkey").agg(F.sum("cents").alias("cents"), F.countDistinct("l_suppkey").alias("screen_count"))
    film = Window.partitionBy("r_regionkey", "l_partkey")
    weekly = weekly.withColumn("rank", F.row_number().over(Window.partitionBy("part", "r_regionkey", "week_start").orderBy(F.col("cents").desc(), "l_partkey")).cast("long"))
    weekly = weekly.drop("part").repartition(n, "l_partkey").withColumn("first_week", F.min("week_start").over(film)).withColumn("total", F.sum("cents").over(film.orderBy("week_start").rowsBetween(Window.unboundedPreceding, 0)))
    named = parts(spark, sf_dir).join(movie_ids(spark, sf_dir), "p_name")  # a few names have all rows of the fact, so it is not dealt by them
    rows = weekly.join(named, F.col("l_partkey") == F.col("p_partkey"))
    title = shown_title(F.col("p_name"), F.col("p_partkey"))
    status = match_status()
    movie = F.when(every("p_partkey", 17), F.col("movie_id") + 1).when(every("p_partkey", 13) | ~status.isin("auto", "manual"), F.lit(None)).otherwise(F.col("movie_id"))
    return rows.select(
        ((F.col("p_partkey") * 1000 + F.floor(F.date_diff("week_start", F.lit("1994-01-06").cast("date")) / 7)) * 10 + F.col("r_regionkey")).cast("long").alias("id"),
        F.lit(SOURCE).alias("source_name"), F.col("r_name").alias("territory"), "week_start", F.date_add("week_start", 3).alias("week_end"), "rank",
        title.alias("title"), title_key(title).alias("title_key"), F.col("p_brand").alias("distributor"),
        F.when(every("p_partkey", 29), F.lit(None)).when(every("p_partkey", 17), 2 * F.col("cents")).otherwise(F.col("cents")).cast("long").alias("weekly_gross"),
        F.when(every("p_partkey", 23), F.col("cents") - 1).otherwise(F.col("total")).cast("long").alias("total_gross"),
        F.when(every("p_partkey", 31), F.lit(0)).otherwise(F.col("screen_count")).cast("long").alias("screen_count"),
        (F.floor(F.date_diff("week_start", "first_week") / 7) + 1).cast("long").alias("weeks_in_release"),
        movie.cast("long").alias("movie_id"), F.when(every("p_partkey", 19), F.lit(None)).otherwise(F.col("p_partkey")).cast("long").alias("source_movie_ref"),
    )


def movie_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts(spark, sf_dir).groupBy("p_name").agg(F.min("p_partkey").alias("movie_id"))


def match_status() -> Column:
    k = F.col("p_partkey") % 7
    return F.when(k == 0, "unmatched").when(k == 1, "needs_review").when(k == 2, "no_match").when(k == 3, "manual").otherwise("auto")


def films(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The films as the source knows them, with the state of their match."""
    rows = parts(spark, sf_dir).join(movie_ids(spark, sf_dir), "p_name")
    title = shown_title(F.col("p_name"), F.col("p_partkey"))
    status = match_status()
    legacy = every("p_partkey", 11)
    method = F.when(status == "manual", "manual").when(status == "auto", "title_date").when((status == "no_match") & every("p_partkey", 2), "manual")
    return rows.select(
        F.col("p_partkey").alias("id"), F.lit(SOURCE).alias("source_name"),
        F.when(legacy, F.concat(F.lit("legacy:"), title_key(title))).otherwise(F.col("p_partkey").cast("string")).alias("source_movie_id"),
        title.alias("title"), title_key(title).alias("title_key"),
        F.when(status.isin("auto", "manual"), F.col("movie_id")).alias("movie_id"), status.alias("match_status"), method.alias("match_method"),
        F.when(status.isin("auto", "needs_review"), 500 + F.col("p_partkey") % 500).when(status == "manual", 1000).cast("long").alias("match_confidence"),
    )


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue: one film for each name."""
    named = parts(spark, sf_dir).groupBy("p_name").agg(F.min("p_partkey").alias("id"), F.min("p_retailprice").alias("popularity"), F.sum(F.round(F.col("p_retailprice") * 100).cast("long")).alias("revenue"))
    return named.select("id", F.initcap("p_name").alias("title"), F.concat(F.lit("The "), "p_name").alias("original_title"), F.date_add(F.lit("1995-01-01").cast("date"), (F.col("id") * 37 % 2000).cast("int")).alias("release_date"), "popularity", "revenue")


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipeline runs; times in microseconds."""
    e = table(spark, sf_dir, "events").withColumn("started", F.unix_micros(F.col("ts").cast("timestamp")))
    recovery = F.col("user_id") % 10 == 0
    status = F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "running").otherwise("success")
    return e.select(F.col("event_id").alias("id"), F.when(recovery, "weekly_chart_recovery").otherwise("weekly_chart").alias("pipeline_name"), F.lit(SOURCE).alias("source_name"), F.col("started").alias("started_at"), F.when(status != "running", F.col("started") + 60_000_000).alias("finished_at"), status.alias("status"))


def archive_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archived pages: 14-digit times and the status they were stored with."""
    return table(spark, sf_dir, "events").select(F.date_format(F.date_trunc("hour", F.col("ts").cast("timestamp")), "yyyyMMddHHmmss").alias("timestamp"), F.when(F.col("event_type") == "error", 404).otherwise(200).alias("status"))


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored candidates of the films that wait for a review: two to four for each, scores in thousandths."""
    waiting = films(spark, sf_dir).filter("match_status in ('needs_review', 'unmatched') and id % 3 <> 0")
    return waiting.select("id", F.explode(F.sequence(F.lit(0), (F.col("id") % 3).cast("int"))).alias("k")).select(
        F.col("id").alias("source_movie_id"), (F.col("id") * 10 + F.col("k")).alias("movie_id"), (400 + (F.col("id") * 7 + F.col("k") * 131) % 600).cast("long").alias("score"),
        F.when(F.col("k") != 1, (F.col("id") * 13 % 90).cast("long")).alias("popularity"), F.col("k").cast("long").alias("seq"),
    )
