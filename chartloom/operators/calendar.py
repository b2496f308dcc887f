"""Weeks that are missing, snapshots that may hold them, and weeks to load again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .relational import CHART


def missing_weeks(fact: DataFrame, weeks: int = 12, slack: int = 3) -> DataFrame:
    """Weeks back from a chart's last one that have no row within ``slack`` days; none before its first.

    A week that has rows is spread over the days that it covers, so the range becomes an equality and
    nothing is compared pairwise.
    """
    there = fact.select(*CHART, "week_start").distinct()
    bounds = there.groupBy(*CHART).agg(F.min("week_start").alias("low"), F.max("week_start").alias("high"))
    due = bounds.select(*CHART, "low", F.explode(F.transform(F.sequence(F.lit(0), F.lit(weeks)), lambda g: F.date_sub("high", g * 7))).alias("expected"))
    due = due.filter(F.col("expected") >= F.date_sub("low", slack)).drop("low")
    covered = there.select(*CHART, F.explode(F.transform(F.sequence(F.lit(-slack), F.lit(slack)), lambda d: F.date_add("week_start", d))).alias("expected"))
    return due.join(covered, [*CHART, "expected"], "left_anti")


def candidate_snapshots(weeks: DataFrame, index: DataFrame, most: int = 5) -> DataFrame:
    """For each week_start the latest archived pages from 3 to 10 days after it, numbered in the order of trial."""
    stored = index.filter("status = 200").select("timestamp").distinct().withColumn("day", F.to_date(F.substring("timestamp", 1, 8), "yyyyMMdd"))
    days = weeks.select("week_start", F.explode(F.transform(F.sequence(F.lit(3), F.lit(10)), lambda d: F.date_add("week_start", d))).alias("day"))
    order = Window.partitionBy("week_start").orderBy(F.col("timestamp").desc())
    return days.join(stored, "day").withColumn("trial", F.row_number().over(order).cast("long")).filter(F.col("trial") <= most).drop("day")


def recovered(trials: DataFrame, pages: DataFrame, least_rows: int = 10) -> DataFrame:
    """The first trial of each week whose page (timestamp, page_week, titles) is of that week and complete."""
    good = trials.join(pages, "timestamp").filter((F.col("page_week") == F.col("week_start")) & (F.col("titles") >= least_rows))
    return good.groupBy("week_start").agg(F.min(F.struct("trial", "timestamp")).alias("x")).select("week_start", F.col("x.timestamp").alias("timestamp"), F.col("x.trial").alias("trial"))


def backfill(start: Column, weeks: int, fact: DataFrame) -> DataFrame:
    """Weeks back from a start with the rows that each chart has for them; what cannot be had is skipped."""
    steps = fact.sparkSession.range(max(weeks, 0)).select(F.date_sub(start, (7 * F.col("id")).cast("int")).alias("week_start"))
    return fact.join(F.broadcast(steps), "week_start").groupBy(*CHART, "week_start", "week_end").agg(F.count("*").alias("titles"))
