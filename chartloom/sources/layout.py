"""The fact dealt out by chart week when it is written, so that what goes by week needs no exchange when it is read."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.relational import CHART

WEEK = (*CHART, "week_start")


def bucketed(fact: DataFrame, table: str, buckets: int, ahead: DataFrame | None = None) -> DataFrame:
    """Writes ``fact`` as a table in buckets of chart weeks, by rank within, and gives it as read again.

    Windows and groups by chart and week, or by these and more, then read a bucket in one task; a join of two tables with
    equal buckets moves neither. A week is a fraction of a percent of any fact of years; ``buckets`` should be several for
    each core and none above what a task holds. ``ahead`` (a frame of one row with n) tells the rows of the fact, where
    they are known, and the number of buckets grows to a million rows in each.
    """
    rows = ahead.first()["n"] if ahead is not None else 0
    n = max(buckets, -(-rows // 1_000_000))
    dealt = fact.repartition(n, *WEEK).sortWithinPartitions(*WEEK, "rank", "id")  # one file a bucket
    dealt.write.mode("overwrite").bucketBy(n, *WEEK).sortBy(*WEEK, "rank", "id").saveAsTable(table)
    return fact.sparkSession.table(table)


def exchanges(df: DataFrame) -> int:
    """Exchanges in the plan, without broadcasts."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return sum(("Exchange " in line or "Exchange hash" in line) and "Broadcast" not in line for line in plan.split("== Initial Plan")[0].splitlines())


def rows_of(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count("*").alias("n"))
