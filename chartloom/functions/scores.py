"""What a candidate's dates, popularity and title are worth, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the parts, and thresholds of a decision.
TITLE, DATE, POPULARITY = 0.70, 0.25, 0.05
ACCEPT, MARGIN, REVIEW = 0.85, 0.10, 0.55
UNKNOWN_DATE = 0.4


def estimated_release(week_start: Column, weeks: Column) -> Column:
    """The Thursday of the first week; no or zero weeks count as the first."""
    before = F.greatest(F.coalesce(F.nullif(weeks, F.lit(0)), F.lit(1)) - 1, F.lit(0))
    return F.date_sub(week_start, (7 * before).cast("int"))


def date_score(estimated: Column, released: Column) -> Column:
    days = F.date_diff(estimated, released)
    late = 1 - 0.8 * (days - 150) / 300
    early = 1 - (-21 - days) / F.lit(69.0)
    known = F.when(days.between(-21, 150), 1.0).when((days > 150) & (days <= 450), late).when((days >= -90) & (days < -21), early).otherwise(0.0)
    return F.when(estimated.isNull() | released.isNull(), UNKNOWN_DATE).otherwise(known)


def local_release_score(estimated: Column, dates: Column) -> Column:
    """By the nearest of the dates in the chart's own country; null without an estimate or dates."""
    gap = F.array_min(F.transform(dates, lambda d: F.abs(F.date_diff(estimated, d))))
    return F.when(gap.isNull(), F.lit(None)).when(gap <= 10, 1.0).when(gap <= 45, 1 - 0.8 * (gap - 10) / 35).otherwise(0.0)


def popularity_score(popularity: Column) -> Column:
    return F.when(popularity > 0, F.least(F.lit(1.0), F.log10(1 + popularity) / 3)).otherwise(0.0)


def total_score(title: Column, date: Column, popularity: Column) -> Column:
    return TITLE * title + DATE * date + POPULARITY * popularity


def decision(best: Column, second: Column) -> Column:
    """By the best score and the next; scores are doubles, on which the margin is taken as it is."""
    clear = (best >= ACCEPT) & (best - F.coalesce(second, F.lit(0.0)) >= MARGIN)
    return F.when(best.isNull(), "no_match").when(clear, "auto").when(best >= REVIEW, "needs_review").otherwise("no_match")
