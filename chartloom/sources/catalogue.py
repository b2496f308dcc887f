"""Answers of a film catalogue: nested JSON to columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import title_key

# Kinds of release that count (premiere, limited, theatrical).
RELEASES = (1, 2, 3)
RELEASE_DATES = "results array<struct<iso_3166_1:string,release_dates:array<struct<type:int,release_date:string>>>>"
TITLES = "titles array<struct<title:string>>"


def release_dates(answer: Column, country: str) -> Column:
    """The sorted distinct dates of a country's releases; what is not a date is left out."""
    results = F.from_json(answer, RELEASE_DATES)["results"]
    own = F.flatten(F.transform(F.filter(results, lambda r: r["iso_3166_1"] == country), lambda r: r["release_dates"]))
    days = F.transform(F.filter(own, lambda d: d["type"].isin(*RELEASES)), lambda d: F.try_to_date(F.substring(d["release_date"], 1, 10), "yyyy-MM-dd"))
    return F.array_sort(F.array_distinct(F.filter(F.coalesce(days, F.array().cast("array<date>")), lambda d: d.isNotNull())))


def alternative_titles(answer: Column) -> Column:
    names = F.transform(F.from_json(answer, TITLES)["titles"], lambda t: t["title"])
    return F.filter(F.coalesce(names, F.array().cast("array<string>")), lambda t: t.isNotNull() & (t != ""))


def joined_genres(genres: Column) -> Column:
    """The names of an array of struct(name), with a comma between them."""
    return F.array_join(F.transform(F.filter(genres, lambda g: g["name"].isNotNull()), lambda g: g["name"]), ", ")


def normalise_movie(answers: DataFrame) -> DataFrame:
    """An empty date is none; missing money, popularity and votes are 0."""
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return answers.select("id", "title", F.nullif("release_date", F.lit("")).try_cast("date").alias("release_date"), zero("revenue"), zero("budget"), zero("popularity"))


def normalise_records(records: DataFrame, source: str) -> DataFrame:
    """Chart records under the caller's source; a table without territory is of IT, a null one stays."""
    territory = F.col("territory") if "territory" in records.columns else F.lit("IT")
    rest = [c for c in records.columns if c not in ("source_name", "territory", "title_key")]
    return records.select(F.lit(source).alias("source_name"), territory.alias("territory"), *rest, title_key(F.col("title")).alias("title_key"))
