"""Titles, numbers, dates and links as column expressions."""

from __future__ import annotations

import re
import unicodedata
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from .scores import DATE, POPULARITY, TITLE

# The months as the pages spell them, and the words that a title may begin with.
MONTHS = ("gennaio", "febbraio", "marzo", "aprile", "maggio", "giugno", "luglio", "agosto", "settembre", "ottobre", "novembre", "dicembre")
ARTICLES = ("il", "lo", "la", "i", "gli", "le", "l", "un", "una", "the", "a", "an")


def title_key(title: Column) -> Column:
    """The natural key of a title: lower case without the spaces around; null gives the empty key."""
    return F.lower(F.trim(F.coalesce(title, F.lit(""))))


def parse_euro(text: Column) -> Column:
    """Cents of an amount such as ``€ 1.234,56``; every point is a separator of thousands, even in ``504.61``."""
    plain = F.replace(F.replace(F.replace(text, F.lit("€"), F.lit("")), F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.round(F.trim(plain).cast("decimal(20,4)") * 100).cast("long")


def parse_int(text: Column) -> Column:
    return F.trim(F.replace(text, F.lit("."), F.lit(""))).cast("long")


def parse_date(day: Column, month: Column, year: Column) -> Column:
    """The date of a day, a month's name in any case and a year; null for an unknown month."""
    number = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(month))
    return F.when(number > 0, F.make_date(year.cast("int"), number.cast("int"), day.cast("int")))


# The parts of a date as the pages write it.
_DAY, _MONTH, _YEAR = r"(\d{1,2})", r"([a-zà]+)", r"(\d{4})"


def week_range(text: Column) -> Column:
    """struct(week_start, week_end) that a page's text names: two dates with years, two with one year at the
    end (which then holds for both), or two days of one month; nulls where there is none."""
    forms = (
        (rf"dal\s+{_DAY}\s+{_MONTH}\s+{_YEAR}\s+al\s+{_DAY}\s+{_MONTH}\s+{_YEAR}", (1, 2, 3), (4, 5, 6)),
        (rf"dal\s+{_DAY}\s+{_MONTH}\s+al\s+{_DAY}\s+{_MONTH}\s+{_YEAR}", (1, 2, 5), (3, 4, 5)),
        (rf"dal\s+{_DAY}\s+al\s+{_DAY}\s+{_MONTH}\s+{_YEAR}", (1, 3, 4), (2, 3, 4)),
    )
    start = end = F.lit(None).cast("date")
    for pattern, first, last in reversed(forms):
        pattern = "(?iuU)" + pattern
        part = lambda i, p=pattern: F.regexp_extract(text, p, i)
        found = text.rlike(pattern)
        start = F.when(found, parse_date(*map(part, first))).otherwise(start)
        end = F.when(found, parse_date(*map(part, last))).otherwise(end)
    return F.struct(start.alias("week_start"), end.alias("week_end"))


def archive_urls(base: str, day: Column) -> Column:
    """The four addresses under which a chart of that day may be found, in the order in which they are tried."""
    y, m, d = F.date_format(day, "yyyy"), F.date_format(day, "MM"), F.date_format(day, "dd")
    return F.array(
        F.concat_ws("/", F.lit(base), y, m, d, F.lit("")),
        F.concat(F.lit(f"{base}/"), F.concat_ws("-", y, m, d), F.lit("/")),
        F.concat(F.lit(f"{base}/?date="), F.concat_ws("-", y, m, d)),
        F.concat(F.lit(f"{base}/?year="), y, F.lit("&month="), m, F.lit("&day="), d),
    )


def query_variants(title: Column) -> Column:
    """The title, then without leading dots, then what precedes a dash in spaces or a colon before one; each once,
    none empty."""
    whole = F.trim(title)
    bare = F.trim(F.regexp_replace(whole, r"^\.+", ""))
    head = F.trim(F.element_at(F.split(bare, r"\s+-\s+|:\s+", 2), 1))
    return F.array_distinct(F.filter(F.array(whole, bare, head), lambda v: v != ""))


def normalise(title: str | None) -> str:
    """Lower case without accents or punctuation."""
    if not title:
        return ""
    plain = "".join(c for c in unicodedata.normalize("NFKD", title.casefold()) if not unicodedata.combining(c))
    return " ".join(re.findall("[a-z0-9]+", plain))


@F.pandas_udf(StringType())
def normalise_title(title: pd.Series) -> pd.Series:
    return title.map(normalise)


def without_articles(normalised: Column) -> Column:
    """Leading articles go as long as a word is left."""
    return F.regexp_replace(normalised, rf"^(?:(?:{'|'.join(ARTICLES)}) )+(?=\S)", "")


# The scores of titles that are equal but for articles, and of a title that begins the other.
SAME_BUT_ARTICLES, CANDIDATE_BEGINS, CANDIDATE_GOES_ON = 0.97, 0.88, 0.78

_LEADING = re.compile(rf"^(?:(?:{'|'.join(ARTICLES)}) )+(?=\S)")


@lru_cache(maxsize=1 << 16)  # films of one title meet the same names
def similarity(a: str, b: str) -> float:
    """How alike two normalised titles are, from 0 to 1; b is the candidate."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    bare_a, bare_b = _LEADING.sub("", a), _LEADING.sub("", b)
    if bare_a == bare_b:
        return SAME_BUT_ARTICLES
    score = max(SequenceMatcher(None, x, y).ratio() for x, y in ((a, b), (bare_a, bare_b)))
    candidate_is_shorter = len(bare_b) < len(bare_a)
    short, long_ = (bare_b, bare_a) if candidate_is_shorter else (bare_a, bare_b)
    if short.count(" ") >= 1 and f"{long_} ".startswith(f"{short} "):  # the rest of the longer one is a subtitle
        score = max(score, CANDIDATE_BEGINS if candidate_is_shorter else CANDIDATE_GOES_ON)
    return score


# What a name may consist of when it is normalised.
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789 "


def letter_counts(normalised: Column) -> Column:
    """How often each of ``LETTERS`` is in a normalised title."""
    return F.transform(F.array(*map(F.lit, LETTERS)), lambda c: F.length(normalised) - F.length(F.replace(normalised, c, F.lit(""))))


def title_forms(normalised: Column) -> Column:
    """What bounds need of a title: (norm, bare, counts, bare_counts)."""
    bare = without_articles(normalised)
    return F.struct(normalised.alias("norm"), bare.alias("bare"), letter_counts(normalised).alias("counts"), letter_counts(bare).alias("bare_counts"))


def similarity_bounds(a: Column, b: Column) -> tuple[Column, Column]:
    """The least and the most that ``similarity`` of two ``title_forms`` can be, without comparing the letters' order:
    matching blocks have no more letters than the titles have in common, each as often as in the one with fewer."""
    common = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: F.least(p, q)), F.lit(0), lambda s, v: s + v)
    ratio = lambda x, y, n: 2 * common(a[x], b[x]) / F.nullif(F.length(a[n]) + F.length(b[n]), F.lit(0))
    shorter = F.length(b["bare"]) < F.length(a["bare"])
    short, long_ = F.when(shorter, b["bare"]).otherwise(a["bare"]), F.when(shorter, a["bare"]).otherwise(b["bare"])
    begins = F.contains(short, F.lit(" ")) & F.startswith(F.concat(long_, F.lit(" ")), F.concat(short, F.lit(" ")))
    subtitle = F.when(begins, F.when(shorter, CANDIDATE_BEGINS).otherwise(CANDIDATE_GOES_ON)).otherwise(0.0)
    most = F.greatest(ratio("counts", "counts", "norm"), ratio("bare_counts", "bare_counts", "bare"), subtitle)
    empty = (F.coalesce(a["norm"], F.lit("")) == "") | (F.coalesce(b["norm"], F.lit("")) == "")
    known = lambda other: F.when(empty, 0.0).when(a["norm"] == b["norm"], 1.0).when(a["bare"] == b["bare"], SAME_BUT_ARTICLES).otherwise(other)
    return known(subtitle), known(most)


#: The parts of a candidate's score.
SCORES = StructType([*(StructField(c, DoubleType()) for c in ("title_part", "title_score", "date_score", "score")), StructField("error", StringType())])


@F.pandas_udf(SCORES)
def candidate_scores(title: pd.Series, names: pd.Series, other_part: pd.Series, date_part: pd.Series, popularity_part: pd.Series) -> pd.DataFrame:
    """All parts of a candidate's score in one step, of normalised names: the best similarity of the title and a name (or
    ``other_part``, where that is known and higher), rounded to three decimals, half to even on the exact binary value.
    A row that cannot be scored has the reason in ``error``, and no score."""
    rows = []
    for t, these, known, d, p in zip(title, names, other_part, date_part, popularity_part, strict=True):
        try:
            part = max([similarity(t, n) for n in these if n is not None] + ([] if pd.isna(known) else [float(known)]), default=0.0)
            rows.append((part, round(part, 3), round(float(d), 3), round(TITLE * part + DATE * float(d) + POPULARITY * float(p), 3), None))
        except (TypeError, ValueError, OverflowError) as e:
            rows.append((None, None, None, None, f"{type(e).__name__}: {e}"))
    return pd.DataFrame(rows, columns=SCORES.names)


@F.pandas_udf(DoubleType())
def title_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """``similarity`` of two titles as they are spelt."""
    return pd.Series([similarity(normalise(x), normalise(y)) for x, y in zip(a, b, strict=True)], dtype="float64")


@F.pandas_udf(DoubleType())
def round_3(x: pd.Series) -> pd.Series:
    """Three decimals, half to even on the exact binary value."""
    return x.map(lambda v: None if pd.isna(v) else round(float(v), 3))
