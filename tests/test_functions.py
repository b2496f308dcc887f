from datetime import date

import pytest
from pyspark.sql import functions as F

from chartloom.functions import scores as S
from chartloom.functions import text as T


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("title", "key"), [("  Cars: Motori Ruggenti  ", "cars: motori ruggenti"), ("Blue  Film", "blue  film"), (None, "")])
def test_title_key(spark, title, key):
    assert value(spark, T.title_key(F.lit(title).cast("string"))) == key


@pytest.mark.parametrize(("text", "cents"), [("€ 1.234.567", 123456700), ("1.234,56", 123456), ("504.61", 5046100)])
def test_parse_euro(spark, text, cents):
    assert value(spark, T.parse_euro(F.lit(text))) == cents


@pytest.mark.parametrize(
    ("text", "start", "end"),
    [
        ("Classifica dal 2 febbraio 2024 al 8 febbraio 2024", date(2024, 2, 2), date(2024, 2, 8)),
        ("DAL 30 Luglio al 02 agosto 2026", date(2026, 7, 30), date(2026, 8, 2)),
        ("dal 16 al 19 luglio 2026", date(2026, 7, 16), date(2026, 7, 19)),
        ("dal 30 dicembre al 02 gennaio 2027", date(2027, 12, 30), date(2027, 1, 2)),
        ("nothing here", None, None),
    ],
)
def test_week_range(spark, text, start, end):
    assert tuple(value(spark, T.week_range(F.lit(text)))) == (start, end)


@pytest.mark.parametrize(
    ("title", "variants"),
    [("...che Dio perdona", ["...che Dio perdona", "che Dio perdona"]), ("The Dog Stars - Le Stelle", ["The Dog Stars - Le Stelle", "The Dog Stars"]), ("Toy: Story", ["Toy: Story", "Toy"]), ("Solo", ["Solo"])],
)
def test_query_variants(spark, title, variants):
    assert value(spark, T.query_variants(F.lit(title))) == variants


@pytest.mark.parametrize(
    ("a", "b", "low", "high"),
    [
        ("Odissea", "odissea", 1.0, 1.0), ("Il Padrino", "Padrino", 0.97, 0.97), ("The Dog Stars - Le Stelle Dopo la Fine", "The Dog Stars", 0.88, 0.88),
        ("Election Day", "Election Day - The Day Thailand Changed", 0.78, 0.78), ("", "x", 0, 0), (None, "x", 0, 0), ("tide", "diet", 0.25, 0.25), ("diet", "tide", 0.5, 0.5),
    ],
)
def test_similarity(a, b, low, high):
    assert low <= round(T.similarity(T.normalise(a), T.normalise(b)), 6) <= high


@pytest.mark.parametrize(("title", "plain"), [("Perché NO?!", "perche no"), ("Straße", "strasse"), ("日本", ""), (None, "")])
def test_normalise(title, plain):
    assert T.normalise(title) == plain


@pytest.mark.parametrize(("days", "score"), [(0, 1.0), (150, 1.0), (450, 0.2), (451, 0.0), (-21, 1.0), (-90, 0.0), (-91, 0.0)])
def test_date_score(spark, days, score):
    day = F.lit("2020-01-01").cast("date")
    assert value(spark, S.date_score(F.date_add(day, days), day)) == pytest.approx(score)


def test_unknown_dates(spark):
    day, none = F.lit("2020-01-01").cast("date"), F.lit(None).cast("date")
    assert value(spark, S.date_score(day, none)) == 0.4
    assert value(spark, S.local_release_score(day, F.array().cast("array<date>"))) is None
    assert value(spark, S.local_release_score(day, F.array(F.date_add(day, 45)))) == pytest.approx(0.2)


@pytest.mark.parametrize(("best", "second", "status"), [(0.95, 0.5, "auto"), (0.95, 0.85, "needs_review"), (0.92, 0.88, "needs_review"), (0.7, None, "needs_review"), (0.3, None, "no_match"), (None, None, "no_match")])
def test_decision(spark, best, second, status):
    number = lambda x: F.lit(x).cast("double")
    assert value(spark, S.decision(number(best), number(second))) == status


def test_estimated_release(spark):
    week = F.lit("2026-09-17").cast("date")
    assert value(spark, S.estimated_release(week, F.lit(3))) == date(2026, 9, 3)
    assert value(spark, S.estimated_release(week, F.lit(0))) == value(spark, S.estimated_release(week, F.lit(None).cast("int"))) == date(2026, 9, 17)
