"""Search, staged evaluation and bounds against every pair, one film after another."""

import math
import random
import re
from datetime import date, timedelta

from pyspark.sql import functions as F

from chartloom.functions import text
from chartloom.operators import matching
from chartloom.scratch import Scratch


def catalogue(spark, rows):
    return spark.createDataFrame(rows, "id long, title string, original_title string, release_date date, popularity double")


def test_search_by_rare_words(spark):
    """A frequent word is no key; a title of frequent words only finds the films that have all of them."""
    movies = catalogue(spark, [(i, f"The Film {'Of' if i % 2 else ''} n{i}", f"the n{i}", None, None) for i in range(60)] + [(100, "Quiet", None, None, None)])
    titles = spark.createDataFrame([("The n7",), ("of the film",), ("The",), ("the Quiet",), (None,)], "title string")
    got = {}
    for r in matching.search(titles, movies).collect():
        got.setdefault(r["title"], set()).add(r["id"])
    assert got == {"The n7": {7}, "of the film": {i for i in range(60) if i % 2}, "The": set(range(60)), "the Quiet": {100}}


def evaluated(title, estimated, movies, names, dates):
    """One film, variant after variant, every pair compared."""
    if title is None:
        return None
    words = lambda *t: {w for x in t for w in text.normalise(x).split()}
    n = {w: sum(w in words(m[1], m[2]) for m in movies) for m in movies for w in words(m[1], m[2])}
    often = {w for w, k in n.items() if k > matching.FREQUENT_FILMS and k > matching.FREQUENT_SHARE * len(movies)}
    whole = title.strip()
    bare = re.sub(r"^\.+", "", whole).strip()
    variants = list(dict.fromkeys(v for v in (whole, bare, re.split(r"\s+-\s+|:\s+", bare, maxsplit=1)[0].strip()) if v))

    def score(m, other=(), local=None):
        t = max(text.similarity(text.normalise(title), text.normalise(x)) for x in (m[1], m[2], *other))
        days = (estimated - m[3]).days if estimated and m[3] else None
        d = 0.4 if days is None else 1.0 if -21 <= days <= 150 else 1 - 0.8 * (days - 150) / 300 if 150 < days <= 450 else 1 - (-21 - days) / 69 if -90 <= days < -21 else 0.0
        if local and estimated:
            gap = min(abs((estimated - x).days) for x in local)
            d = 1.0 if gap <= 10 else 1 - 0.8 * (gap - 10) / 35 if gap <= 45 else 0.0
        p = min(1.0, math.log10(1 + m[4]) / 3) if m[4] and m[4] > 0 else 0.0
        return round(0.7 * t + 0.25 * d + 0.05 * p, 3), round(t, 3)

    found, order = {}, lambda m: (-score(m)[0], -(m[4] or 0), found[m[0]], m[0])
    best = []
    for k, v in enumerate(variants):
        q = words(v)
        for m in movies:
            w = words(m[1], m[2])
            if (q & w) - often or (q and q <= often and q <= w):
                found.setdefault(m[0], k)
        best = sorted((m for m in movies if m[0] in found), key=order)
        if best and score(best[0])[0] >= 0.55:
            break
    last = []
    for m in best[:3]:
        t = score(m)[1]
        last.append((-score(m, names.get(m[0], ()) if t < 0.9 else (), dates.get(m[0]) if t >= 0.55 else None)[0], -(m[4] or 0), found[m[0]], m[0]))
    last.sort()
    return [(x[3], -x[0]) for x in last]


def test_staged_variants_and_bounds_change_nothing(spark):
    draw = random.Random(6)
    words = ["the", "red", "blue", "moon", "Città", "night", "of", "return", "n1", "n2"]
    name = lambda: " ".join(draw.choice(words) for _ in range(draw.randint(1, 4)))
    day = lambda: draw.choice([None, date(2020, 1, 1) + timedelta(draw.randint(0, 900))])
    movies = [(i, name(), draw.choice([None, name()]), day(), draw.choice([None, 0.0, 5.0, 400.0])) for i in range(80)]
    films = [(i, draw.choice(["", "..."]) + name() + draw.choice(["", " - " + name(), ": xyz"]), day()) for i in range(60)] + [(60, None, None), (61, "", None), (62, "nothing like it", None)]
    names, dates = {i: [name()] for i in range(0, 80, 2)}, {i: [date(2020, 6, 1), date(2021, 6, 1)] for i in range(0, 80, 3)}
    of = lambda d, kind: spark.createDataFrame(list(d.items()), kind)
    alternatives = spark.createDataFrame([(i, x) for i, v in names.items() for x in v], "id long, name string")
    last, decisions = matching.evaluate(spark.createDataFrame(films, "ref long, title string, estimated date"), catalogue(spark, movies), alternatives, of(dates, "id long, dates array<date>"))
    got = {}
    for r in sorted(last.collect(), key=lambda r: (r["ref"], r["place"])):
        got.setdefault(r["ref"], []).append((r["id"], r["score"]))
    decided = {r["ref"]: r for r in decisions.collect()}
    assert len(decided) == len(films) and decided[60]["error"] and decided[60]["status"] is None
    assert matching.resolved(decisions).first().asDict()["errors"] == 1
    for ref, title, estimated in films:
        want = evaluated(title, estimated, movies, names, dates)
        assert got.get(ref, []) == (want or [])
        if want:
            margin = round(want[0][1] - (want[1][1] if len(want) > 1 else 0.0), 3)
            assert (decided[ref]["score"], decided[ref]["margin"]) == (want[0][1], margin)


def test_bounds_of_similarity(spark):
    draw = random.Random(8)
    words = ["the", "a", "il", "red", "der", "blue", "part", "two", "x", ""]
    name = lambda: " ".join(filter(None, (draw.choice(words) for _ in range(draw.randint(0, 4)))))
    df = spark.createDataFrame([(name(), name()) for _ in range(600)], "a string, b string")
    bounds = text.similarity_bounds(text.title_forms(F.col("a")), text.title_forms(F.col("b")))
    for r in df.select("a", "b", bounds[0].alias("least"), bounds[1].alias("most")).collect():
        assert r["least"] - 1e-12 <= text.similarity(r["a"], r["b"]) <= r["most"] + 1e-12


def test_few_pairs_are_compared(spark):
    movies = catalogue(spark, [(i, f"moon {'abcdefghijklmnopqrst'[i % 20] * (3 + i % 7)} {i}", None, None, float(i)) for i in range(400)])
    titles = spark.createDataFrame([("moon aaa 40", "moon aaa 40", None)], "ref string, title string, estimated date")
    found = titles.join(movies.select("id", F.lit(0).alias("variant")), F.lit(True))
    everything, some = matching.scored(found, movies).collect(), matching.best_scored(found, movies, 3, Scratch(spark, "few"), "best").collect()
    best = lambda rows: sorted(((r["score"], r["popularity"]) for r in rows), reverse=True)[:3]
    assert best(everything) == best(some) and len(everything) == 400 and len(some) < 100


def test_films_that_share_any_word(spark):
    """A word that every film has finds them all, with the first variant that has it."""
    titles = spark.createDataFrame([("The Sea",), ("Rock: the story",)], "title string")
    movies = spark.createDataFrame([(k, f"Film {k}", f"The {'sea' if k == 7 else 'land'}") for k in range(60)], "id long, title string, original_title string")
    got = {(r["title"], r["id"], r["variant"]) for r in matching.sharing(titles, movies).collect()}
    assert got == {(t, k, 0) for t in ("The Sea", "Rock: the story") for k in range(60)}


def test_films_that_wait_are_made_once(spark):
    """They come from the whole fact, and every stage reads them."""
    seen = spark.sparkContext.accumulator(0)

    def see(batches):
        for x in batches:
            seen.add(x.num_rows)
            yield x

    films = spark.createDataFrame([(1, "Sea", date(2024, 1, 4)), (2, "Sea", None), (3, None, None)], "ref long, title string, estimated date").mapInArrow(see, "ref long, title string, estimated date")
    movies = spark.createDataFrame([(7, "Sea", "Sea", date(2024, 1, 4), 1.0)], "id long, title string, original_title string, release_date date, popularity double")
    names, dates = spark.createDataFrame([], "id long, name string"), spark.createDataFrame([], "id long, dates array<date>")
    _, decisions = matching.evaluate(films, movies, names, dates)
    assert sorted(r["ref"] for r in decisions.collect()) == [1, 2, 3]
    assert seen.value == 3
