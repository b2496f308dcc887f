"""Matching of charted titles with a catalogue: search by rare words, staged variants, two passes of scores, decision,
and what a decision changes.

``evaluate`` writes a table after each variant, as whether a title needs the next one depends on what the ones before
have found; every other step is one plan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import scores as S
from ..functions.text import candidate_scores, normalise_title, query_variants, round_3, similarity_bounds, title_forms
from ..scratch import Scratch
from . import merge
from . import relational as R

#: Candidates that are scored again, and candidates that are stored.
REFINED, STORED = 3, 5
#: Titles less alike than this are tried under their alternative names.
SURE_TITLE = 0.9
#: Variants that a title can have.
VARIANTS = 3
#: A word is frequent if it is in more films than this, and in more than this share of the catalogue.
FREQUENT_FILMS, FREQUENT_SHARE = 20, 0.02
METHOD = "catalogue_search"


def _words(normalised: Column) -> Column:
    return F.filter(F.array_distinct(F.split(normalised, " ")), lambda w: w != "")


def called(movies: DataFrame) -> DataFrame:
    """(id, word) of the words that a film's names have."""
    names = movies.select("id", F.concat_ws(" ", normalise_title("title"), normalise_title("original_title")).alias("names"))
    return names.select("id", F.explode(_words(F.col("names"))).alias("word"))


class Index:
    """The catalogue by word: ``rare`` (word, id) and, of words that are too frequent to be keys, ``frequent``
    (word, n) and ``common`` (id, words): the frequent words of each film."""

    def __init__(self, movies: DataFrame, scratch: Scratch | None = None):
        words = called(movies)
        words = scratch.keep(words, "called") if scratch else words
        counted = words.groupBy("word").agg(F.count("*").alias("n"))
        share = F.coalesce(movies.select(F.count("*").alias("n")).scalar(), F.lit(0)) * FREQUENT_SHARE
        self.frequent = counted.filter((F.col("n") > FREQUENT_FILMS) & (F.col("n") > share))
        self.frequent = scratch.keep(self.frequent, "frequent") if scratch else self.frequent
        self.rare = words.join(self.frequent, "word", "left_anti").select("word", "id")
        self.common = words.join(self.frequent, "word").groupBy("id").agg(F.collect_set("word").alias("words"))


def variants(titles: DataFrame) -> DataFrame:
    """(title, variant, query) of the distinct titles, in the order in which variants are tried."""
    return titles.select("title").distinct().select("title", F.posexplode(query_variants(F.col("title"))).alias("variant", "query"))


def find(queries: DataFrame, index: Index) -> DataFrame:
    """(title, variant, id) of the films that a query finds: those that share a word with it that is not frequent. A query
    all of whose words are frequent finds the films that have all of them.

    No frequent word is a key, but for the rarest one of such a query, whose films are then held against the rest."""
    asked = queries.select("title", "variant", _words(normalise_title("query")).alias("asked"))
    words = asked.withColumn("word", F.explode("asked"))
    by_rare = words.join(index.rare, "word").select("title", "variant", "id")
    marked = words.join(index.frequent, "word", "left").groupBy("title", "variant", "asked").agg(F.count_if(F.col("n").isNull()).alias("n_rare"), F.min_by("word", F.struct("n", "word")).alias("word"))
    only = marked.filter("n_rare = 0")
    held = index.common.withColumn("word", F.explode("words"))
    whole = only.join(held, "word").filter(F.size(F.array_except("asked", "words")) == 0)
    return by_rare.unionByName(whole.select("title", "variant", "id")).distinct()


def search(titles: DataFrame, movies: DataFrame) -> DataFrame:
    """(title, id, variant) of the films that a variant of a title finds; a film counts with the first that finds it."""
    return find(variants(titles), Index(movies)).groupBy("title", "id").agg(F.min("variant").alias("variant"))


def sharing(titles: DataFrame, movies: DataFrame) -> DataFrame:
    """(title, id, variant) of the films that share any word with a variant of a title, frequent words too; a film counts
    with the first variant."""
    asked = variants(titles).select("title", "variant", F.explode(_words(normalise_title("query"))).alias("word"))
    return asked.join(called(movies), "word").groupBy("title", "id").agg(F.min("variant").alias("variant"))


def forms(movies: DataFrame) -> DataFrame:
    """The catalogue with the forms of its names."""
    rows = movies.withColumn("a", normalise_title("title")).withColumn("b", normalise_title("original_title"))
    return rows.select("id", F.col("title").alias("movie_title"), "original_title", "release_date", "popularity", title_forms(F.col("a")).alias("a_name"), title_forms(F.col("b")).alias("b_name"))


def pairs(found: DataFrame, movies: DataFrame) -> DataFrame:
    """What is found with the forms of its names, the parts of the score that need no comparison of names, and the most
    that the whole score can be."""
    named = found.select("title").distinct().withColumn("norm", normalise_title("title")).select("title", title_forms(F.col("norm")).alias("t_name"))
    rows = found.join(named, "title").join(forms(movies), "id")
    rows = rows.withColumn("date_part", S.date_score(F.col("estimated"), F.col("release_date"))).withColumn("popularity_part", S.popularity_score(F.col("popularity")))
    most = F.greatest(*[similarity_bounds(F.col("t_name"), F.col(c))[1] for c in ("a_name", "b_name")])
    rows = rows.withColumn("most", S.total_score(most, F.col("date_part"), F.col("popularity_part")))
    names = F.array("a_name.norm", "b_name.norm").alias("names")
    return rows.select(*[c for c in rows.columns if c not in ("a_name", "b_name", "t_name")], F.col("t_name.norm").alias("norm"), names)


def compared(rows: DataFrame) -> DataFrame:
    """The pairs with all parts of the score and their rounded total, from one step that compares names."""
    parts = candidate_scores("norm", "names", F.lit(None).cast("double"), "date_part", "popularity_part")
    return rows.withColumn("s", parts).select(*[c for c in rows.columns if c not in ("names", "most")], "s.title_part", "s.title_score", "s.date_score", "s.score", "s.error")


def scored(found: DataFrame, movies: DataFrame) -> DataFrame:
    """(title, estimated, id, ...) with the parts of the score and their rounded total."""
    return compared(pairs(found, movies))


def best_scored(found: DataFrame, movies: DataFrame, n: int, scratch: Scratch, label: str) -> DataFrame:
    """``scored``, without pairs that cannot be among the ``n`` best of their ``ref``.

    The n pairs that can score most are compared first; of the others, only those that can still reach the last of them."""
    rows = scratch.keep(pairs(found, movies), f"{label}-pairs")
    turn = Window.partitionBy("ref").orderBy(F.col("most").desc(), "id")
    turns = scratch.keep(rows.withColumn("turn", F.row_number().over(turn)), f"{label}-turns")
    first = scratch.keep(compared(turns.filter(F.col("turn") <= n)), f"{label}-first")
    last = first.groupBy("ref").agg(F.min("score").alias("last"), F.count("score").alias("n")).filter(F.col("n") == n).select("ref", "last")
    rest = turns.filter(F.col("turn") > n).join(last, "ref", "left").filter(F.col("last").isNull() | (F.col("most") >= F.col("last") - 0.001)).drop("last")  # scores are rounded to 0.001
    return scratch.keep(first.unionByName(compared(rest)).drop("turn"), label)


def ranked(rows: DataFrame, key: str = "title") -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.col("score").desc(), F.coalesce("popularity", F.lit(0.0)).desc(), "variant", "id")
    return rows.withColumn("place", F.row_number().over(order).cast("long"))


def evaluate(films: DataFrame, movies: DataFrame, alternatives: DataFrame, local_dates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The ranked candidates (ref, id, movie_title, original_title, release_date, popularity, title_score, date_score, score,
    place) and the decisions (ref, status, movie_id, score, margin, error) for films (ref, title, estimated).

    A variant is searched only for films that the ones before left without a plausible candidate, and finds films that
    they have not found. The three best are scored again with alternative titles (id, name), where the title is not sure,
    and the country's own dates (id, dates), where it is plausible; then the best and the next decide. A film without
    title, or with a candidate that cannot be scored, has an ``error`` and no status.
    """
    scratch = Scratch(films.sparkSession, "matching")
    films = scratch.keep(films.select("ref", "title", "estimated"), "films")  # every stage reads them, and they come from the whole fact
    named = films.filter("title is not null")
    index = Index(movies, scratch)
    queries = scratch.keep(variants(named), "queries")
    stages: list[DataFrame] = []
    for k in range(VARIANTS):
        open_ = named
        if stages:
            seen = reduce(DataFrame.unionByName, stages)
            plausible = seen.groupBy("ref").agg(F.max("score").alias("best"), F.max("error").alias("bad")).filter((F.col("best") >= S.REVIEW) | F.col("bad").isNotNull())
            open_ = scratch.keep(named.join(plausible, "ref", "left_anti"), f"open-{k}")
        asked = queries.filter(F.col("variant") == k).join(open_.select("title").distinct(), "title", "left_semi")
        found = open_.join(find(asked, index), "title")
        if stages:
            found = found.join(seen.select("ref", "id"), ["ref", "id"], "left_anti")
        stages.append(best_scored(found, movies, REFINED, scratch, f"stage-{k}"))
    first = reduce(DataFrame.unionByName, stages)
    failed = first.filter("error is not null").groupBy("ref").agg(F.min("error").alias("error"))

    top = ranked(first.filter("error is null"), "ref").filter(F.col("place") <= REFINED).drop("place", "error")
    names = alternatives.groupBy("id").agg(F.collect_set(normalise_title("name")).alias("names"))
    rows = top.join(names, "id", "left").join(local_dates.select("id", "dates"), "id", "left")
    names = F.when(F.col("title_score") < SURE_TITLE, F.coalesce("names", F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))
    local = F.when(F.col("title_score") >= S.REVIEW, S.local_release_score(F.col("estimated"), F.col("dates")))
    again = candidate_scores("norm", names, "title_part", F.coalesce(local, F.col("date_part")), "popularity_part")
    again = rows.withColumn("s", again).select("ref", "id", "variant", "movie_title", "original_title", "release_date", "popularity", "s.title_score", "s.date_score", "s.score")
    last = scratch.keep(ranked(again, "ref").drop("variant"), "ranked")

    at = lambda k, c: F.max(F.when(F.col("place") == k, F.col(c)))
    decided = last.groupBy("ref").agg(at(1, "score").alias("score"), at(2, "score").alias("second"), at(1, "id").alias("movie_id"))
    error = F.coalesce("error", F.when(F.col("title").isNull(), "the film has no title"))
    out = films.join(decided, "ref", "left").join(failed, "ref", "left").withColumn("error", error)
    out = out.withColumn("status", F.when(F.col("error").isNull(), S.decision(F.col("score"), F.col("second"))))
    of = lambda c: F.when(F.col("error").isNull(), c)
    out = out.select("ref", "status", F.when(F.col("status") == "auto", F.col("movie_id")).alias("movie_id"), of(F.col("score")).alias("score"), of(round_3(F.col("score") - F.coalesce("second", F.lit(0.0)))).alias("margin"), "error")
    out = scratch.keep(out, "decisions")
    scratch.drop("films", "called", "frequent", "queries", *[f"{t}-{k}{x}" for t in ("open", "stage") for k in range(VARIANTS) for x in ("", "-pairs", "-turns", "-first")])
    return last, out


def two_pass(titles: DataFrame, movies: DataFrame, alternatives: DataFrame, local_dates: DataFrame) -> DataFrame:
    """(title, status, movie_id, score, margin) for (title, estimated), by ``evaluate``."""
    films = titles.groupBy("title").agg(F.min("estimated").alias("estimated"))
    _, decisions = evaluate(films.select(F.col("title").alias("ref"), "title", "estimated"), movies, alternatives, local_dates)
    return decisions.select(F.col("ref").alias("title"), "status", "movie_id", "score", "margin")


def decide(candidates: DataFrame) -> DataFrame:
    """The decision for each parent of ranked candidates (source_movie_id, movie_id, score, place); scores in thousandths."""
    score = F.col("score") / F.lit(1000.0)
    rows = candidates.groupBy("source_movie_id").agg(F.max(F.when(F.col("place") == 1, score)).alias("best"), F.max(F.when(F.col("place") == 2, score)).alias("second"), F.max(F.when(F.col("place") == 1, F.col("movie_id"))).alias("movie_id"))
    return rows.withColumn("status", S.decision(F.col("best"), F.col("second")))


def summary(decisions: DataFrame) -> DataFrame:
    """One row: decisions by status."""
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return decisions.agg(n("auto"), n("needs_review"), n("no_match"), F.count("*").alias("total"))


def resolved(decisions: DataFrame) -> DataFrame:
    """One row: decisions by status, films that failed, and all."""
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return decisions.agg(n("auto"), n("needs_review"), n("no_match"), F.count("error").alias("errors"), F.count("*").alias("total"))


def persist(
    films: DataFrame, fact: DataFrame, movies: DataFrame, stored: DataFrame, ranked_: DataFrame, decisions: DataFrame, details: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The films, the fact, the catalogue and the stored candidates after decisions (ref, status, movie_id, score, error).

    A decided film takes its status, movie, method and score in thousandths, and its rows that movie, none included. A sure
    one brings the catalogue's ``details`` of its movie and has no more candidates to choose from; others keep the first
    five of ``ranked_`` (source_movie_id, place, ...), or none. A film that failed stays as it was, in all tables.
    """
    done = decisions.filter("error is null").select(F.col("ref").alias("d_ref"), F.col("status").alias("d_status"), F.col("movie_id").alias("d_movie"), F.round(F.col("score") * 1000).cast("long").alias("d_score"))
    joined = films.join(done, F.col("id") == F.col("d_ref"), "left")
    change = {"movie_id": F.col("d_movie"), "match_status": F.col("d_status"), "match_method": F.lit(METHOD), "match_confidence": F.col("d_score")}
    new_films = joined.select(*[F.when(F.col("d_ref").isNotNull(), change[c]).otherwise(F.col(c)).alias(c) if c in change else F.col(c) for c in films.columns])
    rows = fact.join(done, F.col("source_movie_ref") == F.col("d_ref"), "left")
    new_fact = rows.withColumn("movie_id", F.when(F.col("d_ref").isNotNull(), F.col("d_movie")).otherwise(F.col("movie_id"))).select(*fact.columns)
    sure = done.filter("d_status = 'auto'")
    new_movies = merge.upsert_movies(movies, details.join(sure.select(F.col("d_movie").alias("id")).distinct(), "id", "left_semi"))
    keep = ranked_.filter(F.col("place") <= STORED).join(done.filter("d_status <> 'auto'").select(F.col("d_ref").alias("source_movie_id")), "source_movie_id", "left_semi")
    parents = done.select(F.col("d_ref").alias("source_movie_id"))
    new_stored = merge.replace_children(stored, keep.select(*stored.columns), "source_movie_id", parents)
    return new_films, new_fact, new_movies, new_stored


def resolve_pending(films: DataFrame, fact: DataFrame, movies: DataFrame, stored: DataFrame, alternatives: DataFrame, local_dates: DataFrame, statuses: tuple[str, ...] = ("unmatched",), limit: int | None = None):
    """``persist`` after ``evaluate`` over the films that wait: the four new tables, and the counters.

    The film's first chart week gives its estimated release. A caller who wants a dry run takes the counters only."""
    pending = R.pending_matches(films, fact, statuses, limit)
    estimated = F.when(F.col("first_week").isNotNull(), S.estimated_release(F.col("first_week"), F.col("first_weeks_in_release")))
    last, decisions = evaluate(pending.select(F.col("id").alias("ref"), "title", estimated.alias("estimated")), movies, alternatives, local_dates)
    ranked_ = last.select(F.col("ref").alias("source_movie_id"), F.col("id").alias("movie_id"), F.round(F.col("score") * 1000).cast("long").alias("score"), "popularity", F.col("place").alias("seq"), "place")
    return (*persist(films, fact, movies, stored, ranked_, decisions, movies), resolved(decisions))
