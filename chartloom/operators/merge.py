"""Upserts and link repair as pure transitions: the old state and the new rows give the new state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..scratch import Scratch
from . import relational as R


def upsert(old: DataFrame, new: DataFrame, keys: tuple[str, ...], overwrite: tuple[str, ...], keep_old_if_null: tuple[str, ...] = ()) -> DataFrame:
    """Rows of ``old`` and ``new`` (one a key in either); where both have a key, ``overwrite`` takes the new
    value, ``keep_old_if_null`` the new one unless it is null, and all other columns stay."""
    n = new.select(*[F.col(k).alias(f"n_{k}") for k in new.columns], F.lit(True).alias("n_there"))
    o = old.withColumn("o_there", F.lit(True))
    joined = o.join(n, [F.col(k).eqNullSafe(F.col(f"n_{k}")) for k in keys], "full_outer")  # a row without a key's part meets itself again

    def value(c: str) -> Column:
        fresh = F.col(f"n_{c}") if c in new.columns else F.lit(None)
        if c in overwrite:
            return F.when(F.col("n_there"), fresh).otherwise(F.col(c))
        if c in keep_old_if_null:
            return F.when(F.col("n_there"), F.coalesce(fresh, F.col(c))).otherwise(F.col(c))
        return F.when(F.col("o_there"), F.col(c)).otherwise(fresh)

    return joined.select(*[value(c).alias(c) for c in old.columns])


#: What a load changes in every row that it writes; ``created_at`` stays as the first one has set it.
STAMPS = ("ingestion_run_id", "updated_at")


def stamped(batch: DataFrame, columns: list[str], run_id: int | None, at: int | None) -> DataFrame:
    """The batch with the run and the time (microseconds) of its load, where the table has columns for them."""
    values = {"ingestion_run_id": run_id, "created_at": at, "updated_at": at}
    return batch.withColumns({c: F.lit(v).cast("long") for c, v in values.items() if c in columns})


def upsert_chart(old: DataFrame, batch: DataFrame) -> DataFrame:
    """A batch of chart rows, one for each natural key, over the fact table. Links are never taken away."""
    stamps = tuple(c for c in STAMPS if c in old.columns)
    return upsert(
        old, R.dedupe(batch), R.KEY, (*stamps, "week_end", "rank", "title", "distributor", "weekly_gross", "total_gross", "screen_count", "weeks_in_release"), ("movie_id", "source_movie_ref")
    )


def upsert_films(old: DataFrame, batch: DataFrame) -> DataFrame:
    """Films as the source knows them: the first of a batch counts, and matches are not touched."""
    first = R.first_by(batch, ("source_name", "source_movie_id"), F.col("seq")).drop("seq")
    return upsert(old, first, ("source_name", "source_movie_id"), ("title", "title_key"), ("source_url",))


def upsert_movies(old: DataFrame, batch: DataFrame) -> DataFrame:
    """Catalogue films: the last value of every column."""
    return upsert(old, batch, ("id",), tuple(c for c in old.columns if c not in ("id", "created_at")))


def insert_absent(old: DataFrame, new: DataFrame, keys: tuple[str, ...], parts: int | None = None) -> DataFrame:
    return old.unionByName(R.dealt(new, parts, *keys).dropDuplicates(list(keys)).join(old, list(keys), "left_anti").select(*old.columns))


def load_batch(fact: DataFrame, films: DataFrame, batch: DataFrame, run_id: int | None = None, at: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The fact, the films and (rows) after a batch of records with source_movie_id and source_url, by a run at a time.

    Films of the batch are added or renamed first. Each record then takes its film's id, and the film's movie
    where it brings none (or 0) of its own; a record without source_movie_id is stored without film.
    """
    seen = batch.filter("source_movie_id is not null").withColumn("seq", F.col("id"))
    named = seen.select(F.col("id"), "source_name", "source_movie_id", "title", "title_key", "source_url", F.lit(None).cast("long").alias("movie_id"), F.lit("unmatched").alias("match_status"), "seq")
    absent = [F.lit(None).cast(films.schema[c].dataType).alias(c) for c in films.columns if c not in named.columns]
    films = upsert_films(films, named.select("*", *absent).select(*films.columns, "seq"))
    known = films.select(F.col("source_name").alias("f_source"), F.col("source_movie_id").alias("f_id"), F.col("id").alias("f_ref"), F.col("movie_id").alias("f_movie"))
    linked = batch.join(known, (F.col("source_name") == F.col("f_source")) & (F.col("source_movie_id") == F.col("f_id")), "left")
    linked = stamped(linked, fact.columns, run_id, at).withColumn("source_movie_ref", F.col("f_ref")).withColumn("movie_id", F.coalesce(F.nullif("movie_id", F.lit(0)), "f_movie")).select(*fact.columns)
    return upsert_chart(fact, linked), films, R.dedupe(linked).agg(F.count("*").alias("rows"))


def replace_children(old: DataFrame, new: DataFrame, parent: str, parents: DataFrame | None = None) -> DataFrame:
    """All rows of the ``parents`` (of those that ``new`` has, if none are given) give way to the rows of ``new``; a
    parent without new rows is cleared."""
    gone = new.select(parent) if parents is None else parents.select(parent)
    return old.join(gone.distinct(), parent, "left_anti").select(*old.columns).unionByName(new)


#: Rows of one film from which on they are told apart, so that they do not meet in one task.
CROWD = 10_000


def propagate_match(fact: DataFrame, films: DataFrame, parts: int | None = None, crowded: DataFrame | None = None) -> DataFrame:
    """The fact with the movie of each film that is decided, and whether that changed the row. Where they are not
    broadcast, films are dealt to that many parts at least, and rows follow them. Rows meet the few ``crowded`` films (of
    ``films``, those with many rows) first, and then are spread."""
    decided = films.filter(F.col("match_status").isin("auto", "manual")).select(F.col("id").alias("ref"), F.col("movie_id").alias("decided"))
    if crowded is None:
        joined = R.with_film(fact, R.dealt(decided, parts, "ref"), "ref")
    else:
        c = crowded.select(F.col("id").alias("c_ref"), F.col("match_status").isin("auto", "manual").alias("c_known"), F.col("movie_id").alias("c_movie"))
        met = R.with_film(fact, R.dealt(c, parts, "c_ref"), "c_ref")
        joined = R.with_film(met, R.dealt(decided, parts, "ref"), "ref", F.col("c_ref").isNotNull())
        joined = joined.withColumns({"ref": F.coalesce("ref", F.when(F.col("c_known"), F.col("c_ref"))), "decided": F.coalesce("decided", "c_movie")})
    differs = F.col("ref").isNotNull() & ~F.col("movie_id").eqNullSafe(F.col("decided"))
    return joined.withColumn("changed", differs).withColumn("movie_id", F.when(differs, F.col("decided")).otherwise(F.col("movie_id"))).select(*fact.columns, "changed")


def manual_override(films: DataFrame, decisions: DataFrame) -> DataFrame:
    """Decisions by hand (id, movie_id; null for none) over what was decided before; they are not asked again."""
    d = decisions.select(F.col("id").alias("d_id"), F.col("movie_id").alias("d_movie"))
    joined = films.join(d, F.col("id") == F.col("d_id"), "left")
    by_hand = F.col("d_id").isNotNull()
    pick = lambda c, v: F.when(by_hand, v).otherwise(F.col(c)).alias(c)
    changed = {
        "movie_id": F.col("d_movie"), "match_status": F.when(F.col("d_movie").isNull(), "no_match").otherwise("manual"), "match_method": F.lit("manual"),
        "match_confidence": F.when(F.col("d_movie").isNotNull(), F.lit(1000).cast("long")),
    }
    return joined.select(*[pick(c, changed[c]) if c in changed else F.col(c) for c in films.columns])


def legacy_pairs(films: DataFrame) -> DataFrame:
    """Each legacy film with the first real film of its title, unless both are matched with different movies."""
    legacy = films.filter(F.col("source_movie_id").startswith("legacy:")).select(F.col("id").alias("legacy_id"), "source_name", "title_key", F.col("movie_id").alias("legacy_movie"), F.col("match_status").alias("legacy_status"), F.col("match_method").alias("legacy_method"), F.col("match_confidence").alias("legacy_confidence"))
    real = R.first_real(films).select(F.col("id").alias("real_id"), "source_name", "title_key", F.col("movie_id").alias("real_movie"))
    return legacy.join(real, ["source_name", "title_key"]).filter(F.col("legacy_movie").isNull() | F.col("real_movie").isNull() | (F.col("legacy_movie") == F.col("real_movie")))


def link_legacy(fact: DataFrame, films: DataFrame, parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The fact and the films after the whole repair. Done twice it changes nothing more.

    Decided matches go from legacy films to their real ones, their rows too; legacy films without rows
    go; rows without film get the first real one of their title, or else a new legacy film; undecided
    films take the one movie that all their rows have; rows take the movie of their film. Fact and films are written
    between the steps, as each step reads the ones before several times; other columns of the fact are kept.

    What a step looks up is dealt to ``parts`` parts at least, and the fact follows it where there is no broadcast. Films by
    title, and those with many rows (the repair gives all such rows of a title to one film), are written first, so that
    Spark knows how few they are before it moves the fact.
    """
    scratch = Scratch(films.sparkSession, "legacy")
    fact, films = scratch.keep(fact, "fact-0"), scratch.keep(films, "films-0")
    pairs = scratch.keep(legacy_pairs(films), "pairs")
    # matches: from the legacy film with the least id
    decided = R.first_by(pairs.filter(F.col("legacy_status").isin("auto", "manual")), ("real_id",), F.col("legacy_id"))
    d = decided.select(F.col("real_id").alias("d_id"), "legacy_movie", "legacy_status", "legacy_method", "legacy_confidence")
    joined = films.join(R.dealt(d, parts, "d_id"), F.col("id") == F.col("d_id"), "left")
    takes = F.col("d_id").isNotNull() & ~F.col("match_status").isin("auto", "manual") & ~F.col("match_method").eqNullSafe(F.lit("manual"))
    source = {"movie_id": "legacy_movie", "match_status": "legacy_status", "match_method": "legacy_method", "match_confidence": "legacy_confidence"}
    films = joined.select(*[F.when(takes, F.col(source[c])).otherwise(F.col(c)).alias(c) if c in source else F.col(c) for c in films.columns])
    films = scratch.keep(films, "films-1")
    by_title = lambda found: found.select(F.col("source_name").alias("r_source"), F.col("title_key").alias("r_key"), F.col("id").alias("r_id"))

    def link(rows: DataFrame, to: DataFrame) -> DataFrame:
        """Rows without film take the one of their title; those with one are spread by their own id."""
        key = F.when(F.col("source_movie_ref").isNull(), F.col("title_key")).otherwise(F.col("id").cast("string"))
        meets = (F.col("source_name") == F.col("r_source")) & (key == F.col("r_key")) & F.col("source_movie_ref").isNull()
        return rows.join(R.dealt(to, parts, "r_source", "r_key"), meets, "left").withColumn("source_movie_ref", F.coalesce("source_movie_ref", "r_id")).drop("r_source", "r_key", "r_id")

    # rows of legacy films, then rows without film; legacy films without rows go
    moved = pairs.select(F.col("legacy_id").alias("m_from"), F.col("real_id").alias("m_to"))
    real = scratch.keep(by_title(R.first_real(films)), "real")
    fact = R.with_film(fact, R.dealt(moved, parts, "m_from"), "m_from").withColumn("source_movie_ref", F.coalesce("m_to", "source_movie_ref")).drop("m_from", "m_to")
    fact = scratch.keep(link(fact, real), "fact-2")
    used = R.dealt(fact.filter("source_movie_ref is not null").select(F.col("source_movie_ref").alias("id")), parts, "id").distinct()
    legacy = F.col("source_movie_id").startswith("legacy:")
    films = films.filter(~legacy).unionByName(films.filter(legacy).join(used, "id", "left_semi").select(*films.columns))
    films = scratch.keep(films, "films-2")
    fresh = fact.filter("source_movie_ref is null").groupBy("source_name", "title_key").agg(F.min("title").alias("title"), F.min("id").alias("first_row"))
    named = F.concat(F.lit("legacy:"), F.col("title_key"))
    made = fresh.select((-F.col("first_row")).alias("id"), "source_name", named.alias("source_movie_id"), "title", "title_key", F.lit(None).cast("long").alias("movie_id"), F.lit("unmatched").alias("match_status"), F.lit(None).cast("string").alias("match_method"), F.lit(None).cast("long").alias("match_confidence"))
    films = scratch.keep(insert_absent(films, made, ("source_name", "source_movie_id"), parts), "films-3")
    holders = scratch.keep(by_title(R.first_by(films.filter(legacy), ("source_name", "title_key"), F.col("id"))), "holders")
    fact = scratch.keep(link(fact, holders), "fact-3")
    # the one movie of an undecided film's rows
    held = scratch.keep(by_film(fact, parts), "held")
    adopted = held.filter("movie_id = last").select(F.col("source_movie_ref").alias("a_id"), F.col("movie_id").alias("a_movie"))
    joined = films.join(R.dealt(adopted, parts, "a_id"), F.col("id") == F.col("a_id"), "left")
    adopts = F.col("a_id").isNotNull() & (F.col("match_status") == "unmatched")
    change = {"movie_id": F.col("a_movie"), "match_status": F.lit("auto"), "match_method": F.lit("legacy_exact_title")}
    films = joined.select(*[F.when(adopts, change[c]).otherwise(F.col(c)).alias(c) if c in change else F.col(c) for c in films.columns])
    films = scratch.keep(films, "films-4")
    many = held.filter(F.col("rows") >= CROWD).select(F.col("source_movie_ref").alias("id"))
    crowded = scratch.keep(films.join(R.dealt(many, parts, "id"), "id", "left_semi"), "crowded")
    fact = scratch.keep(propagate_match(fact, films, parts, crowded).drop("changed"), "fact-4")
    scratch.drop("pairs", "real", "holders", "held", "crowded", *[f"{t}-{k}" for t in ("fact", "films") for k in range(4)])
    return fact, films


def by_film(fact: DataFrame, parts: int | None = None) -> DataFrame:
    """The rows of each film, with the least movie and the last."""
    rows = fact.filter("source_movie_ref is not null").select("source_movie_ref", "movie_id")
    return R.dealt(rows, parts, "source_movie_ref").groupBy("source_movie_ref").agg(F.min("movie_id").alias("movie_id"), F.max("movie_id").alias("last"), F.count("*").alias("rows"))


def adoptable(fact: DataFrame, parts: int | None = None) -> DataFrame:
    """Films whose rows have exactly one movie: the least is the greatest."""
    return by_film(fact.filter("movie_id is not null"), parts).filter("movie_id = last").select("source_movie_ref", "movie_id")


def legacy_titles(fact: DataFrame) -> DataFrame:
    """One legacy film to make for each title of rows without film, under the least spelling."""
    return fact.filter("source_movie_ref is null").groupBy("source_name", "title_key").agg(F.min("title").alias("title")).withColumn("source_movie_id", F.concat(F.lit("legacy:"), F.col("title_key")))


def legacy_orphans(films: DataFrame, fact: DataFrame) -> DataFrame:
    return films.filter(F.col("source_movie_id").startswith("legacy:")).join(fact.select(F.col("source_movie_ref").alias("id")).distinct(), "id", "left_anti")
