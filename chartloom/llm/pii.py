"""Personal data, and the terms that disclose it, in DataFrame expressions only.

Base spans come from patterns. Each distinct value that they find is a protected entity; documents that
hold it and documents that hold a term are counted over the whole corpus, and a term discloses an
entity by the share of the entity's information that the term carries: PMI(entity; term) over
IC(entity). The share is estimated for every entity, those of one document too; one document more, that
holds the term and the entity at its rate in the corpus, keeps what few documents say from counting in
full. Where an entity stands, terms at or over the threshold become spans of kind ``term``, which
``sanitise`` generalises like the base ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Stash, among, column, packed, unpacked

# Kinds in the order of the report. The patterns find what [A-Za-z0-9._%+-]+@..., [0-9]+(\.[0-9]+)...,
# [0-9]([\x20-]?[0-9])+ and \+[0-9][\x20().0-9-]+[0-9] find, but give up a start that a longer one has
# tried, and never give back what they have read, so that long runs take linear time.
KINDS = ("email", "ip", "card", "phone", "term")
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A character that every match of the kind has, looked for first.
MARKS = {"email": "@", "ip": None, "card": None, "phone": "+"}
TERM = r"[\p{L}\p{N}]+"

#: Documents that a term is taken to have beside its own, with the entity at its rate in the corpus.
PRIOR = 1
#: The share of an entity's information from which a term discloses it.
DISCLOSED = 0.8


def _pieces(text: Column, pattern: str) -> Column:
    """What precedes each match and the match itself, in order."""
    return F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))


def _sums(lengths: Column) -> Column:
    """Running sums of an array, in a pass for each bit of its size: in pass k every entry takes in the one 2**k before."""
    passes = F.sequence(F.lit(0), F.length(F.bin(F.size(lengths))) - 1)

    def step(sums: Column, k: Column) -> Column:
        back = F.call_function("shiftleft", F.lit(1), k)
        return F.transform(sums, lambda v, i: v + F.coalesce(F.get(sums, i - back), F.lit(0)))

    return F.aggregate(passes, lengths, step)


def _placed(pieces: Column, kind: int) -> Column:
    """(start, kind, end, found) of each piece that has a match."""
    size = lambda p, c: F.coalesce(F.length(p[c]), F.lit(0))
    ends = _sums(F.transform(pieces, lambda p: size(p, "gap") + size(p, "found")))
    some = F.filter(F.arrays_zip(pieces.alias("piece"), ends.alias("end")), lambda x: x["piece"]["found"].isNotNull())
    span = lambda x: F.struct((x["end"] - size(x["piece"], "found")).alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end"), x["piece"]["found"].alias("found"))
    return F.transform(some, span)


def _digits(found: Column) -> Column:
    return F.regexp_replace(found, "[^0-9]+", "")


def _luhn(digits: Column) -> Column:
    def value(c: Column, i: Column) -> Column:
        twice = (c.cast("int")) * F.when(i % 2 == 1, 2).otherwise(1)
        return F.when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        small = lambda p: (F.length(F.ltrim(p, F.lit("0"))) <= 3) & (F.coalesce(F.ltrim(p, F.lit("0")).try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(found, r"\."), small)
    if kind == "card":
        n = F.length(_digits(found))
        return F.when((n >= 14) & (n <= 19), _luhn(_digits(found))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(found)).between(10, 15)
    return F.lit(True)


def _holds(kind: str) -> Callable[[Column], Column]:
    return lambda span: _valid(kind, span["found"])


def _entity(span: Column) -> Column:
    """The kind and the value without what may be written differently."""
    value = F.when(span["kind"] == 0, F.lower(span["found"])).when(span["kind"] == 1, span["found"]).otherwise(_digits(span["found"]))
    return F.concat(span["kind"].cast("string"), F.lit(":"), value)


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text, key (of the row's doc_id and text) and ``base``, the sorted spans (start, kind, end, found) of each row."""
    held = docs.select(column(docs, "doc_id", "long"), F.coalesce(column(docs, "text", "string"), F.lit("")).alias("text"))
    held = held.withColumn("key", F.xxhash64("doc_id", "text")).withColumn("digit", F.col("text").rlike("[0-9]"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int,found:string>>")
    for kind in KINDS[:4]:
        mark = F.contains(F.col("text"), F.lit(MARKS[kind])) if MARKS[kind] else F.col("digit")
        held = held.withColumn(f"p_{kind}", F.when(mark, _pieces(F.col("text"), PATTERNS[kind])))
    for k, kind in enumerate(KINDS[:4]):
        found = F.when(F.size(F.col(f"p_{kind}")) > 1, _placed(F.col(f"p_{kind}"), k)).otherwise(none)
        held = held.withColumn(f"p_{kind}", F.filter(found, _holds(kind)))
    base = F.array_sort(F.concat(*[F.col(f"p_{kind}") for kind in KINDS[:4]]))
    return held.select("doc_id", "text", "key", base.alias("base"))


def _terms(rows: DataFrame) -> DataFrame:
    """(key, start, end, term) of the words outside the base spans of rows (key, text, base)."""
    every = rows.withColumn("pieces", _pieces(F.col("text"), TERM)).select("key", F.explode(_placed(F.col("pieces"), 4)).alias("x"))
    every = every.select("key", "x.start", "x.end", F.lower("x.found").alias("term"))
    every = every.unionByName(rows.select("key", F.explode("base").alias("x")).select("key", "x.start", "x.end", F.lit(None).cast("string").alias("term")))
    rows_ = Window.partitionBy("key")
    order, back = rows_.orderBy("start", F.col("term").asc_nulls_first(), "end"), rows_.orderBy(F.desc("start"), F.col("term").desc_nulls_last(), F.desc("end"))
    base = lambda c: F.when(F.col("term").isNull(), F.col(c))
    last = F.max(base("end")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    next_ = F.min(base("start")).over(back.rowsBetween(Window.unboundedPreceding, 0))
    free = every.withColumn("last", last).withColumn("next", next_).filter("term is not null")
    return free.filter((F.coalesce("last", F.lit(0)) <= F.col("start")) & (F.col("next").isNull() | (F.col("next") >= F.col("end")))).drop("last", "next")


def _counted(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(term, n_term) of the wanted terms over all documents."""
    in_row = F.array_distinct(F.regexp_extract_all(F.lower(column(docs, "text", "string")), F.lit(TERM), F.lit(0)))
    every = among(docs.select(F.explode(in_row).alias("term")), "term", wanted, "term")
    return every.groupBy("term").agg(F.count("*").alias("n_term")).join(wanted, "term", "left_semi")


def _spans(docs: DataFrame, stash: Stash) -> tuple[DataFrame, DataFrame]:
    """The rows with their base spans, and (key, added) with the spans that the corpus adds, one row for a key."""
    found = base_spans(docs)
    text = F.when(F.size("base") > 0, F.col("text"))  # kept only where something is found
    held = stash.keep(found.select("doc_id", "key", "base", text.alias("text"), F.array_distinct(F.transform("base", _entity)).alias("entities")), "base")
    total = held.count()
    named = held.filter(F.size("entities") > 0).select("key", F.explode("entities").alias("entity"))
    # entities of the same documents have the same counts, so one of them stands for all
    of = lambda *more: F.sum(F.xxhash64("key", *more).cast("decimal(20,0)"))
    sets = named.groupBy("entity").agg(F.count("*").alias("n_entity"), of().alias("s"), of(F.lit(1)).alias("t")).filter(F.col("n_entity") < total)
    known = stash.keep(sets.groupBy("n_entity", "s", "t").agg(F.min("entity").alias("entity")).select("entity", "n_entity"), "entities")
    holders = stash.keep(named.join(known, "entity"), "holders")  # a row for each entity and document that holds it
    rows = held.join(holders.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"])
    terms = stash.keep(_terms(rows), "terms")
    counted = stash.keep(_counted(docs, stash.keep(terms.select("term").distinct(), "wanted")), "counted")

    # PMI / IC >= DISCLOSED says the same as P(entity | term) >= P(entity) ** (1 - DISCLOSED)
    rate = F.col("n_entity") / F.lit(total)
    given = lambda n_both: (n_both + PRIOR * rate) / (F.col("n_term") + PRIOR)
    near = terms.select("key", "term").distinct().join(counted, "term").join(holders, "key")
    near = near.filter(given(F.col("n_entity")) >= F.pow(rate, F.lit(1 - DISCLOSED)) * (1 - 1e-9))  # no pair has more than n_entity documents
    pairs = near.groupBy("entity", "term").agg(F.count("*").alias("n_both"), F.first("n_entity").alias("n_entity"), F.first("n_term").alias("n_term"))
    share = 1 - F.log2(given(F.col("n_both"))) / F.log2(rate)
    risky = stash.keep(pairs.filter(share >= DISCLOSED).select("entity", "term"), "risky")
    hits = near.join(risky, ["entity", "term"], "left_semi").select("key", "term").distinct().join(terms, ["key", "term"])
    span = F.struct("start", F.lit(4).alias("kind"), "end", F.col("term").alias("found"))
    return held, hits.groupBy("key").agg(F.array_sort(F.collect_set(span)).alias("added"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _every(held: DataFrame, added: DataFrame) -> DataFrame:
    return held.join(added, "key", "left").withColumn("every", F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "added"))))


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term.

    A null text is empty; a null ``doc_id`` stays null; rows that are equal in doc_id and text get the
    same result, and each counts as a document; an empty table gives none. Spans that start together go by kind.
    The work on a very long text grows with its matches and the logarithm of their number. Other columns are not read.
    """
    held, added = _spans(docs, Stash(docs.sparkSession, "personal-data"))
    rows = _every(held.drop("text", "entities"), added)
    n = lambda k: F.size(F.filter("base", lambda s: s["kind"] == F.lit(k))).cast("long")
    return rows.select(
        "doc_id", *[n(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS[:4])],
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("every")).alias("spans"),
        (F.size("every") - F.size("base")).cast("long").alias("n_term"),
    )


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of the text generalised to its kind, such as [EMAIL]; where spans overlap,
    the first stands for what it covers and a later one for what is left of it."""
    held, added = _spans(docs, Stash(docs.sparkSession, "sanitise"))
    spans = _every(held.select("key", "base"), added).filter(F.size("every") > 0).select("key", "every").dropDuplicates(["key"])
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    rows = packed(docs, doc_id="long", text="string").withColumn("pii_key", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    rows = rows.join(spans.select(F.col("key").alias("pii_key"), F.col("every").alias("pii_spans")), "pii_key", "left")
    text = F.col("text")

    def step(a: Column, s: Column) -> Column:
        before = F.substring(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
        new = F.concat(a["out"], before, F.element_at(names, s["kind"] + 1))
        return F.when(s["end"] <= a["at"], a).otherwise(F.struct(s["end"].alias("at"), new.alias("out")))

    last = lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text)))
    clean = F.aggregate("pii_spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, last)
    return unpacked(rows, docs.columns, text=F.when(F.col("pii_spans").isNull(), text).otherwise(clean))
