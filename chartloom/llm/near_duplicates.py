"""Near-duplicate documents: minima of many universal hashes, banding, signature verification, links
confirmed on the full sets, and connected components.

Rows with equal sets are one class; only one signature of it goes on. Candidates are classes that share a
band. A band's bucket is never expanded into all its pairs. Every bucket has a pivot, first the member that
meets most others in all its buckets, which is the middle of a group of copies, then one that a hash
chooses; in each round a class is held against the pivot that it shares most bands with, and what that
links becomes one component. Of members of one bucket that are then still in different components, those
pairs become rows, once each, whose sizes allow the similarity and whose signatures agree. So a link can only be left out where it would join what is joined already. One plan serves every size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stash, WordHashes, among, batches, column, mix, packed, short, unpacked, windows
from .graph import components

#: 80 bands of 8: two sets at the least similarity of 0.8 share no band with a probability of 4 in 10 million;
#: two that have a quarter in common, such as a passage that very many documents hold, share one in 1 of 800.
BANDS, ROWS = 80, 8
#: Rounds of pivots before members are held against each other.
ROUNDS = 2
SEED = 20_011
#: Signatures of so many bits for each hash estimate a similarity within 0.0188 (one standard deviation, at 0.8);
#: five of them are left.
BITS, SLACK = 2, 0.094
#: Parities of the number of shingles in so many classes: they differ in no more classes than two sets differ in
#: shingles, so a pair that differs in too many is not similar for certain.
PARITIES = 1024
#: Shingles that are hashed at a time, so that the table of hashes stays in a core's cache.
BLOCK = 256


def _coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    drawn = np.random.Generator(np.random.PCG64(SEED)).integers(0, 2**32, (2, n, 1), np.uint32)
    return drawn[0] | np.uint32(1), drawn[1]


def shingles(text: str | None, size: int, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's shingles: words in ASCII lower case, ``size`` in a row.

    With fewer words the whole sequence is the only shingle; without words there is none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = hashes(words)
    return np.unique(windows(h, size)) if len(words) >= size else windows(h, len(words)) + np.uint64(len(words))


def minima(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each hash a * x + b (modulo 2**32, where the high bits count) its least value over the set; x is
    the upper half of a shingle's hash."""
    least, values = None, (values >> np.uint64(32)).astype(np.uint32)
    for i in range(0, len(values), BLOCK):
        table = a * values[i : i + BLOCK]
        table += b
        found = table.min(axis=1)
        least = found if least is None else np.minimum(least, found)
    return least


def sign(docs: DataFrame, size: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row: doc_id, text_hash, n_shingles, key (of the whole set, null if empty), bands (an array of long)
    and signature (an array of long: ``BITS`` bits for each hash, the first ones of all in one row, then the parities)."""
    a, b = _coefficients(bands * rows)
    lane = mix(np.arange(1, bands + 1, dtype=np.uint64))
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("key", pa.binary()), ("bands", pa.list_(pa.int64())), ("signature", pa.list_(pa.int64()))])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def signed() -> Iterator[tuple]:
            for x in short(source):
                last: dict[bytes, tuple] = {}
                for doc_id, text, text_hash in zip(*(c.to_pylist() for c in x.columns), strict=True):
                    values = shingles(text, size, hashes)
                    if not len(values):
                        yield doc_id, text_hash, 0, None, None, None
                        continue
                    key = xxhash.xxh3_128_digest(values.tobytes())
                    if key not in last:
                        least = minima(values, a, b).astype(np.uint64).reshape(bands, rows)
                        joined = lane.copy()
                        for k in range(rows):
                            joined = mix(joined * np.uint64(0x9E3779B97F4A7C15) + least[:, k])
                        mixed = mix(least.ravel())
                        planes = [np.packbits(((mixed >> np.uint64(k)) & np.uint64(1)).astype(np.uint8)) for k in range(BITS)]
                        odd = np.bincount((values % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1
                        last[key] = joined.view(np.int64), np.concatenate([*planes, np.packbits(odd.astype(np.uint8))]).view(np.int64)
                    yield doc_id, text_hash, len(values), key, *last[key]

        yield from batches(signed(), schema, size=512)

    kind = "doc_id long, text_hash long, n_shingles long, key binary, bands array<long>, signature array<long>"
    text = column(docs, "text", "string")
    return docs.select(column(docs, "doc_id", "long"), text, F.xxhash64(text).alias("text_hash")).mapInArrow(run, kind)


def _alike(n_a: Column, n_b: Column, sign_a: Column, sign_b: Column, percent: int) -> Column:
    """Whether two sets can be similar by their sizes, and seem to be by their signatures."""
    words = BANDS * ROWS // 64
    differ = lambda w: reduce(lambda x, y: x.bitwiseOR(y), [sign_a[k * words + w].bitwiseXOR(sign_b[k * words + w]) for k in range(BITS)])
    apart = reduce(add, [F.bit_count(differ(w)) for w in range(words)])
    by_size = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    odd = reduce(add, [F.bit_count(sign_a[k].bitwiseXOR(sign_b[k])) for k in range(BITS * words, BITS * words + PARITIES // 64)])
    by_size &= (100 + percent) * odd <= (100 - percent) * (n_a + n_b)  # an intersection over a union, by the sets' difference
    return by_size & (apart <= F.lit(BANDS * ROWS * (1 - 0.5**BITS) * (1 - percent / 100 + SLACK)))


def _ids(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()


def _similar(pairs: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sizes and signatures agree."""
    side = lambda k: named.select(F.col("rep").alias(k), F.col("n_shingles").alias(f"n{k}"), F.col("signature").alias(f"s{k}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return both.filter(_alike(F.col("na"), F.col("nb"), F.col("sa"), F.col("sb"), percent)).select("a", "b")


def _sets(docs: DataFrame, ids: DataFrame, size: int) -> DataFrame:
    """(id, set) of the classes (id, key, low), from the whole texts of the rows with ``low``."""
    rows = among(docs.select(column(docs, "doc_id", "long"), column(docs, "text", "string")), "doc_id", ids, "low")
    rows = rows.join(ids.hint("merge"), F.col("doc_id") == F.col("low")).select("id", "text", "key")
    schema = pa.schema([("id", pa.int64()), ("set", pa.binary())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def found() -> Iterator[tuple]:
            for x in short(source):
                for i, text, key in zip(*(c.to_pylist() for c in x.columns), strict=True):
                    values = shingles(text, size, hashes).tobytes()
                    if xxhash.xxh3_128_digest(values) == key:  # not another row that has the same doc_id
                        yield i, values

        yield from batches(found(), schema, size=64)

    return rows.mapInArrow(run, "id long, set binary")


def _linked(pairs: DataFrame, docs: DataFrame, named: DataFrame, size: int, percent: int, stash: Stash, label: str) -> DataFrame:
    """The pairs whose full sets have an intersection of ``percent`` hundredths of their union, or more."""
    ids = _ids(pairs).join(named.select(F.col("rep").alias("id"), "key", "low"), "id")
    sets = stash.keep(_sets(docs, stash.keep(ids, f"{label}-ids"), size).dropDuplicates(["id"]), f"{label}-sets")
    side = lambda k: sets.select(F.col("id").alias(k), F.col("set").alias(f"s{k}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "sa", "sb")
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in short(source):
            keep = []
            for p, q in zip(x.column("sa").to_pylist(), x.column("sb").to_pylist(), strict=True):
                all_ = np.sort(np.concatenate([np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)]), kind="stable")
                common = int(np.count_nonzero(all_[1:] == all_[:-1]))
                keep.append(100 * common >= percent * (len(all_) - common))
            yield pa.RecordBatch.from_arrays([x.column("a"), x.column("b")], schema=schema).filter(pa.array(keep, pa.bool_()))

    out = stash.keep(both.mapInArrow(run, "u long, v long"), f"{label}-links")
    stash.drop(f"{label}-ids", f"{label}-sets")
    return out


def _classes(signed: DataFrame, stash: Stash) -> DataFrame:
    """A row for each distinct set: key, n_shingles, low (the least doc_id, null if none has one), n_equal, bands,
    signature, and rep, a number that no other set has, by the task and the place in it, which stands for the set in links."""
    of = [F.first(c).alias(c) for c in ("n_shingles", "bands", "signature")]
    classes = signed.filter("key is not null").groupBy("key").agg(F.min("doc_id").alias("low"), F.count("*").alias("n_equal"), *of)
    return stash.keep(classes.withColumn("rep", F.monotonically_increasing_id()), "by-key")  # as written, so it stays what it is


def _joined(found: DataFrame | None, links: DataFrame, stash: Stash, k: int) -> DataFrame:
    """(id, component) after more links."""
    if found is not None:
        links = links.unionByName(found.filter("id <> component").select(F.col("id").alias("u"), F.col("component").alias("v")))
    now = stash.keep(components(links, stash, f"edges-{k}"), f"found-{k}")
    stash.drop(f"found-{k - 1}")
    return now


def _apart(open_: DataFrame, found: DataFrame, stash: Stash, k: int) -> DataFrame:
    """The members (band, rep, meets, part) of the buckets that are not in one component yet."""
    placed = open_.drop("part").join(found, F.col("rep") == F.col("id"), "left").select("band", "rep", "meets", F.coalesce("component", "rep").alias("part"))
    placed = stash.keep(placed, f"placed-{k}")
    bands = placed.groupBy("band").agg(F.min("part").alias("first"), F.max("part").alias("last")).filter("first < last").select("band")
    now = stash.keep(placed.join(stash.keep(bands, f"bands-{k}"), "band", "left_semi"), f"open-{k}")
    stash.drop(f"placed-{k}", f"bands-{k}", f"open-{k - 1}")
    return now


def _resolved(docs: DataFrame, size: int, percent: int, stash: Stash) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, n_shingles, key) of every row, and (key, low, n_equal, part, component) of the classes:
    linked classes have one ``part``, whose least ``low`` is ``component``; both are null where no row of the
    class has an id."""
    signed = stash.keep(sign(docs, size), "signed")
    rows = stash.keep(signed.select("doc_id", "text_hash", "n_shingles", "key"), "rows")
    classes = _classes(signed, stash)
    stash.drop("signed")
    named = classes.filter("low is not null")
    members = named.select("rep", F.explode("bands").alias("band"))
    buckets = members.groupBy("band").agg(F.min("rep").alias("low_rep"), F.max("rep").alias("high_rep")).filter("low_rep < high_rep").select("band")
    shared = stash.keep(members.join(stash.keep(buckets, "buckets"), "band"), "members")
    sizes = shared.groupBy("band").agg(F.count("*").alias("n"))
    meets = stash.keep(shared.join(stash.keep(sizes, "sizes"), "band").groupBy("rep").agg(F.sum("n").alias("meets")), "meets")
    open_ = stash.keep(shared.join(meets, "rep").select("band", "rep", "meets", F.col("rep").alias("part")), "open-0")
    stash.drop("buckets", "members", "sizes", "meets")

    tested, found = [], None
    for k in range(ROUNDS):
        turn = -F.col("meets") if k == 0 else F.xxhash64("rep", "band", F.lit(k))
        pivots = open_.groupBy("band").agg(F.min(F.struct(turn, F.col("rep"), F.col("part"))).alias("pivot")).select("band", F.col("pivot.rep").alias("pivot"), F.col("pivot.part").alias("pivot_part"))
        met = open_.join(stash.keep(pivots, f"pivots-{k}"), "band").filter("part <> pivot_part")
        met = met.groupBy("rep", "pivot").agg(F.count("*").alias("n")).groupBy("rep").agg(F.max(F.struct("n", "pivot"))["pivot"].alias("pivot"))
        met = met.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()
        tested.append(stash.keep(_similar(met, named, percent), f"similar-{k}"))
        links = _linked(tested[-1], docs, named, size, percent, stash, f"round-{k}")
        found = _joined(found, links, stash, k)
        stash.drop(f"pivots-{k}", f"round-{k}-links")
        open_ = _apart(open_, found, stash, k + 1)
        if not open_.limit(1).count():
            break

    before = F.expr("slice(bands, 1, array_position(bands, band) - 1)")  # a pair counts in its first common band only
    rest = open_.join(named.select("rep", "n_shingles", "signature", "bands"), "rep").withColumn("before", before)
    rest = stash.keep(rest.select("band", "rep", "part", "n_shingles", "signature", "before"), "rest")
    side = lambda k: rest.select(F.col("band").alias(f"band_{k}"), *[F.col(c).alias(f"{c}_{k}") for c in ("rep", "part", "n_shingles", "signature", "before")])
    apart = (F.col("band_a") == F.col("band_b")) & (F.col("rep_a") < F.col("rep_b")) & (F.col("part_a") != F.col("part_b"))
    alike = _alike(F.col("n_shingles_a"), F.col("n_shingles_b"), F.col("signature_a"), F.col("signature_b"), percent)
    again = side("a").join(side("b"), apart & alike & ~F.arrays_overlap("before_a", "before_b")).select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct()
    again = stash.keep(again.join(reduce(DataFrame.unionByName, tested), ["a", "b"], "left_anti"), "again")
    found = _joined(found, _linked(again, docs, named, size, percent, stash, "again"), stash, k + 1)
    stash.drop("rest", "again", "again-links", f"open-{k + 1}", *[f"similar-{i}" for i in range(k + 1)])

    linked = named.select("rep", "low").join(found, F.col("rep") == F.col("id")).select("rep", "low", F.col("component").alias("part"))
    linked = stash.keep(linked, "linked")
    least = stash.keep(linked.groupBy("part").agg(F.min("low").alias("least")), "least")  # written: a large part can be split in the join
    linked = stash.keep(linked.select("rep", "part").join(least, "part"), "resolved")
    some = F.col("low").isNotNull()
    placed = classes.select("key", "low", "n_equal", "rep").join(linked, "rep", "left")
    placed = placed.select("key", "low", "n_equal", F.when(some, F.coalesce("part", "rep")).alias("part"), F.when(some, F.coalesce("least", "low")).alias("component"))
    placed = stash.keep(placed, "components")
    stash.drop("by-key", f"found-{k + 1}", "linked", "least", "resolved")
    return rows, placed


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id, kept, n_equal (rows of its class).

    Documents are linked when ``percent`` hundredths of the union of their shingle sets are in both;
    ``component_id`` is the least ``doc_id`` that links reach and the document with that id is kept. Null
    and empty texts have no shingles and are linked with nothing; of a very long text every shingle counts.
    Repeated rows and ties get the same result. A row without ``doc_id`` is linked through rows with an equal
    set only, and is kept if none has an id. An empty table gives none; other columns are not read.
    """
    rows, placed = _resolved(docs, size, percent, Stash(docs.sparkSession, "near-duplicates"))
    rows = rows.select("doc_id", "n_shingles", "key").join(placed.select("key", "n_equal", "component"), "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"), F.coalesce("n_equal", F.lit(1)).cast("long").alias("n_equal"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near-duplicates, one with its least ``doc_id`` or, where none has an id, any,
    with the columns of ``docs``. Of rows without shingles, those that are equal in ``doc_id`` and text are
    one; without ``doc_id`` all of them stay. An empty table gives none."""
    stash = Stash(docs.sparkSession, "near-duplicates-kept")
    rows, placed = _resolved(docs, size, percent, stash)
    texts = rows.groupBy("doc_id", "text_hash").agg(F.first("key").alias("key"), F.count("*").alias("n"))  # rows of one text
    texts = texts.join(placed.select("key", "part", "component"), "key", "left")
    only = F.when(F.col("part").isNull(), F.col("key"))  # a class without any id is a group of its own
    least = F.col("key").isNotNull() & F.col("doc_id").eqNullSafe(F.col("component"))
    texts = stash.keep(texts.select("doc_id", "text_hash", "n", "part", only.alias("only"), F.col("key").isNull().alias("bare"), least.alias("least")), "texts")
    # where more texts than one have the least id of a group, the one with the least hash stays
    best = texts.filter("least").groupBy("part", "only").agg(F.min("text_hash").alias("best")).select(F.col("part").alias("b_part"), F.col("only").alias("b_only"), "best")
    same = F.col("part").eqNullSafe(F.col("b_part")) & F.col("only").eqNullSafe(F.col("b_only"))
    first = texts.filter("least").join(best, same).withColumn("stays", F.col("best") == F.col("text_hash")).drop("b_part", "b_only", "best")
    texts = texts.filter("not least").withColumn("stays", F.col("bare")).unionByName(first)
    several = (F.col("n") > 1) & ~(F.col("bare") & F.col("doc_id").isNull())
    moved = texts.filter(~F.col("stays") | several).select(F.col("doc_id").alias("m_id"), F.col("text_hash").alias("m_hash"), F.col("stays").alias("one"))
    moved = stash.keep(moved, "moved")
    stash.drop("rows", "components", "texts")

    whole = packed(docs, doc_id="long", text="string").withColumn("text_hash", F.xxhash64("text")).drop("text")
    whole = whole.join(moved.hint("merge"), F.col("doc_id").eqNullSafe(F.col("m_id")) & (F.col("text_hash") == F.col("m_hash")), "left")
    kept = whole.filter("one is null").select("_row")
    if moved.filter("one").limit(1).count():
        first = whole.filter("one").groupBy("doc_id", "text_hash").agg(F.min_by("_row", F.to_json("_row")).alias("_row"))
        kept = kept.unionByName(first.select("_row"))
    return unpacked(kept, docs.columns)
