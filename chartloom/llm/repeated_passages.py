"""Removal of long passages that a document shares with an earlier one, found at difference-cover anchors.

The residues of a difference cover hold every difference modulo its period, so wherever two equal runs of
words start, some shift of less than a period puts both on residues of the cover. Hashing short windows
at those positions only is therefore enough to find every long match. The windows around anchors that
more than one document has are then compared whole; all others are unique.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stash, WordHashes, among, batches, column, packed, short, unpacked, windows

WINDOW = 50
#: Residues modulo the period whose differences are all residues but 0, each once.
PERIOD = 31
COVER = (0, 1, 3, 8, 12, 18)
#: A window of WINDOW words holds an anchor of so many at any shift of less than a period.
ANCHOR = WINDOW - PERIOD + 1


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def anchors(hashes: np.ndarray, anchor: int = ANCHOR, period: int = PERIOD, cover: tuple[int, ...] = COVER) -> tuple[np.ndarray, np.ndarray]:
    """The positions on the cover and the hashes of the windows of ``anchor`` words there."""
    made = windows(hashes, anchor)
    at = np.arange(len(made))
    on = np.isin(at % period, cover)
    return at[on], made[on]


def _read(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, rid (of doc_id and words), key (of the words), n_words, sha (of all words), anchors (distinct)."""
    schema = pa.schema([("doc_id", pa.int64()), ("rid", pa.int64()), ("key", pa.binary()), ("n_words", pa.int64()), ("sha", pa.string()), ("anchors", pa.list_(pa.int64()))])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def rows() -> Iterator[tuple]:
            for x in short(source):
                for doc_id, text in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True):
                    words = words_of(text)
                    joined = b" ".join(words)
                    found = np.unique(anchors(hashes(words))[1]).view(np.int64) if len(words) >= WINDOW and doc_id is not None else None
                    yield doc_id, row_id(doc_id, joined), xxhash.xxh3_128_digest(joined), len(words), hashlib.sha256(joined).hexdigest(), found

        yield from batches(rows(), schema, size=512)

    return docs.mapInArrow(run, "doc_id long, rid long, key binary, n_words long, sha string, anchors array<long>")


def row_id(doc_id: int | None, joined: bytes) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(joined + b"\0" + str(doc_id).encode())).astype(np.int64))


def _windows(held: DataFrame) -> DataFrame:
    """(hash, other, doc_id, rid, start) of the windows that hold one of a document's shared anchors; ``other`` is a
    second hash, of other hashes of the words, so that windows that only agree in the first are told apart."""
    schema = pa.schema([("hash", pa.int64()), ("other", pa.int32()), ("doc_id", pa.int64()), ("rid", pa.int64()), ("start", pa.int32())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, others = WordHashes(), WordHashes(seed=1)
        for x in short(source):
            for doc_id, rid, text, shared in zip(*(x.column(k).to_pylist() for k in ("doc_id", "rid", "text", "shared")), strict=True):
                words = words_of(text)
                h = hashes(words)
                at, found = anchors(h)
                at = at[np.isin(found.view(np.int64), np.array(shared, np.int64))]
                whole = windows(h, WINDOW)
                edge = np.zeros(len(whole) + 1, np.int32)  # starts from at - (WINDOW - ANCHOR) to at
                np.add.at(edge, np.maximum(at - (WINDOW - ANCHOR), 0), 1)
                np.add.at(edge, np.minimum(at + 1, len(whole)), -1)
                start = np.flatnonzero(np.cumsum(edge[:-1]) > 0).astype(np.int32)
                if len(start):
                    other = windows(others(words), WINDOW)[start].astype(np.uint32).view(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(whole[start].view(np.int64)), pa.array(other), pa.array(np.full(len(start), doc_id, np.int64)), pa.array(np.full(len(start), rid, np.int64)), pa.array(start)], schema=schema)

    return held.select("doc_id", "rid", "text", "shared").mapInArrow(run, "hash long, other int, doc_id long, rid long, start int")


def _cut(rows: DataFrame) -> DataFrame:
    """(rid, n_removed, kept, kept_sha256) from (rid, text, starts)."""
    schema = pa.schema([("rid", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("kept_sha256", pa.string())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut() -> Iterator[tuple]:
            for x in short(source):
                for rid, text, starts in zip(*(x.column(k).to_pylist() for k in ("rid", "text", "starts")), strict=True):
                    words = words_of(text)
                    edge = np.zeros(len(words) + 1, np.int32)
                    starts = np.array(starts)
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + WINDOW, -1)
                    stay = np.cumsum(edge[:-1]) == 0
                    kept = b" ".join(w for w, s in zip(words, stay, strict=True) if s)
                    yield rid, int(len(words) - stay.sum()), kept.decode("utf-8", "surrogatepass"), hashlib.sha256(kept).hexdigest()

        yield from batches(cut(), schema, size=64)

    return rows.select("rid", "text", "starts").mapInArrow(run, "rid long, n_removed long, kept string, kept_sha256 string")


def _changes(docs: DataFrame, stash: Stash) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What was read of each row; (key, rep) of the word sequences that several rows have; and the cuts by rid.
    Joins are by sorted keys at every size, so that the plan measured small is the one that runs large."""
    texts = docs.select(column(docs, "doc_id", "long"), column(docs, "text", "string"))
    read = stash.keep(_read(texts), "read")
    long_ = read.filter(f"n_words >= {WINDOW} and doc_id is not null")
    classes = long_.groupBy("key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).filter("n > 1").select("key", "rep")
    classes = stash.keep(classes, "classes")
    # a later copy of a whole sequence goes whole and has no window that its first does not have
    first = long_.join(classes.hint("merge"), "key", "left").filter("rep is null or doc_id = rep")
    marked = first.select("rid", F.explode("anchors").alias("hash"))
    shared = stash.keep(marked.groupBy("hash").agg(F.count("*").alias("n")).filter("n > 1").select("hash"), "shared")
    own = marked.join(shared.hint("merge"), "hash", "left_semi").groupBy("rid").agg(F.collect_set("hash").alias("shared"))
    own = stash.keep(own, "own")
    ids = long_.select("rid", F.col("doc_id").alias("id"), "key").join(own, "rid").dropDuplicates(["rid"])
    ids = stash.keep(ids, "ids")
    held = among(texts, "doc_id", ids, "id").join(ids.hint("merge"), F.col("doc_id") == F.col("id"))
    held = stash.keep(_same(held).dropDuplicates(["rid"]), "held")
    stash.drop("shared", "own", "ids")

    found = stash.keep(_windows(held), "windows")
    low = found.groupBy("hash", "other").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").select("hash", "other", "low")
    low = stash.keep(low, "low")
    starts = found.join(low.hint("merge"), ["hash", "other"]).filter("doc_id > low").groupBy("rid").agg(F.collect_list("start").alias("starts"))
    cuts = stash.keep(_cut(held.select("rid", "text").join(stash.keep(starts, "starts"), "rid")), "cuts")
    stash.drop("windows", "low", "starts", "held")
    return read, classes, cuts


def _same(rows: DataFrame) -> DataFrame:
    """Of rows joined by doc_id those whose words are the ones that ``key`` was made of."""
    schema = pa.schema([("doc_id", pa.int64()), ("rid", pa.int64()), ("text", pa.string()), ("shared", pa.list_(pa.int64()))])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in short(source):
            ok = [xxhash.xxh3_128_digest(b" ".join(words_of(t))) == k for t, k in zip(x.column("text").to_pylist(), x.column("key").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([x.column(k) for k in ("doc_id", "rid", "text", "shared")], schema=schema).filter(pa.array(ok, pa.bool_()))

    return rows.select("doc_id", "rid", "text", "shared", "key").mapInArrow(run, "doc_id long, rid long, text string, shared array<long>")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256.

    A word goes if a window of 50 words over it also starts in a row with a smaller ``doc_id``. A null or
    empty text has no words; rows without ``doc_id`` neither lose words nor make others lose any; rows with
    the same ``doc_id`` do not count against each other; an empty table gives none.
    """
    read, classes, cuts = _changes(docs, Stash(docs.sparkSession, "repeated-passages"))
    rows = read.select("doc_id", "rid", "key", "n_words", "sha").join(classes.hint("merge"), "key", "left")
    rows = rows.join(cuts.select("rid", "n_removed", "kept_sha256").hint("merge"), "rid", "left")
    copy = F.coalesce(F.col("doc_id") > F.col("rep"), F.lit(False))
    removed = F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    sha = F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha"))
    return rows.select("doc_id", "n_words", removed.cast("long").alias("n_removed"), sha.alias("kept_sha256"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the kept words joined by one space where words went, and the text as it was elsewhere."""
    stash = Stash(docs.sparkSession, "without-repeats")
    read, classes, cuts = _changes(docs, stash)
    rows = read.select("doc_id", "rid", "key").join(classes, "key", "left").join(cuts.select("rid", "kept"), "rid", "left")
    copy = F.col("doc_id") > F.col("rep")
    changed = rows.filter(copy | F.col("kept").isNotNull()).select(F.col("doc_id").alias("cut_id"), F.hex("key").alias("cut_key"), F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("cut_text"))
    changed = stash.keep(changed.dropDuplicates(["cut_id", "cut_key"]), "changed")
    whole = packed(docs, doc_id="long", text="string")

    def keyed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in short(source):
            keys = [xxhash.xxh3_128_digest(b" ".join(words_of(t))).hex().upper() for t in x.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*x.columns, pa.array(keys, pa.string())], names=[*x.schema.names, "own_key"])

    marked = whole.mapInArrow(keyed, whole.withColumn("own_key", F.lit("")).schema)
    out = marked.join(changed, (F.col("doc_id") == F.col("cut_id")) & (F.col("own_key") == F.col("cut_key")), "left")
    return unpacked(out, docs.columns, text=F.coalesce("cut_text", "text"))
