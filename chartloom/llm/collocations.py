"""Phrases by compressed position bitmaps.

Three passes over the texts. A shard is some millions of words of one task; its words have numbers, and a
border between pieces has the number 0. The first pass counts words and neighbours by 64-bit hashes, the
second those rows of three and four words whose neighbours may all be frequent. What reaches the support
makes a filter of bounded size, which lets all frequent phrases through and few others. In the third pass
every shard has a bitmap of the positions of each word, compressed to the positions that are set. The words
are extended depth first, a block of first words at a time: the bitmaps of a block's phrases are shifted by one
and ANDed with the bitmaps of all words that may follow. A position is set in the bitmap of one word only, so
that AND is a look at the position's word; what is left for a phrase and a word is the bitmap of the longer
phrase, and its number of set positions the occurrences in the shard. No word has the number 0, so nothing goes
over a border. Counts are summed over shards, exactly, by lang and phrase.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import BITMAP_BITS, Stash, column, mix, short

SUPPORT, LONGEST, SHARE, TOP = 30, 4, 80, 2000
#: Positions of a shard; set positions of the bitmaps that are extended at a time.
SHARD, BLOCK = 1 << 22, 1 << 19
#: Phrases are dealt by so many bits of their hashes; rows of them that are read, and phrases that are summed, at a time.
PHRASE_BITS, BUCKETS_READ, PHRASES = 14, 1024, 1 << 19
#: Hashes are dealt by their highest bits; bits of the filter for each frequent hash, and at least and at most (128 MB).
BUCKET_BITS, FILTER_BITS, LEAST_FILTER, MOST_FILTER = 16, 32, 1 << 20, 1 << 30
#: Hashes that are merged at a time.
MERGED = 1 << 21
#: The byte 0xFF, which UTF-8 does not have, stands for a border between pieces; a tab is a space.
BORDER = b"\xff"
BORDERS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", BORDER * 10 + b" ")
#: Salts of a lang's phrases before its best are put in order.
SALTS = 256
STEP = np.uint64(0x9E3779B97F4A7C15)


class _Words(dict):
    """Numbers of the words of one lang; a new word gets the next."""

    def __init__(self, lang: str, words: list[tuple[str, bytes]], numbers: Iterator[int]):
        super().__init__({BORDER: 0})
        self.lang, self.words, self.numbers = lang, words, numbers

    def __missing__(self, word: bytes) -> int:
        self.words.append((self.lang, word))
        self[word] = n = next(self.numbers)
        return n


class Shard:
    """Words by position (0: a border), the words (lang, word) by number, and their hashes."""

    def __init__(self, at: np.ndarray, words: list[tuple[str, bytes]]):
        self.at, self.words = at, words
        self.hashes = np.array([xxhash.xxh3_64_intdigest(lang.encode() + b"\0" + w) for lang, w in words], np.uint64)
        self.hashes[0] = 0

    def rows(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Where rows of 1, 2, .. words start that have no border within, and their hashes: a row of n words is that of
        n - 1, then the next word."""
        starts = np.flatnonzero(self.at)
        return [(starts, self.hashes[self.at[starts]])]

    def longer(self, starts: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The rows of ``n`` words that begin with the given rows of n - 1."""
        following = self.at[starts + (n - 1)]  # a shard ends with a border
        some = following > 0
        starts, hashes = starts[some], hashes[some]
        return starts, extended(hashes, self.hashes[following[some]])


def extended(hashes: np.ndarray, following: np.ndarray) -> np.ndarray:
    return mix(hashes * STEP + following)


def shards(source: Iterator[pa.RecordBatch], size: int = SHARD) -> Iterator[Shard]:
    """The texts of (text, lang) in shards of some ``size`` positions."""
    parts, n, words, langs = [], 0, [("", b"")], {}
    numbers = count(1)
    for x in short(source):
        for text, lang in zip(x.column("text").to_pylist(), x.column("lang").to_pylist(), strict=True):
            if not text:
                continue
            found = langs.get(lang)
            if found is None:
                found = langs[lang] = _Words(lang, words, numbers)
            tokens = text.lower().translate(BORDERS).replace(BORDER, b" \xff ").split()
            tokens.append(BORDER)
            parts.append(np.fromiter(map(found.__getitem__, tokens), np.int32, len(tokens)))
            n += len(tokens)
            if n >= size:
                yield Shard(np.concatenate(parts), words)
                parts, n, words, langs, numbers = [], 0, [("", b"")], {}, count(1)
    if parts:
        yield Shard(np.concatenate(parts), words)


PACKED = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])


def packed(hashes: np.ndarray) -> pa.RecordBatch:
    """The distinct hashes in order and their numbers up to the support, a row for each value of the highest bits."""
    keys, n = np.unique(hashes, return_counts=True)
    return _packed(keys, np.minimum(n, SUPPORT).astype(np.uint8))


def _packed(keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    bucket = (keys >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(keys) else np.empty(0, np.int64)
    at = np.append(first, len(keys))
    blob = lambda values, width: pa.Array.from_buffers(pa.binary(), len(first), [None, pa.py_buffer((at * width).astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())])
    return pa.RecordBatch.from_arrays([pa.array(bucket[first]), blob(keys, 8), blob(n, 1)], schema=PACKED)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(column(docs, "text", "string").cast("binary").alias("text"), F.coalesce(column(docs, "lang", "string"), F.lit("und")).alias("lang"))


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, n = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
    return key[first], np.minimum(np.add.reduceat(n, first), SUPPORT).astype(np.uint8) if len(first) else n.astype(np.uint8)


def _bytes(column_: pa.Array) -> np.ndarray:
    """The values of a binary column, one after another."""
    _, ends, values = column_.buffers()
    ends = np.frombuffer(ends, np.int32)[column_.offset : column_.offset + len(column_) + 1]
    return np.frombuffer(values, np.uint8)[ends[0] : ends[-1]]


def _frequent(counted: DataFrame) -> DataFrame:
    """(key) of the hashes that occur as often as the support says."""
    schema = pa.schema([("key", pa.int64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held, last = [], [], 0, None

        def done(n: int | None) -> pa.RecordBatch:
            """What is complete; hashes of the bucket ``n`` wait for more rows of it."""
            key, c = _merged(keys, counts)
            open_ = np.zeros(len(key), bool) if n is None else (key >> np.uint64(64 - BUCKET_BITS)) == np.uint64(n)
            keys[:], counts[:] = [key[open_]], [c[open_]]
            return pa.RecordBatch.from_arrays([pa.array(key[~open_ & (c >= SUPPORT)].view(np.int64))], schema=schema)

        for x in source:
            if x.num_rows:
                keys.append(_bytes(x.column("keys")).view(np.uint64).copy())
                counts.append(_bytes(x.column("counts")).copy())
                held, last = held + len(counts[-1]), x.column("bucket")[-1].as_py()
                if held >= MERGED:
                    yield done(last)
                    held = 0
        if keys:
            yield done(None)

    return counted.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "key long")


class Filter:
    """Two bits of each hash in a fixed size: every hash that was put in passes, others seldom."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.mask = bits, np.uint64(8 * len(bits) - 1)

    def _set(self, at: np.ndarray) -> np.ndarray:
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        ok = self._set(hashes & self.mask)
        ok[ok] = self._set((hashes[ok] >> np.uint64(32)) & self.mask)
        return ok


def _filter(keys: DataFrame):
    """A broadcast filter of the keys: 32 bits for each, 128 MB at most, where it is fuller only."""
    wanted = FILTER_BITS * keys.count()
    size = min(max(1 << (wanted - 1).bit_length() if wanted else 0, LEAST_FILTER), MOST_FILTER)
    places = F.array(*[F.shiftrightunsigned("key", n).bitwiseAND(F.lit(size - 1)) for n in (0, 32)])
    place = F.col("place")
    rows = keys.select(F.explode(places).alias("place")).groupBy(F.floor(place / BITMAP_BITS).alias("at")).agg(F.bitmap_construct_agg(place % BITMAP_BITS).alias("bits")).collect()
    bits = np.zeros(size // 8, np.uint8)
    for r in rows:
        part = np.frombuffer(r["bits"], np.uint8)
        bits[r["at"] * (BITMAP_BITS // 8) :][: len(part)] = part
    return keys.sparkSession.sparkContext.broadcast(bits)


def _short_counts(docs: DataFrame) -> DataFrame:
    """Packed counts of words and of neighbours."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard in shards(source):
            (one,) = shard.rows()
            yield packed(one[1])
            yield packed(shard.longer(*one, 2)[1])

    return _texts(docs).mapInArrow(run, "bucket int, keys binary, counts binary")


def _long_counts(docs: DataFrame, short_bits) -> DataFrame:
    """Packed counts of rows of three words and more all of whose neighbours may be frequent."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = Filter(short_bits.value)
        for shard in shards(source):
            starts, hashes = shard.longer(*shard.rows()[0], 2)
            ok = passes(hashes)
            pair = np.zeros(len(shard.at) + LONGEST, bool)  # positions where a frequent pair starts
            pair[starts[ok]] = True
            starts, hashes = starts[ok], hashes[ok]
            for n in range(3, LONGEST + 1):
                goes_on = pair[starts + (n - 2)]
                starts, hashes = shard.longer(starts[goes_on], hashes[goes_on], n)
                yield packed(hashes)

    return _texts(docs).mapInArrow(run, "bucket int, keys binary, counts binary")


COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("f", pa.int64())])


class Bitmaps:
    """The set positions of each word of a shard, in order, one bitmap after another."""

    def __init__(self, at: np.ndarray, n_words: int):
        self.set = np.argsort(at, kind="stable")
        self.ends = np.cumsum(np.bincount(at, minlength=n_words))

    def size(self, words: np.ndarray) -> np.ndarray:
        return self.ends[words] - self.ends[words - 1]  # no bitmap is that of the number 0

    def of(self, words: np.ndarray) -> np.ndarray:
        """The bitmaps of the words, one after another."""
        n = self.size(words)
        return self.set[np.repeat(self.ends[words - 1] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def blocks(sizes: np.ndarray, most: int = BLOCK) -> list[slice]:
    """Runs of bitmaps that have so many set positions together, or are one bitmap."""
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1
    return [slice(a, b) for a, b in zip([0, *cuts], [*cuts, len(sizes)], strict=True) if a < b]


def grown(shard: Shard, passes: Filter) -> Iterator[tuple[np.ndarray, pa.RecordBatch]]:
    """(lang, phrase, occurrences in the shard) of the words and phrases that pass, and (lang, null, all words), each with
    the hash of its words."""
    n_words, hashes = len(shard.words), shard.hashes
    langs, of_lang = np.unique([lang for lang, _ in shard.words[1:]], return_inverse=True)
    of_lang, names, words = np.append(0, of_lang), pa.array(langs, pa.string()), pa.array([w for _, w in shard.words], pa.binary())
    bitmaps = Bitmaps(shard.at, n_words)
    every = np.arange(1, n_words)
    total = np.bincount(of_lang[1:], bitmaps.size(every), len(langs)).astype(np.int64)
    yield np.zeros(len(names), np.uint64), pa.RecordBatch.from_arrays([names, pa.nulls(len(names), pa.binary()), pa.array(total)], schema=COUNTS)

    def found(first: np.ndarray, phrases: pa.Array, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([names.take(pa.array(of_lang[first])), phrases, pa.array(n)], schema=COUNTS)

    frequent = every[passes(hashes[1:])]
    sizes = bitmaps.size(frequent)
    for block in blocks(sizes):
        first, n = frequent[block], sizes[block]
        phrases, reached = words.take(pa.array(first)), hashes[first]
        yield reached, found(first, phrases, n)
        positions, phrase = bitmaps.of(first), np.repeat(np.arange(len(first)), n)
        for _ in range(2, LONGEST + 1):
            positions = positions + 1
            word = shard.at[positions].astype(np.int64)
            ok = (word > 0) & passes(extended(reached[phrase], hashes[word]))
            positions, longer = positions[ok], phrase[ok] * n_words + word[ok]
            longer, phrase, n = np.unique(longer, return_inverse=True, return_counts=True)
            if not len(longer):
                break
            before, last = longer // n_words, longer % n_words
            first, reached = first[before], extended(reached[before], hashes[last])
            phrases = pc.binary_join_element_wise(phrases.take(pa.array(before)), words.take(pa.array(last)), pa.scalar(b" "))
            yield reached, found(first, phrases, n)


def _dealt(found: list[tuple[np.ndarray, pa.RecordBatch]]) -> pa.RecordBatch:
    """A shard's phrases and counts, in a row for each value of the highest bits of their hashes."""
    bucket = np.concatenate([h >> np.uint64(64 - PHRASE_BITS) for h, _ in found]).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    rows = pa.Table.from_batches([x for _, x in found]).combine_chunks().take(pa.array(order))
    bucket = bucket[order]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    each = pa.StructArray.from_arrays([c.combine_chunks() for c in rows.columns], fields=list(COUNTS))
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(bucket)).astype(np.int32)), each)
    return pa.RecordBatch.from_arrays([pa.array(bucket[first]), lists], names=["bucket", "found"])


def _summed(rows: list[pa.Table]) -> pa.Table:
    """(bucket, lang, phrase, f): one row for each phrase."""
    return pa.concat_tables(rows).group_by(["bucket", "lang", "phrase"], use_threads=False).aggregate([("f", "sum")]).rename_columns(["bucket", *COUNTS.names])


def phrase_counts(docs: DataFrame, bits) -> DataFrame:
    """(lang, phrase, f): occurrences in all documents of what passes the filter and reaches the support; the phrase null:
    all words. Phrases move in few large rows, dealt by their hashes, and are summed where they meet."""

    def shown(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = Filter(bits.value)
        for shard in shards(source):
            if len(shard.words) > 1:  # else there are borders only
                yield _dealt(list(grown(shard, passes)))

    def summed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def done(last: int | None) -> Iterator[pa.RecordBatch]:
            """What is complete; phrases of the bucket ``last`` wait for more rows of it."""
            rows = _summed(held)
            open_ = pa.scalar(False) if last is None else pc.equal(rows["bucket"], last)
            held[:] = [rows.filter(open_)] if last is not None else []
            rows = rows if last is None else rows.filter(pc.invert(open_))
            rows = rows.filter(pc.or_(pc.greater_equal(rows["f"], SUPPORT), pc.is_null(rows["phrase"])))
            yield from rows.select(COUNTS.names).to_batches(max_chunksize=100_000)

        for x in source:
            for at in range(0, x.num_rows, BUCKETS_READ):
                part = x.slice(at, BUCKETS_READ)
                lists = part.column("found")
                each = lists.flatten()
                bucket = np.repeat(part.column("bucket").to_numpy(zero_copy_only=False), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                held.append(pa.table([pa.array(bucket), *[each.field(c) for c in COUNTS.names]], names=["bucket", *COUNTS.names]))
                n += len(bucket)
                if n >= PHRASES:
                    yield from done(int(bucket[-1]))
                    n = 0
        if held:
            yield from done(None)

    dealt = _texts(docs).mapInArrow(shown, "bucket int, found array<struct<lang:string,phrase:binary,f:long>>")
    counts = dealt.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(summed, "lang string, phrase binary, f long")
    return counts.select("lang", F.col("phrase").cast("string").alias("phrase"), "f")


def scored(counts: DataFrame, stash: Stash) -> DataFrame:
    """(lang, phrase, a, l, r, score) of the candidates that no longer one stands for, by counts of all frequent phrases."""
    words = F.split("phrase", " ")
    all_ = counts.filter("phrase is not null").withColumn("m", F.size(words))
    candidates = all_.filter((F.col("m") > 1) & (F.col("f") >= SUPPORT))
    cut = lambda at, n: F.array_join(F.slice(words, at, n), " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k", cut(F.lit(1), F.col("k")).alias("head"), cut(F.col("k") + 1, F.col("m") - F.col("k")).alias("tail"))
    side = lambda part, name: counts.select("lang", F.col("phrase").alias(part), F.col("f").alias(name))
    cuts = cuts.join(side("head", "l"), ["lang", "head"]).join(side("tail", "r"), ["lang", "tail"])
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    score = F.expr("(cast(a as decimal(20,0)) * 2000000) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    least = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("cut"))
    least = stash.keep(least.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score"), "least")

    longer = candidates.filter("m > 2").withColumn("n", F.explode(F.sequence(F.lit(2), F.col("m") - 1)))
    longer = longer.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("m") - F.col("n") + 1)))
    within = longer.select("lang", cut(F.col("at"), F.col("n")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("whole"))
    within = stash.keep(within, "within")
    stands = wide("whole") * 100 >= wide("a") * SHARE
    return least.join(within, ["lang", "phrase"], "left").filter(F.col("whole").isNull() | ~stands).drop("whole")


def collocations(docs: DataFrame, top: int = TOP) -> DataFrame:
    """Each lang's best phrases of 2 to 4 words: lang, rank, phrase, a, l, r, n, score.

    A null or empty text has no words, a null ``lang`` is ``und``, and a lang without candidates gives no row. All
    words of a very long text count, repeated rows count each, and phrases with equal scores and counts go by their
    bytes. An empty table gives none; other columns are not read. A byte 0xFF, which no valid text has, is a border.
    """
    stash = Stash(docs.sparkSession, "collocations")
    pairs = stash.keep(_frequent(_short_counts(docs)), "short")
    short_bits = _filter(pairs)
    rows = stash.keep(_frequent(_long_counts(docs, short_bits)), "long")
    bits = _filter(pairs.unionByName(rows))
    counts = stash.keep(phrase_counts(docs, bits), "counts")
    for b in (short_bits, bits):
        b.destroy()
    found = scored(counts, stash).withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    some = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    total = counts.filter("phrase is null").select("lang", F.col("f").alias("n"))
    out = stash.keep(best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), "best")
    stash.drop("short", "long", "counts", "least", "within")
    return out
