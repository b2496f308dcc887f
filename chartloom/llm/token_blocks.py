"""Token ids in binary chunks: bit-plane or byte-plane shuffled, zstandard-compressed, with a chunk index.

A shard is one partition of the documents in ascending ``doc_id``; its ids form one stream that is cut
into blocks of a fixed number of ids. A block's unsigned 32-bit ids are transposed into planes (bytes
or bits of equal significance stand together) and every plane is compressed by itself. The table that
holds the chunks is also the index: shard, chunk, number of ids, checksum, and for each document that
touches the chunk its place there, so a document is read without decoding what lies before it.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Stash, batches, column, short

CHUNK_IDS = 65_536
END_ID = 2
#: Segments whose ids a worker remembers; a matter of speed only.
REMEMBERED = 1_200_000
#: Segments of a text that are joined at a time, so that a very long text never needs all its ids at once.
SLICE = 50_000

CHUNKS = (
    "shard int, chunk int, n_ids int, crc long, planes array<binary>, "
    "parts array<struct<row: long, doc_id: long, before: long, at: int, n: int>>"
)
_PART = pa.list_(pa.struct([("row", pa.int64()), ("doc_id", pa.int64()), ("before", pa.int64()), ("at", pa.int32()), ("n", pa.int32())]))
_CHUNKS = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("n_ids", pa.int32()), ("crc", pa.int64()), ("planes", pa.list_(pa.binary())), ("parts", _PART)])

#: White space other than space and newline, and the byte used as a mark: such texts are encoded in one piece.
_UNUSUAL = re.compile("[\0\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
_SEGMENT = re.compile("[ \n]*[^ \n]+|[ \n]+")


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Encoder:
    """Ids of whole texts from a ``tokenizers`` file, equal to ``encode(text, add_special_tokens=False)``.

    With a byte-level pre-tokenizer and no normalizer, no token reaches over the start of a run of white
    space, so a text's ids are the ids of its segments (white space and what follows it) in a row. Those
    of segments seen before are remembered; any other tokenizer encodes texts in one piece.
    """

    def __init__(self, path: str, most: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.model, self.most, self.known = self.tokenizer.model, most, {}
        made = json.loads(self.tokenizer.to_str())
        pre, model = made["pre_tokenizer"] or {}, made["model"]
        self.apart = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and made["normalizer"] is None and model["type"] == "BPE" and not model.get("dropout")
            and all(x["special"] for x in made["added_tokens"])
        )
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.letters = dict(zip(shown, map(chr, shown), strict=True)) | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.space = self.letters[ord(" ")]
        self.marks = {m: _packed(self.tokenizer.encode(m, add_special_tokens=False).ids) for m in ".,"}

    def segments(self, text: str) -> list[str]:
        if not self.apart or _UNUSUAL.search(text):
            return [text]
        if "  " in text or "\n\n" in text or " \n" in text or "\n " in text:
            return _SEGMENT.findall(text)
        return text.replace("\n", "\0\n").replace(" ", "\0 ").split("\0")

    def learn(self, segments: Iterable[str]) -> None:
        """Adds segments. A space and letters are one pre-token, which goes to the model at once; a mark
        after them is another. All other segments go through the whole tokenizer."""
        known, marks, words, marked, rest = self.known, self.marks, set(), [], []
        for s in segments:
            word = s[1:] if s[:1] == " " else s
            if not self.apart:
                rest.append(s)
            elif word.isalpha():
                words.add(s)
            elif word[-1:] in marks and word[:-1].isalpha():
                marked.append(s)
                words.add(s[:-1])
            else:
                rest.append(s)
        self._words([w for w in words if w not in known])
        for s in marked:
            known[s] = known[s[:-1]] + marks[s[-1]]
        for s, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False), strict=True):
            known[s] = _packed(e.ids)

    def _words(self, words: list[str]) -> None:
        """Adds pre-tokens; their ids are packed together and cut apart."""
        tokenize, ids, ends = self.model.tokenize, [], []
        for w in words:
            if w.isascii():
                w = self.space + w[1:] if w[:1] == " " else w
            else:
                w = w.encode().decode("latin1").translate(self.letters)
            ids += [t.id for t in tokenize(w)]
            ends.append(4 * len(ids))
        held = _packed(ids)
        self.known.update(zip(words, map(held.__getitem__, map(slice, [0, *ends], ends)), strict=True))

    def __call__(self, texts: list[str]) -> Iterator[Iterator[bytes]]:
        """For each text its ids as little-endian unsigned 32-bit integers, in pieces."""
        parts = [self.segments(t) if t else [] for t in texts]
        self.learn(set().union(*parts).difference(self.known))
        get = self.known.__getitem__
        for p in parts:
            yield (b"".join(map(get, p[i : i + SLICE])) for i in range(0, len(p), SLICE))
        if len(self.known) > self.most:
            self.known.clear()


@lru_cache(maxsize=4)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def to_planes(ids: bytes, kind: str = "byte", level: int = 1) -> list[bytes]:
    """The compressed planes of a block of little-endian unsigned 32-bit ids; trailing empty planes are left out."""
    bytes_ = np.frombuffer(ids, np.uint8).reshape(-1, 4).T
    if kind == "bit":
        planes = [np.packbits((bytes_[b] >> i) & 1) for b in range(4) for i in range(8)]
    else:
        planes = [np.ascontiguousarray(p) for p in bytes_]
    while len(planes) > 1 and not planes[-1].any():
        planes.pop()
    packer = zstandard.ZstdCompressor(level=level)
    return [packer.compress(p.tobytes()) for p in planes]


def from_planes(planes: list[bytes], n: int, kind: str = "byte") -> bytes:
    """The block of ``n`` ids."""
    reader = zstandard.ZstdDecompressor()
    out = np.zeros((n, 4), np.uint8)
    for k, p in enumerate(planes):
        plane = np.frombuffer(reader.decompress(p), np.uint8)
        if kind == "bit":
            out[:, k // 8] |= np.unpackbits(plane, count=n) << (k % 8)
        else:
            out[:, k] = plane
    return out.tobytes()


def write_blocks(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, chunk_ids: int = CHUNK_IDS, planes: str = "byte", level: int = 1) -> None:
    """Encodes every text, appends ``end_id``, and writes the chunks at ``path`` in ascending ``doc_id``.

    A null text is an empty one; a null ``doc_id`` comes first; rows of one ``doc_id`` follow each other
    by the hash of the text, then by the text, so that repeated rows keep their number and the order is
    the same in every run. An empty table gives an empty chunk table. Other columns are not read.
    """
    text = F.coalesce(column(docs, "text", "string"), F.lit(""))
    rows = docs.select(column(docs, "doc_id", "long"), text.alias("text")).withColumn("h", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("h"), F.col("text")]
    ordered = rows.repartitionByRange(*order[:2]).sortWithinPartitions(*order).select("doc_id", "text")

    def pack(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, shard, end = _encoder(tokenizer), TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes()

        def chunks() -> Iterator[tuple]:
            held, parts, size, chunk, row = [], [], 0, 0, 0
            for b in short(source):
                ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
                for doc_id, pieces in zip(ids, encoder(texts), strict=True):
                    before = 0
                    for piece in (*pieces, end):
                        at = 0
                        while at < len(piece):
                            n = min(len(piece) - at, 4 * (chunk_ids - size)) // 4
                            held.append(piece[at : at + 4 * n])
                            if parts and parts[-1][0] == row:
                                parts[-1] = (*parts[-1][:4], parts[-1][4] + n)
                            else:
                                parts.append((row, doc_id, before, size, n))
                            at, size, before = at + 4 * n, size + n, before + n
                            if size == chunk_ids:
                                yield finish(held, parts, size, chunk)
                                held, parts, size, chunk = [], [], 0, chunk + 1
                    row += 1
            if size:
                yield finish(held, parts, size, chunk)

        def finish(held: list[bytes], parts: list[tuple], size: int, chunk: int) -> tuple:
            block = b"".join(held)
            named = [dict(zip(("row", "doc_id", "before", "at", "n"), p, strict=True)) for p in parts]
            return shard, chunk, size, zlib.crc32(block), to_planes(block, planes, level), named

        yield from batches(chunks(), _CHUNKS, size=8)

    ordered.mapInArrow(pack, CHUNKS).write.mode("overwrite").option("compression", "uncompressed").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The chunk index with ``start``, the ids of the whole collection before the chunk; no plane is read."""
    chunks = spark.read.schema(CHUNKS).parquet(path).select("shard", "chunk", "n_ids", "crc", "parts")
    sizes = chunks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    first = sizes.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("shard_start"))
    in_shard = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("chunk")) - F.col("n_ids")
    return chunks.withColumn("start", in_shard).join(first, "shard").withColumn("start", F.col("start") + F.col("shard_start")).drop("shard_start")


def read_documents(spark: SparkSession, path: str, planes: str = "byte", chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32. A chunk that fails its checksum is an error."""
    chunks = spark.read.schema(CHUNKS).parquet(path)
    kind = "shard int, row long, doc_id long, at long, before long, n long, crc long"
    schema = pa.schema([("shard", pa.int32()), *((k, pa.int64()) for k in ("row", "doc_id", "at", "before", "n", "crc"))])

    def unpack(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple]:
            for b in short(source):
                for x in b.to_pylist():
                    block = memoryview(from_planes(x["planes"], x["n_ids"], planes))
                    if zlib.crc32(block) != x["crc"]:
                        raise ValueError(f"shard {x['shard']}, chunk {x['chunk']}: the checksum differs")
                    for p in x["parts"]:
                        part = block[4 * p["at"] : 4 * (p["at"] + p["n"])]
                        yield x["shard"], p["row"], p["doc_id"], x["chunk"] * chunk_ids + p["at"], p["before"], p["n"], zlib.crc32(part)

        yield from batches(parts(), schema)

    found = chunks.mapInArrow(unpack, kind)
    sizes = chunks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))  # a row for each shard, as many as tasks that wrote
    first = sizes.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("shard_start"))
    docs = found.groupBy("shard", "row").agg(
        F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("before", "n", "crc"))).alias("crcs"),
    )
    out = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("at", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def joined(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in short(source):
            crcs = []
            for parts in b.column("crcs").to_pylist():
                crc = parts[0]["crc"]
                for p in parts[1:]:
                    crc = crc32_after(crc, 4 * p["n"]) ^ p["crc"]
                crcs.append(crc)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in ("shard", "doc_id", "at", "n_tokens")), pa.array(crcs, pa.int64())], schema=out)

    rows = docs.mapInArrow(joined, "shard int, doc_id long, at long, n_tokens long, ids_crc32 long")
    return rows.join(first, "shard").select("doc_id", (F.col("at") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32")


@lru_cache(maxsize=1)
def _zero_bytes() -> list[list[int]]:
    """For each k, what 2**k zero bytes make of each of the 32 bits of a crc32 register."""
    step = [0xEDB88320, *(1 << i for i in range(31))]  # one zero bit
    apply = lambda m, v: _times(m, v)
    square = lambda m: [apply(m, x) for x in m]
    byte = square(square(square(step)))
    out = [byte]
    for _ in range(47):
        out.append(square(out[-1]))
    return out


def _times(matrix: list[int], vector: int) -> int:
    total, i = 0, 0
    while vector:
        if vector & 1:
            total ^= matrix[i]
        vector >>= 1
        i += 1
    return total


def crc32_after(crc: int, n: int) -> int:
    """What to combine by exclusive or with the crc32 of ``n`` bytes that follow those of ``crc``."""
    k = 0
    while n:
        if n & 1:
            crc = _times(_zero_bytes()[k], crc)
        n >>= 1
        k += 1
    return crc


def token_blocks(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Writes the chunks of ``docs`` to the shared folder and returns what the files hold of each document."""
    stash = Stash(docs.sparkSession, "token-blocks")
    write_blocks(docs, stash.path("chunks"), tokenizer, **options)
    return read_documents(docs.sparkSession, stash.path("chunks"), options.get("planes", "byte"), options.get("chunk_ids", CHUNK_IDS))
