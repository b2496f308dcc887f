"""What the corpus operators share: tables in the shared folder, Arrow streams, hashes of words."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six bytes that separate words: space and \t \n \v \f \r. ``bytes.split()`` splits at the same.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of an Arrow batch that are turned into Python objects at a time: texts can be long.
BATCH_ROWS = 256
#: Removes the shuffle files of a query when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only in a single process, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is unset: it has to name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="chartloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Stash:
    """Tables written under the shared folder, which cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)  # what the last reader still needs goes with the application

    def path(self, label: str) -> str:
        return f"{self.root}/{label}"

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """``df`` as written and read again; the shuffle files that this took are removed."""
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("overwrite").parquet(self.path(label))
        finally:
            self.spark.conf.set(CLEANUP, before)
        return self.spark.read.schema(df.schema).parquet(self.path(label))

    def drop(self, *labels: str) -> None:
        """Removes tables that no later step reads."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for label in labels:
            path = jvm.org.apache.hadoop.fs.Path(self.path(label))
            path.getFileSystem(conf).delete(path, True)


def short(source: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few rows; Spark bounds a whole batch by its bytes."""
    for x in source:
        for at in range(0, x.num_rows, BATCH_ROWS):
            yield x.slice(at, BATCH_ROWS)


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Tuples as record batches."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch(held, schema)
            held = []
    if held:
        yield batch(held, schema)


def batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


class WordHashes:
    """64-bit hashes of words, remembered up to a bound that is a matter of speed only."""

    def __init__(self, most: int = 400_000, seed: int = 0):
        self.most, self.seed, self.known = most, seed, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        if len(known) > self.most:
            known.clear()
        try:
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w, self.seed)
            return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A finaliser over unsigned 64-bit integers: every bit of the input moves every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every run of ``n`` word hashes, in order; none when there are fewer words.

    Doubling: the hash of 2m words is made of two hashes of m words, so n costs log n passes.
    """
    count = len(hashes) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    width, power, done, out = 1, hashes, 0, None
    rest = n
    while rest:
        if rest & 1:
            part = power[done : done + count]
            out = mix(part + np.uint64(width)) if out is None else mix(out * np.uint64(0x9E3779B97F4A7C15) + part)
            done += width
        rest >>= 1
        if rest:
            power = mix(power[: len(power) - width] * np.uint64(0x9E3779B97F4A7C15) + power[width:])
            width *= 2
    return out


#: Bits of a filter of ids: it is sent to every task, 4 MB at most. A fuller one only lets more rows through.
FILTER_BITS, BITMAP_BITS = 1 << 25, 1 << 15


def among(rows: DataFrame, name: str, ids: DataFrame, of: str) -> DataFrame:
    """The rows whose ``name`` may be a value of ``of`` (of the same type) in ``ids``, so that a join moves few others."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    bitmap = ids.select(place(of).alias("p")).groupBy(F.floor(F.col("p") / BITMAP_BITS).alias("f_bucket")).agg(F.bitmap_construct_agg(F.col("p") % BITMAP_BITS).alias("f_bits"))
    held = rows.withColumn("f_place", place(name))
    held = held.join(F.broadcast(bitmap), F.floor(F.col("f_place") / BITMAP_BITS) == F.col("f_bucket"))
    at = F.col("f_place") % BITMAP_BITS
    byte = F.conv(F.hex(F.substring(F.col("f_bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return held.filter(byte.bitwiseAND(F.pow(F.lit(2), at % 8).cast("int")) > 0).select(*rows.columns)


def column(df: DataFrame, name: str, kind: str) -> F.Column:
    """The column of that name, whatever else the table has; null of that type where it is absent."""
    return df[name].cast(kind).alias(name) if name in df.columns else F.lit(None).cast(kind).alias(name)


def packed(docs: DataFrame, **kinds: str) -> DataFrame:
    """The rows as one struct ``_row`` beside the named columns, so that no other name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *[column(docs, k, v) for k, v in kinds.items()])


def unpacked(rows: DataFrame, columns: list[str], **replaced: F.Column) -> DataFrame:
    """The columns of what was packed, some of them replaced."""
    return rows.select(*[replaced.get(c, F.col("_row")[c]).alias(c) for c in columns])
