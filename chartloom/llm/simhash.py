"""SimHash near-duplicates: fingerprints of whole texts, linked by searches in BK-trees.

Two fingerprints that differ in at most r of 64 bits agree in two of r + 2 blocks of bits, so every
fingerprint goes to a shard for each pair of blocks, named by the bits there, and meets all its links in some
shard. A shard is a BK-tree: a node's children are keyed by their Hamming distance to it, and a search for
radius r at distance d follows only the edges d - r to d + r. A tree has a bounded number of nodes; a larger
shard is several trees, and each of them gets the rows of the others to look up. Only a spanning forest of the
links leaves a task.

The trees go to the tasks by a shuffle: all of them together grow with the input, so no broadcast could hold them.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stash, batches, column, short
from .graph import components

WORDS, RADIUS, SEED = 3, 3, 42
#: Nodes of a tree, on average, where a shard is larger than that.
TREE = 8192
#: Shingles whose bits are counted at a time; rows of trees that are held at a time; steps of a search that are open at a time.
BLOCK, HELD, OPEN = 1 << 16, 1 << 18, 1 << 21
#: A key of an edge is 65 * node + distance.
EDGES = np.int64(65)


def fingerprint(text: bytes | None, size: int = WORDS) -> int:
    """The 64 bits that more than half of the hashes of the shingles have, as a signed integer; 0 without words."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts, n = np.concatenate([[0], ends[:-1]]), max(1, len(words) - size + 1)
    ends = ends[-n:] - 1
    ones = np.zeros(64, np.int64)
    for i in range(0, n, BLOCK):
        spans = zip(starts[i : min(i + BLOCK, n)].tolist(), ends[i : i + BLOCK].tolist(), strict=True)
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp) of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in short(source):
            yield pa.RecordBatch.from_arrays([x.column("doc_id"), pa.array([fingerprint(t) for t in x.column("text").to_pylist()], pa.int64())], schema=schema)

    return docs.select(column(docs, "doc_id", "long"), column(docs, "text", "string").cast("binary").alias("text")).mapInArrow(run, "doc_id long, fp long")


def masks(radius: int) -> list[int]:
    """The bits of each pair of blocks, as signed integers."""
    edges = [64 * i // (radius + 2) for i in range(radius + 3)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [((x | y) + (1 << 63)) % (1 << 64) - (1 << 63) for x, y in combinations(blocks, 2)]


class Forest:
    """BK-trees of rows that lie tree by tree, all built at once; a tree's first row is its root.

    The tree is the one that inserting row after row gives: in each round every row that has no place yet stands
    at a node, and of those with the same distance to it the first becomes its child, to which the others move."""

    def __init__(self, fps: np.ndarray, tree: np.ndarray):
        self.fps, n = fps, len(fps)
        first = np.flatnonzero(np.concatenate([[True], tree[1:] != tree[:-1]])) if n else np.empty(0, np.int64)
        self.sizes = np.diff(np.append(first, n))
        self.root = np.repeat(first, self.sizes)
        self.size = np.repeat(self.sizes, self.sizes)
        at, waiting = self.root.copy(), np.flatnonzero(np.arange(n) != self.root)
        keys, children = [], []
        while len(waiting):
            key = at[waiting] * EDGES + np.bitwise_count(fps[waiting] ^ fps[at[waiting]])
            edge, child, which = np.unique(key, return_index=True, return_inverse=True)
            keys.append(edge)
            children.append(waiting[child])
            at[waiting] = waiting[child][which]
            stays = np.ones(len(waiting), bool)
            stays[child] = False
            waiting = waiting[stays]
        keys = np.concatenate(keys) if keys else np.empty(0, np.int64)
        order = np.argsort(keys)
        self.keys, self.children = keys[order], (np.concatenate(children) if children else np.empty(0, np.int64))[order]

    def search(self, fps: np.ndarray, roots: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, row) within the radius; each query starts at its root."""
        query, node = np.arange(len(fps)), roots
        while len(query):
            d = np.bitwise_count(fps[query] ^ self.fps[node]).astype(np.int64)
            near = d <= radius
            if near.any():
                yield query[near], node[near]
            low = np.searchsorted(self.keys, node * EDGES + np.maximum(d - radius, 0))
            n = np.searchsorted(self.keys, node * EDGES + np.minimum(d + radius, 64), "right") - low
            query = np.repeat(query, n)
            node = self.children[np.repeat(low - (np.cumsum(n) - n), n) + np.arange(len(query))]


def united(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of ``a`` and ``b`` in ``label``, where every entry points to the least of its set."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, now := label[label]):
            label[:] = now


def spanning(fps: np.ndarray, tree: np.ndarray, looks: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of linked fingerprints that join what the searches in the trees find. Rows lie by ``tree``; those with
    ``looks`` are in no tree but are looked up in that of their number, the others are in it and are looked up too."""
    inside = np.flatnonzero(~looks)
    forest = Forest(fps[inside].view(np.uint64), tree[inside])
    starts = np.flatnonzero(np.concatenate([[True], tree[inside][1:] != tree[inside][:-1]])) if len(inside) else inside
    of = np.searchsorted(tree[inside][starts], tree)  # the place of each row's tree
    held = np.zeros(len(fps), bool)
    known = of < len(starts)
    held[known] = tree[inside][starts][of[known]] == tree[known]
    size = np.where(held, forest.sizes[np.minimum(of, max(len(starts) - 1, 0))] if len(starts) else 0, 0)
    label = np.arange(len(fps))
    asked = np.flatnonzero((size > 0) & (looks | (size > 1)))
    steps = np.cumsum(size[asked]) // OPEN  # queries whose trees have so many nodes in all go together
    for part in np.split(asked, np.flatnonzero(np.diff(steps)) + 1) if len(asked) else []:
        for query, row in forest.search(fps[part].view(np.uint64), starts[of[part]], radius):
            united(label, part[query], inside[row])
    linked = np.flatnonzero(label != np.arange(len(fps)))
    return fps[linked], fps[label[linked]]


def links(classes: DataFrame, stash: Stash, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """Edges (u, v) between distinct fingerprints ``fp``, at most one for each row of a tree, which join all that are
    within the radius of each other."""
    shards = F.explode(F.array(*[F.struct(F.lit(k).alias("pair"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for k, m in enumerate(masks(radius))])).alias("shard")
    members = classes.select("fp", shards).select("fp", "shard.pair", "shard.bits")
    sizes = stash.keep(members.groupBy("pair", "bits").agg(F.count("*").alias("n")).filter("n > 1"), "sizes")
    trees = F.ceil(F.col("n") / tree).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int")
    rows = members.join(sizes, ["pair", "bits"]).withColumn("trees", trees).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)))
    rows = rows.select("pair", "bits", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), (F.col("own") > F.col("other")).alias("looks"), "fp")
    key = ["pair", "bits", "a", "b"]
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def found(last: bool) -> Iterator[pa.RecordBatch]:
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            change = np.any([c[1:] != c[:-1] for c in columns[:4]], axis=0)
            cut = len(columns[0]) if last else (np.flatnonzero(change)[-1] + 1 if change.any() else 0)  # the last tree may go on
            tree = np.concatenate([[0], np.cumsum(change)])[:cut]
            u, v = spanning(columns[5][:cut], tree, columns[4][:cut], radius)
            held[:] = [[c[cut:] for c in columns]]
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], schema=schema)

        for x in source:
            held.append([c.to_numpy(zero_copy_only=False) for c in x.columns])
            if sum(len(c[0]) for c in held) >= HELD:
                yield from found(False)
        if held:
            yield from found(True)

    return rows.repartition(*key).sortWithinPartitions(*key, "looks").mapInArrow(run, "u long, v long").distinct()


def simhash_groups(docs: DataFrame, radius: int = RADIUS, tree: int = TREE) -> DataFrame:
    """Per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits), component_id (the least ``doc_id`` that links
    reach; null if none has one), n_equal (rows with that fingerprint).

    Fingerprints are linked at ``radius`` or fewer differing bits. A null or empty text has the fingerprint zero,
    which is linked like any other; of a very long text every shingle counts. Repeated rows and rows of one
    ``doc_id`` with different texts count each; ties give one result, as the least id is one. An empty table gives
    none; other columns are not read.
    """
    stash = Stash(docs.sparkSession, "simhash")
    rows = stash.keep(fingerprints(docs), "rows")
    classes = stash.keep(rows.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count("*").alias("n_equal")), "classes")
    edges = stash.keep(links(classes, stash, radius, tree), "links")
    found = stash.keep(components(edges, stash), "found")
    part: Column = F.coalesce("component", "fp")
    parts = stash.keep(classes.join(found, F.col("fp") == F.col("id"), "left").select("fp", "low", "n_equal", part.alias("part")), "parts")
    least = stash.keep(parts.groupBy("part").agg(F.min("low").alias("component_id")), "least")
    named = stash.keep(parts.join(least, "part").select("fp", "n_equal", "component_id"), "named")
    out = stash.keep(rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_equal"), "groups")
    stash.drop("rows", "classes", "sizes", "links", "found", "parts", "least", "named")
    return out
