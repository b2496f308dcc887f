"""Prefix trie of conversations by prefix doubling.

Turns get dense numbers; two neighbouring blocks of 2^j turns have the number of their pair of numbers, so
after log2(turns) joins every aligned block of a power of two turns has a name, and equal blocks the same.
The prefix of d turns is named by its binary decomposition: the prefix without d's lowest bit, then the
block of that size. Nodes are the groups of equal (depth, name). No step goes through a conversation turn by
turn, so long conversations cost rounds by the logarithm of their length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import Stash, column

#: Conversations c - c % FAMILY to c share turns; so many turns at most.
FAMILY, SHARED = 5, 9
#: Turns of a conversation whose sums one task makes; longer ones are summed in runs.
RUN = 4096
#: Bytes of joined ids that are one row on their way to a digest.
CHUNK = 1 << 16
#: Row numbers of a task are below this.
TASK_BITS = 33


def numbered(rows: DataFrame, stash: Stash, label: str, name: str) -> DataFrame:
    """The rows as written, numbered from 0 without gaps by task, then place in it. What is joined has one row a task."""
    kept = stash.keep(rows.withColumn("_at", F.monotonically_increasing_id()), label)
    task = F.shiftright("_at", TASK_BITS)
    sizes = kept.groupBy(task.alias("_task")).agg(F.count("*").alias("_n"))
    before = sizes.select("_task", (F.sum("_n").over(Window.orderBy("_task")) - F.col("_n")).alias("_before"))
    place = F.col("_at").bitwiseAND(F.lit((1 << TASK_BITS) - 1))
    return kept.join(F.broadcast(before), task == F.col("_task")).select(*rows.columns, (F.col("_before") + place).alias(name))


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, key, n_bytes); the key is the SHA-256 of role and text."""
    role, text = (F.coalesce(column(conversations, c, "string"), F.lit("")) for c in ("role", "text"))
    key = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.select(column(conversations, "conv_id", "long"), column(conversations, "turn", "long"), key.alias("key"), F.octet_length(text).cast("long").alias("n_bytes"))
    return rows.filter("conv_id is not null")


def _rebuilt(conversations: DataFrame, stash: Stash) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) of all rebuilt conversations, and their turns (conv_id, at, name, last, length)."""
    rows = _turns(conversations).withColumn("row", F.monotonically_increasing_id())  # so that equal rows can go to different tasks
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("key"), F.col("row")]
    placed = numbered(rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("row"), stash, "rows", "place")
    spans = stash.keep(placed.groupBy("conv_id").agg(F.min("place").alias("first"), F.count("*").alias("n")), "spans")
    h = F.crc32(F.col("conv_id").cast("string")) % SHARED
    own = spans.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).withColumn("h", h)
    convs = own.join(spans.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left")
    convs = convs.withColumn("shared", F.least("h", F.coalesce("base_n", F.lit(0))))
    convs = stash.keep(convs.withColumn("length", F.col("shared") + F.greatest(F.col("n") - F.col("h"), F.lit(0))), "convs")

    names = numbered(placed.select("key").distinct(), stash, "turn-names", "name")
    turns = placed.join(names, "key").select("conv_id", "place", "name", "n_bytes").join(convs, "conv_id")
    turns = stash.keep(turns.select("conv_id", (F.col("place") - F.col("first")).alias("at"), "name", F.col("n_bytes").alias("last"), "h", "shared", "length"), "turns")
    tails = turns.filter("at >= h").select("conv_id", (F.col("at") - F.col("h") + F.col("shared")).alias("at"), "name", "last", "length")
    heads = turns.filter(F.col("at") < SHARED).select(F.col("conv_id").alias("base"), "at", "name", "last")
    heads = convs.select("conv_id", "base", "h", "length").join(heads, "base").filter("at < h")
    built = stash.keep(tails.unionByName(heads.select("conv_id", "at", "name", "last", "length")), "blocks-0")
    stash.drop("rows", "spans", "turn-names", "turns")
    return convs.select("conv_id", "length"), built


def _prefixes(built: DataFrame, longest: int, stash: Stash) -> DataFrame:
    """(conv_id, depth, prefix, last, length): a name for every prefix with a turn or more, equal for equal prefixes of that depth."""
    blocks, top = [built], max(longest, 1).bit_length() - 1
    even, odd = F.col("at") % 2 == 0, F.col("at") % 2 == 1
    for j in range(1, top + 1):
        pairs = blocks[-1].groupBy("conv_id", F.shiftright("at", 1).alias("at")).agg(
            F.max(F.when(even, F.col("name"))).alias("a"), F.max(F.when(odd, F.col("name"))).alias("b"), F.max(F.when(odd, F.col("last"))).alias("last"), F.max("length").alias("length")
        )
        pairs = pairs.filter("b is not null")
        names = numbered(pairs.select("a", "b").distinct(), stash, f"names-{j}", "name")
        blocks.append(stash.keep(pairs.join(names, ["a", "b"]).select("conv_id", "at", "name", "last", "length"), f"blocks-{j}"))
        stash.drop(f"names-{j}")
    found = None
    for j in range(top, -1, -1):
        rows = blocks[j].filter(even).select("conv_id", F.shiftleft(F.col("at") + 1, j).alias("depth"), F.shiftleft("at", j).alias("before"), F.col("name").alias("b"), "last", "length")
        if found is None:
            rows = rows.withColumn("a", F.lit(0).cast("long"))
        else:
            before = found.select("conv_id", F.col("depth").alias("before"), F.col("prefix").alias("a"))
            rows = rows.join(before, ["conv_id", "before"], "left").withColumn("a", F.coalesce("a", F.lit(0)))  # 0: nothing before
            rows = stash.keep(rows, f"pairs-{j}")
        names = numbered(rows.select("depth", "a", "b").distinct(), stash, f"prefix-names-{j}", "prefix")
        now = stash.keep(rows.join(names, ["depth", "a", "b"]).select("conv_id", "depth", "prefix", "last", "length"), f"prefixes-{j}")
        stash.drop(f"blocks-{j}", f"pairs-{j}", f"prefix-names-{j}")
        found = now if found is None else found.unionByName(now)
    return found


def _digests(members: DataFrame) -> DataFrame:
    """(depth, prefix, ends_sha256) of the members (depth, prefix, conv_id) that end in a node.

    The ids of a node, in order, are joined where a range of them lies, into rows of some 64 KB; only these come
    together in one task, which reads them as a stream."""
    parts = pa.schema([("depth", pa.int64()), ("prefix", pa.int64()), ("low", pa.int64()), ("ids", pa.binary())])
    digests = pa.schema([("depth", pa.int64()), ("prefix", pa.int64()), ("ends_sha256", pa.string())])

    def joined(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, low, ids, size = None, None, [], 0
        for x in source:
            out = []
            for depth, prefix, c in zip(*(c.to_pylist() for c in x.columns), strict=True):
                if node != (depth, prefix) or size >= CHUNK:
                    if ids:
                        out.append((*node, low, b",".join(ids)))
                    node, low, ids, size = (depth, prefix), c, [], 0
                ids.append(b"%d" % c)
                size += len(ids[-1]) + 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), parts, strict=True)], schema=parts)
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*node, low, b",".join(ids)), parts, strict=True)], schema=parts)

    def digested(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, out = None, None, []
        for x in source:
            for depth, prefix, _, ids in zip(*(c.to_pylist() for c in x.columns), strict=True):
                if node == (depth, prefix):
                    digest.update(b",")
                else:
                    if node:
                        out.append((*node, digest.hexdigest()))
                    node, digest = (depth, prefix), hashlib.sha256()
                digest.update(ids)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), digests, strict=True)], schema=digests)
                out = []
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*node, digest.hexdigest()), digests, strict=True)], schema=digests)

    order = ("depth", "prefix", "conv_id")
    some = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined, "depth long, prefix long, low long, ids binary")
    return some.repartition("depth", "prefix").sortWithinPartitions("depth", "prefix", "low").mapInArrow(digested, "depth long, prefix long, ends_sha256 string")


def _subtrees(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """(depth, prefix, saved_tokens, n_leaves) of the nodes' subtrees.

    A node counts where its smallest member passes, so sums go up along that conversation only, from its end."""
    mine = nodes.select(F.col("low").alias("conv_id"), "depth", ((F.col("n_convs") - 1) * F.col("last")).alias("saved"), (F.col("longest") == F.col("depth")).cast("long").alias("leaf"))
    rows = found.select("conv_id", "depth", "prefix", "length").join(mine, ["conv_id", "depth"], "left").withColumn("run", F.floor((F.col("depth") - 1) / RUN))
    rows = rows.fillna(0, ["saved", "leaf"])
    runs = rows.filter(F.col("length") > RUN).groupBy("conv_id", "run").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    deeper = Window.partitionBy("conv_id").orderBy(F.desc("run")).rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("conv_id", "run", F.sum("saved").over(deeper).alias("later_saved"), F.sum("leaf").over(deeper).alias("later_leaf"))
    below = Window.partitionBy("conv_id", "run").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("saved", F.sum("saved").over(below)).withColumn("leaf", F.sum("leaf").over(below)).join(runs, ["conv_id", "run"], "left")
    saved, leaf = F.col("saved") + F.coalesce("later_saved", F.lit(0)), F.col("leaf") + F.coalesce("later_leaf", F.lit(0))
    return rows.groupBy("depth", "prefix").agg(F.sum(saved).alias("saved_tokens"), F.sum(leaf).alias("n_leaves"))


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    Turns go by ``turn`` (null first), equal ones by the SHA-256 of role and text, so that equal rows, which all
    count, change nothing. A null role or text is empty; a row without ``conv_id`` belongs to no conversation and
    is left out. Of very long texts only the digest moves, and very long conversations are summed in runs. An
    empty table gives no node, not even a root. Other columns are not read.
    """
    stash = Stash(conversations.sparkSession, "prefix-trie")
    convs, built = _rebuilt(conversations, stash)
    found = _prefixes(built, convs.agg(F.max("length")).first()[0] or 0, stash)
    grouped = found.groupBy("depth", "prefix").agg(F.min("conv_id").alias("low"), F.count("*").alias("n_convs"), F.max("last").alias("last"), F.max("length").alias("longest"))
    nodes = stash.keep(grouped, "nodes")

    up = found.select(F.col("conv_id").alias("low"), (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"))
    links = stash.keep(nodes.filter("depth > 1").select("low", "depth").join(up, ["low", "depth"]).withColumn("up_depth", F.col("depth") - 1), "links")
    above = nodes.select(F.col("depth").alias("up_depth"), F.col("prefix").alias("up"), F.col("low").alias("parent_conv_id"))
    parents = links.join(above, ["up_depth", "up"]).select("low", "depth", "parent_conv_id")
    children = links.groupBy(F.col("up_depth").alias("depth"), F.col("up").alias("prefix")).agg(F.count("*").alias("n_children"))
    ends = found.filter("depth = length").select("depth", "prefix", "conv_id")
    no_turns = convs.filter("length = 0").select(F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("prefix"), "conv_id")
    digests = stash.keep(_digests(ends.unionByName(no_turns)), "digests")

    none = F.lit(hashlib.sha256(b"").hexdigest())
    root = F.lit(None).cast("long") if nodes.isEmpty() else convs.agg(F.min("conv_id")).scalar()
    rows = nodes.join(_subtrees(found, nodes), ["depth", "prefix"]).join(children, ["depth", "prefix"], "left").join(digests, ["depth", "prefix"], "left").join(parents, ["low", "depth"], "left")
    of = lambda c: nodes.agg(c).scalar()
    rows = rows.select(
        F.col("low").alias("conv_id"), "depth", F.when(F.col("depth") == 1, root).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )
    top: dict[str, Column] = {
        "conv_id": F.col("conv_id"), "depth": F.lit(0).cast("long"), "parent_conv_id": F.lit(None).cast("long"), "n_convs": F.col("n_convs"), "n_children": of(F.count_if(F.col("depth") == 1)),
        "n_leaves": F.greatest(of(F.count_if(F.col("longest") == F.col("depth"))), F.lit(1)), "saved_tokens": F.coalesce(of(F.sum((F.col("n_convs") - 1) * F.col("last"))), F.lit(0)),
        "ends_sha256": F.coalesce(digests.filter("depth = 0").agg(F.first("ends_sha256")).scalar(), none),
    }
    roots = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0").select(*[c.alias(k) for k, c in top.items()])
    out = stash.keep(rows.unionByName(roots), "trie")
    stash.drop("convs", "nodes", "links", "digests", *[f"prefixes-{j}" for j in range(64)])
    return out
