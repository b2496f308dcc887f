"""Benchmark items in documents, up to a number of edits: pieces by the pigeonhole principle, then Myers.

An item that occurs with at most k edits, cut into k + 1 pieces, has one piece that no edit touches. An
Aho-Corasick automaton finds every exact piece of every item in one pass over a text; where a piece
stands, Myers' bit-parallel algorithm computes the edit distance of the whole item to the text around.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, column, short

#: One edit for so many characters of an item: 7 hundredths of its length. An item too short for an edit is found
#: where it stands as whole words.
CHARS_PER_EDIT = 14
#: Characters of items in one automaton; more items are searched in as many blocks as they need.
BLOCK_CHARS = 2_000_000
#: One edit takes so many of an item's distinct q-grams away at most, as long as they are; text that lacks
#: more of them needs no distance.
GRAM = 4

_WORD = re.compile(r"[^\W_]+")


def normalised(text: str | None) -> str:
    """Letters and digits in lower case, with one space for all that stands between them."""
    return " ".join(_WORD.findall(text.lower())) if text else ""


def budget(item: str) -> int:
    return len(item) // CHARS_PER_EDIT


def pieces(item: str, k: int) -> Iterator[tuple[int, str]]:
    """k + 1 pieces of nearly equal length with their places."""
    for i in range(k + 1):
        at, end = i * len(item) // (k + 1), (i + 1) * len(item) // (k + 1)
        yield at, item[at:end]


def masks_of(item: str) -> dict[str, int]:
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    return dict(masks)


def least_distance(masks: dict[str, int], m: int, text: str) -> int:
    """The least edit distance of a pattern of m characters to any substring of ``text``."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, least = full, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | (full & ~(xh | pv)), pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
            least = min(least, score)
        ph, mh, xv = (ph << 1) & full, (mh << 1) & full, eq | mv
        pv, mv = mh | (full & ~(xv | ph)), ph & xv
    return least


def grams(text: str) -> set[str]:
    return {text[i : i + GRAM] for i in range(len(text) - GRAM + 1)}


class Matcher:
    """The items of one block."""

    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick

        self.items = [(i, t, budget(t), masks_of(t), grams(t)) for i, t in items]
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, (_, text, k, _, _) in enumerate(self.items):
            for at, piece in pieces(text, k):
                places[piece].append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def __call__(self, text: str | None) -> list[tuple[int, int, int]]:
        """(item_id, distance, budget) of each item that the text holds."""
        if not self.items:
            return []
        text = normalised(text)
        spans: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for end, (length, where) in self.automaton.iter(text):
            for n, at in where:
                _, item, k, _, _ = self.items[n]
                start = end + 1 - length - at
                spans[n].append((max(0, start - k), start + len(item) + k))
        found = []
        for n, around in spans.items():
            item_id, item, k, masks, own = self.items[n]
            if (item if k else f" {item} ") in (text if k else f" {text} "):
                found.append((item_id, 0, k))
                continue
            if not k:
                continue
            around.sort()
            least, (low, high) = k + 1, around[0]
            for a, b in [*around[1:], (math.inf, 0)]:
                if a > high:
                    around_it = text[low:high]
                    if len(own - grams(around_it)) <= GRAM * k:
                        least = min(least, least_distance(masks, len(item), around_it))
                    low, high = a, b
                high = max(high, b)
            if least <= k:
                found.append((item_id, least, k))
        return found


def _blocks(bench: DataFrame, block_chars: int, least: int = 1) -> list[Broadcast]:
    """The items that can be searched, in blocks of a bounded size, each sent to every task."""
    fold = F.pandas_udf(lambda s: s.map(normalised), "string")
    items = bench.select(column(bench, "item_id", "long"), column(bench, "text", "string")).filter("text is not null")
    items = items.select("item_id", fold("text").alias("text")).filter(F.length("text") >= least).distinct()
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-size // block_chars)
    of = F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1)))
    spark = bench.sparkSession
    return [spark.sparkContext.broadcast([tuple(r) for r in items.filter(of == b).orderBy("item_id", "text").collect()]) for b in range(n)]


def matches(docs: DataFrame, bench: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, item_id, distance, budget) for each row of ``docs`` and item that it holds.

    Case, punctuation and white space do not count. Null and empty texts and items match nothing; items without
    a budget, under ``CHARS_PER_EDIT`` characters, match as whole words. Null ids stay null; equal items are one, repeated rows
    give repeated results; a very long text is searched whole; empty tables give none; other columns, of any
    name, are not read.
    """
    texts = docs.select(column(docs, "doc_id", "long"), column(docs, "text", "string"))
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int64()), ("budget", pa.int64())])
    out = None
    for items in _blocks(bench, block_chars):

        def run(source: Iterator[pa.RecordBatch], items: Broadcast = items) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items.value)
            rows = ((i, *m) for x in short(source) for i, t in zip(*(c.to_pylist() for c in x.columns), strict=True) for m in matcher(t))
            yield from batches(rows, schema)

        found = texts.mapInArrow(run, "doc_id long, item_id long, distance long, budget long")
        out = found if out is None else out.unionByName(found)
    empty = docs.sparkSession.createDataFrame([], "doc_id long, item_id long, distance long, budget long")
    return empty if out is None else out


def decontaminate(docs: DataFrame, bench: DataFrame, block_chars: int = BLOCK_CHARS, least_chars: int = 1) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; nothing is shuffled.

    A caller whose benchmark has answers such as "yes" can leave items out by ``least_chars``, counted after case
    and punctuation. Rows without text stay, and so does every row where there is no such column or the benchmark
    is empty; repeated rows and rows of one id are decided each by its own text; very long texts are searched
    whole; other columns, of any name, stay as they are.
    """
    if "text" not in docs.columns:
        return docs
    for items in _blocks(bench, block_chars, least_chars):

        def run(source: Iterator[pa.RecordBatch], items: Broadcast = items) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(items.value)
            for x in short(source):
                yield x.filter(pa.array([not matcher(t) for t in x.column("text").to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
