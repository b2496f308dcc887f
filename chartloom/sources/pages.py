"""Chart pages and links, parsed in Arrow batches with the standard library's HTML parser."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ..functions.text import parse_euro, parse_int, week_range
from ..scratch import Scratch

# What the links and the fields of an entry look like.
FILM_LINK = re.compile(r"(?:https?://[^/]+)?/film/[^/]+/(\d+)/scheda/?$")
FIELDS = re.compile(r"Settimane:\s*(\d+)\s*Distribuzione:\s*(.+?)\s*Inc\.?\s*weekend:\s*€\s*([\d.,]+)\s*Schermi:\s*(\d+)\s*Inc\.?\s*totale:\s*€\s*([\d.,]+)", re.DOTALL | re.IGNORECASE)
RANK = re.compile(r"\b(\d{1,2})\b")
ANCESTORS = 3
#: Pages that are parsed before their rows are sent.
PAGES = 100
_VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))


class _Node:
    __slots__ = ("attributes", "parts", "parent", "tag")

    def __init__(self, tag: str, attributes: dict, parent: _Node | None):
        self.tag, self.attributes, self.parent, self.parts = tag, attributes, parent, []

    def text(self, joint: str) -> str:
        """The stripped texts below, in order."""
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                if x.strip():
                    out.append(x.strip())
            else:
                todo.extend(reversed(x.parts))
        return joint.join(out)


class _Tree(HTMLParser):
    """Elements and texts; what is not closed is closed with its parent."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", {}, None)
        self.links: list[_Node] = []
        self.feed(html)
        self.close()

    def updatepos(self, i, j):
        """Lines are not counted: nothing asks for them."""
        return j

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, dict(attrs), self.at)
        self.at.parts.append(node)
        if tag == "a" and node.attributes.get("href") is not None:
            self.links.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        if self.at.tag not in ("script", "style"):
            self.at.parts.append(data)


def links(html: str | None) -> list[tuple[int, str, str]]:
    """(seq, href, text) of the links of a page."""
    return [(k, a.attributes["href"], a.text(" ")) for k, a in enumerate(_Tree(html or "").links)]


def entries(html: str | None) -> tuple[str, list[tuple]]:
    """The page's text, and of each link to a film whose surroundings have all fields:
    (seq, rank, title, film, href, weeks, distributor, weekend, screens, total) as they are spelt."""
    tree, found = _Tree(html or ""), []
    for seq, a in enumerate(tree.links):
        film = FILM_LINK.search(a.attributes["href"])
        if not film:
            continue
        # wider only while something is missing: what lies further out comes later in the text, so it would not be found first
        text, node = a.text("\n"), a.parent
        fields, rank = FIELDS.search(text), RANK.search(text)
        for _ in range(ANCESTORS):
            if node is None or (fields and rank):
                break
            text, node = text + "\n" + node.text("\n"), node.parent
            fields, rank = FIELDS.search(text), RANK.search(text)
        title = (a.attributes.get("title") or a.text(" ")).strip()
        if fields and rank and title:
            found.append((seq, int(rank[1]), title, film[1], a.attributes["href"], fields[1], " ".join(fields[2].split()), fields[3], fields[4], fields[5]))
    return tree.root.text(" "), found


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, seq, href, text) for (page_id, html)."""
    schema = pa.schema([("page_id", pa.int64()), ("seq", pa.int64()), ("href", pa.string()), ("text", pa.string())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in source:
            rows = [(i, *link) for i, html in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True) for link in links(html)]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=schema)

    return pages.select("page_id", "html").mapInArrow(run, "page_id long, seq long, href string, text string")


FIELD_NAMES = ("seq", "rank", "title", "film", "href", "weeks", "distributor", "weekend", "screens", "total")
SPELT = StructType([StructField(n, LongType() if n in ("seq", "rank") else StringType()) for n in FIELD_NAMES])


def first_ranks(found: list[tuple]) -> list[tuple]:
    """The first entry of each rank; entries come by ``seq``."""
    first: dict[int, tuple] = {}
    for e in found:
        first.setdefault(e[1], e)
    return list(first.values())


def read(html: str | None) -> tuple[str | None, list[tuple], str | None]:
    """(text, first entry of each rank, error) of a page; one that cannot be read has only the error."""
    try:
        text, found = entries(html)
    except (ValueError, AssertionError, RecursionError) as e:
        return None, [], f"{type(e).__name__}: {e}"
    return text, first_ranks(found), None


def listed(found: Sequence[list[tuple]]) -> pa.ListArray:
    """The entries of each page as one Arrow column."""
    flat = list(zip(*[e for page in found for e in page], strict=True)) or [()] * len(FIELD_NAMES)
    fields = [pa.array(v, pa.int64() if n in ("seq", "rank") else pa.string()) for n, v in zip(FIELD_NAMES, flat, strict=True)]
    ends = list(accumulate(map(len, found), initial=0))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(fields, FIELD_NAMES))


def parsed(pages: DataFrame) -> DataFrame:
    """``pages`` with (page_text, entries, error) in place of ``html``: a row for each page, so that a page's text moves once."""
    rest = [c for c in pages.columns if c != "html"]
    schema = StructType([*pages.select(*rest).schema.fields, StructField("page_text", StringType()), StructField("entries", ArrayType(SPELT)), StructField("error", StringType())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in source:
            html = x.column(len(rest))
            for k in range(0, len(x), PAGES):
                texts, found, errors = zip(*[read(h.as_py()) for h in html[k : k + PAGES]], strict=True)
                columns = [*x.slice(k, PAGES).columns[: len(rest)], pa.array(texts, pa.string()), listed(found), pa.array(errors, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return pages.select(*rest, "html").mapInArrow(run, schema)


def judged(pages: DataFrame, requested: Column | None = None) -> DataFrame:
    """``parsed`` pages with their ``week`` and the ``reason`` for which a page is refused: it cannot be read, names no week, is
    (with ``requested``, a date column of ``pages``) of another week, or has no entry."""
    asked = pages.withColumn("requested", (F.lit(None) if requested is None else requested).cast("date"))
    rows = parsed(asked).withColumn("week", week_range(F.col("page_text"))).drop("page_text")
    start, end = F.col("week.week_start"), F.col("week.week_end")
    other = F.concat(F.lit("the page is of the week "), start.cast("string"), F.lit(".."), end.cast("string"), F.lit(", which has no "), F.col("requested").cast("string"))
    reason = (
        F.when(F.col("error").isNotNull(), F.concat(F.lit("the page cannot be read: "), "error")).when(start.isNull() | end.isNull(), "the page names no week")
        .when(~F.col("requested").between(start, end), other).when(F.size("entries") == 0, "the page has no entry")
    )
    return rows.withColumn("reason", reason).drop("requested", "error")


def tried(pages: DataFrame, origin: str, requested: Column | None = None) -> DataFrame:
    """Chart rows of pages (page_id, html, ...), the first link for each rank, or one row with a ``reason`` for a page that is
    refused. ``page_id`` is the key of ``pages``, whose further columns go with the rows."""
    rest = [c for c in pages.columns if c not in ("page_id", "html")]
    rows = judged(pages, requested).withColumn("e", F.explode_outer(F.when(F.col("reason").isNull(), F.col("entries"))))
    href = F.col("e.href")
    url = F.when(F.startswith(href, F.lit("http")), href).otherwise(F.concat(F.lit(origin), href))
    return rows.select(
        "page_id", *rest, "week.week_start", "week.week_end", "e.rank", "e.title", "e.distributor", parse_euro(F.col("e.weekend")).alias("weekly_gross"), parse_euro(F.col("e.total")).alias("total_gross"),
        parse_int(F.col("e.screens")).alias("screen_count"), F.col("e.weeks").cast("long").alias("weeks_in_release"), F.col("e.film").alias("source_movie_id"), url.alias("source_url"), "reason",
    )


def dead_letters(pages: DataFrame, requested: Column | None = None) -> DataFrame:
    """The pages that ``tried`` refuses, without ``html``, each with its ``reason``."""
    return judged(pages, requested).filter("reason is not null").drop("entries", "week")


def chart_pages(pages: DataFrame, origin: str, requested: Column | None = None) -> DataFrame:
    """The chart rows of the pages that ``tried`` does not refuse."""
    return tried(pages, origin, requested).filter("reason is null").drop("reason")


def first_page(pages: DataFrame, requested: Column | None = None) -> DataFrame:
    """Of pages (request, priority, page_id, html, ...) the first of each request that is not refused, without ``html``.

    As a reader tries them: the first page of each request, and all others of the requests which that leaves open. Whatever
    the pages are, the answer is that of trying all. ``pages`` are written once, as both turns read them."""
    scratch = Scratch(pages.sparkSession, "pages")
    rest = [c for c in pages.columns if c not in ("request", "html")]
    order = ("priority", "page_id", *[c for c in rest if c not in ("priority", "page_id")])
    held = scratch.keep(pages, "tried")
    start = held.groupBy("request").agg(F.min(F.struct("priority", "page_id")).alias("x")).select("request", "x.*")

    def answers(some: DataFrame) -> DataFrame:
        good = judged(some, requested).filter("reason is null")
        return good.groupBy("request").agg(F.min(F.struct(*order)).alias("x")).select("request", "x.*")

    key = ["request", "priority", "page_id"]
    first = scratch.keep(answers(held.join(start, key, "left_semi")), "first")
    return first.unionByName(answers(held.join(first, "request", "left_anti")))


def snapshots(pages: DataFrame) -> DataFrame:
    """(url, content_sha256) of raw pages."""
    return pages.select("page_id", "url", F.sha2("html", 256).alias("content_sha256"))
