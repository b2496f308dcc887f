"""Secrets in texts: patterns, and automata inferred from what the patterns find.

The credentials that the patterns label are the examples. A prefix tree of them is folded into a
probabilistic automaton by merging states whose frequencies do not differ significantly (Hoeffding
bounds), one automaton for each kind. Every other token is a candidate; it becomes a span of kind ``format``
if its likelihood for each character, under one of the automata, is no less than nearly all examples have,
and no less than under the automata of ordinary tokens, shorter and longer ones.
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Stash, batches, column, short

# The kinds in the order of the report, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "format")
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
LEAST_VALUE, LEAST_ACCESS = 6, 20
#: Every other token of as many characters as the shortest credential is a candidate.
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_.=-])[A-Za-z0-9+/_.=-]{6,}")
#: Ordinary tokens of so many characters and more have an automaton of their own.
LONG_TOKEN = 20

#: Labelled credentials of each kind, and ordinary tokens, that an automaton is inferred from at most; they
#: are those with the least hashes.
EXAMPLES = 800
#: Characters of the longest value in that sample, which bounds the driver's memory with ``EXAMPLES``: examples are
#: read whole, and what is scored is scored whole, at any length.
EXAMPLE_CHARS = 512
#: Significance of a difference between two states.
ALPHA = 0.05
#: The part of the examples whose likelihood may be lower than a candidate's has to be.
OUTLIERS = 0.05
#: The probability of what was never seen in a state.
UNSEEN = 1e-4
#: Words whose verdict a worker remembers, and their characters at most; a matter of speed only.
REMEMBERED, REMEMBERED_CHARS = 300_000, 80

_CLASSES = {c: "0" if c < 58 else "A" if 65 <= c <= 70 else "G" if 71 <= c <= 90 else "a" if 97 <= c <= 102 else "g" for c in (*range(48, 58), *range(65, 91), *range(97, 123))}


def symbols(token: str) -> str:
    """Characters by class: digits, letters a-f and others in either case; all else as it is."""
    return token.translate(_CLASSES)


def find(text: str | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, str]], list[tuple[int, int, str]]]:
    """Base spans (start, kind, end), labelled values (kind, value) and candidates (start, end, token) of a text."""
    if not text:
        return [], [], []
    spans, values = [], []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= LEAST_VALUE:
                spans.append((m.start(), 0, m.end()))
                values.append((0, m[2]))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if len(m[0]) >= LEAST_ACCESS:
                spans.append((m.start(), 1, m.end()))
                values.append((1, m[0]))
    for m in HEX.finditer(text):
        spans.append((m.start(), 2, m.end()))
        values.append((2, m[0]))
    spans.sort()
    candidates = ((m.start(), m.end(), m[0]) for m in CANDIDATE.finditer(text))
    if spans:  # a token meets one if, of those that start before its end, one ends after its start
        starts, ends = [a for a, _, _ in spans], list(accumulate((b for _, _, b in spans), max))
        candidates = ((s, e, t) for s, e, t in candidates if not (k := bisect_left(starts, e)) or ends[k - 1] <= s)
    return spans, values, list(candidates)


class Automaton:
    """A deterministic probabilistic automaton over symbol classes; state 0 is the first."""

    def __init__(self, examples: list[str]):
        #: next[state][symbol], seen[state][symbol], ends[state], total[state]
        self.next: list[dict[str, int]] = [{}]
        self.seen: list[dict[str, int]] = [{}]
        self.ends, self.total = [0], [0]
        for e in sorted(examples):
            self._add(e)
        self._merge()

    def _add(self, example: str) -> None:
        state = 0
        self.total[0] += 1
        for c in example:
            if c not in self.next[state]:
                self.next[state][c] = len(self.next)
                self.next.append({})
                self.seen.append({})
                self.ends.append(0)
                self.total.append(0)
            self.seen[state][c] = self.seen[state].get(c, 0) + 1
            state = self.next[state][c]
            self.total[state] += 1
        self.ends[state] += 1

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        return n1 > 0 and n2 > 0 and abs(f1 / n1 - f2 / n2) > math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if self._differ(self.ends[a], self.total[a], self.ends[b], self.total[b]):
                return False
            for c in self.seen[a].keys() | self.seen[b].keys():
                if self._differ(self.seen[a].get(c, 0), self.total[a], self.seen[b].get(c, 0), self.total[b]):
                    return False
                if c in self.next[a] and c in self.next[b]:
                    todo.append((self.next[a][c], self.next[b][c]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Adds the tree below b to a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.ends[a] += self.ends[b]
            self.total[a] += self.total[b]
            for c, n in self.seen[b].items():
                self.seen[a][c] = self.seen[a].get(c, 0) + n
                if c in self.next[a]:
                    todo.append((self.next[a][c], self.next[b][c]))
                else:
                    self.next[a][c] = self.next[b][c]

    def _merge(self) -> None:
        red, at = [0], 0
        while at < len(red):  # states below the red ones are trees still
            state = red[at]
            for c in sorted(self.next[state]):
                blue = self.next[state][c]
                if blue in red:
                    continue
                into = next((r for r in red if self._compatible(r, blue)), None)
                if into is None:
                    red.append(blue)
                else:
                    self.next[state][c] = into
                    self._fold(into, blue)
            # folding can give an earlier state new ways on
            fresh = next((i for i, r in enumerate(red[: at + 1]) if any(t not in red for t in self.next[r].values())), None)
            at = fresh if fresh is not None else at + 1
        name = {r: i for i, r in enumerate(red)}  # what was folded goes, so workers get the states that are left only
        self.next = [{c: name[t] for c, t in self.next[r].items()} for r in red]
        self.seen, self.ends, self.total = ([x[r] for r in red] for x in (self.seen, self.ends, self.total))
        self.states = len(red)

    def likelihood(self, word: str) -> float:
        """The mean base-2 log-probability of the symbols and of the end."""
        state, total = 0, 0.0
        for c in word:
            n = self.total[state] if state is not None else 0
            p = self.seen[state].get(c, 0) / n if n else 0
            total += math.log2(max(p, UNSEEN))
            state = self.next[state].get(c) if state is not None else None
        n = self.total[state] if state is not None else 0
        total += math.log2(max(self.ends[state] / n if n else 0, UNSEEN))
        return total / (len(word) + 1)


class Grammar:
    """The automata of the kinds that have examples, with the least likelihood of each, and those of ordinary tokens."""

    def __init__(self, examples: dict[int, list[str]], *ordinary: list[str]):
        self.kinds = []
        for _, values in sorted(examples.items()):
            automaton = Automaton([symbols(v) for v in values])
            scores = sorted(automaton.likelihood(symbols(v)) for v in values)
            self.kinds.append((automaton, scores[int(OUTLIERS * len(scores))]))
        self.ordinary = [Automaton([symbols(v) for v in x]) for x in ordinary if x]
        self.known: dict[str, bool] = {}

    def accepts(self, token: str) -> bool:
        word = symbols(token)
        said = self.known.get(word)
        if said is None:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            scores = [(a.likelihood(word), least) for a, least in self.kinds]
            said = any(x >= least for x, least in scores)
            if said:
                plain = max((a.likelihood(word) for a in self.ordinary), default=-math.inf)
                said = any(x >= max(least, plain) for x, least in scores)
            if len(word) <= REMEMBERED_CHARS:
                self.known[word] = said
        return said


def _least(tokens: set[str], n: int) -> list[str]:
    """The ``n`` tokens with the least hashes."""
    return heapq.nsmallest(n, tokens, key=_place)


def _place(token: str) -> tuple[int, str]:
    return xxhash.xxh3_64_intdigest(token.encode("utf-8", "surrogatepass")) >> 1, token


def infer(docs: DataFrame, examples: int = EXAMPLES, chars: int = EXAMPLE_CHARS) -> Grammar:
    """The grammar of what all texts hold: of the distinct values of each kind, and of the distinct ordinary tokens,
    shorter and longer ones, those of up to ``chars`` characters, the ``examples`` with the least hashes. Each batch
    hands on no more than as many."""
    schema = pa.schema([("kind", pa.int32()), ("place", pa.int64()), ("value", pa.string())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in source:
            seen: dict[int, set[str]] = defaultdict(set)
            for text in x.column(0).to_pylist():
                _, values, tokens = find(text)
                for kind, value in (*values, *((3 + (len(t) >= LONG_TOKEN), t) for _, _, t in tokens)):
                    if len(value) <= chars:
                        seen[kind].add(value)
                for kind, found in seen.items():
                    if len(found) > 20 * examples:
                        seen[kind] = set(_least(found, examples))
            yield from batches(((k, *_place(v)) for k, found in seen.items() for v in _least(found, examples)), schema)

    stash = Stash(docs.sparkSession, "secrets")
    found = stash.keep(docs.select(column(docs, "text", "string")).mapInArrow(run, "kind int, place long, value string"), "examples")
    held = [[r["value"] for r in found.filter(F.col("kind") == k).distinct().orderBy("place", "value").limit(examples).collect()] for k in range(5)]
    stash.drop("examples")
    labelled = {k: held[k] for k in range(3) if held[k]}
    return Grammar(labelled, *(held[3:] if labelled else []))


def secrets(docs: DataFrame, examples: int = EXAMPLES) -> DataFrame:
    """Per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_format.

    A span of kind assign is the whole match. Null and empty texts have no span; of very long texts and tokens
    every character counts, but the automata are inferred from values of up to ``EXAMPLE_CHARS``; null ids stay null; repeated rows get the same result; other columns are not read;
    an empty table gives none; without labelled credentials nothing is inferred and no span is added.
    """
    grammar = docs.sparkSession.sparkContext.broadcast(infer(docs, examples))
    names = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format")
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    schema = pa.schema(list(zip(names, kinds, strict=True)))

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accepts = grammar.value.accepts
        said = lambda spans: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)

        def rows() -> Iterator[tuple]:
            for x in short(source):
                for doc_id, text in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True):
                    base, _, tokens = find(text)
                    more = [(s, 3, e) for s, e, token in tokens if accepts(token)]
                    n = [sum(k == i for _, k, _ in base) for i in range(3)]
                    yield doc_id, *n, hashlib.sha256(said(base).encode()).hexdigest(), said(sorted(base + more)), len(more)

        yield from batches(rows(), schema)

    kind = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_format long"
    return docs.select(column(docs, "doc_id", "long"), column(docs, "text", "string")).mapInArrow(run, kind)
