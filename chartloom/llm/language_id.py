"""Language of a text by unigrams over pieces, summed over all segmentations.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is the
sum over all ways to cut it into pieces, computed by the forward algorithm; a text's is the product of
its words'. The probabilities are learned by expectation maximisation from labelled documents.
"""

from __future__ import annotations

import base64
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Stash, batches, column, short

#: Labelled documents that a language is learned from, on average; they are chosen by a hash of the doc_id.
TRAIN_DOCS = 1000
#: Least length in bytes of a word whose sums are scaled.
SHORT = 24
#: Largest exponent in the scaled sums.
HIGHEST = 650.0
#: Bytes of scaled words that are learned from at a time, times languages; a matter of memory only.
CELLS = 400_000
ROUNDS = 3
#: Of a piece's probability this part comes from the vocabulary as a whole, so that none is impossible.
SMOOTHED = 0.01
#: Words whose scores a worker remembers; a matter of speed only.
REMEMBERED = 300_000


def vocabulary(path: str) -> dict[bytes, int]:
    """Pieces of a file of base64 pieces and ranks, numbered from 1: those that can stand in a word after one space."""
    lines = [base64.b64decode(x.split()[0]) for x in open(path, "rb") if x.strip()]
    fit = [p for p in lines if len((p[1:] if p[:1] == b" " else p).split()) == (p != b" ") and not p[1:2].isspace()]
    return {p: i for i, p in enumerate(dict.fromkeys([*fit, *(bytes([b]) for b in range(256))]), 1)}


class Unigrams:
    """log_p[piece, language]; piece 0 is none."""

    def __init__(self, pieces: dict[bytes, int], languages: list[str], p: np.ndarray | None = None):
        self.pieces, self.languages = pieces, languages
        self.sizes = sorted(set(map(len, pieces)))  # few, so only these lengths are looked up
        self.p = np.full((len(pieces) + 1, len(languages)), 1 / len(pieces)) if p is None else p
        self.p[0] = 0

    def _ids(self, words: list[bytes], n: int) -> dict[tuple[int, int], np.ndarray]:
        get = self.pieces.get
        return {(i, j): np.array([get(w[i:j], 0) for w in words]) for j in range(1, n + 1) for i in [j - k for k in reversed(self.sizes) if k <= j]}

    def _forward(self, ids: dict[tuple[int, int], np.ndarray], n: int, count: int) -> np.ndarray:
        alpha = np.zeros((n + 1, count, len(self.languages)))
        alpha[0] = 1
        for (i, j), x in ids.items():
            on = np.flatnonzero(x)
            alpha[j, on] += alpha[i, on] * self.p[x[on]]
        return alpha

    def scores(self, words: list[bytes]) -> np.ndarray:
        """The log-probability of each word in each language."""
        out = np.empty((len(words), len(self.languages)))
        by = defaultdict(list)
        for k, w in enumerate(words):
            by[len(w) if len(w) < SHORT else 0].append(k)
        for n, where in by.items():
            if n:
                mine = [b" " + words[k] for k in where]
                out[where] = np.log(self._forward(self._ids(mine, n + 1), n + 1, len(mine))[n + 1])
            else:
                for k in where:
                    out[k] = self._long(b" " + words[k])
        return out

    def _long(self, word: bytes) -> np.ndarray:
        alpha, scale, reach, get = np.zeros((len(word) + 1, len(self.languages))), np.zeros(len(self.languages)), self.sizes[-1], self.pieces.get
        alpha[0] = 1
        for j in range(1, len(word) + 1):
            for k in self.sizes:
                if k > j:
                    break
                x = get(word[j - k : j])
                if x:
                    alpha[j] += alpha[j - k] * self.p[x]
            if j % 16 == 0:
                by = alpha[j].copy()
                with np.errstate(over="ignore"):  # only of sums that no piece reaches back to
                    alpha[max(0, j - reach) : j + 1] /= by
                scale += np.log(by)
        return np.log(alpha[-1]) + scale

    def learn(self, counts: dict[bytes, np.ndarray], rounds: int = ROUNDS) -> None:
        """Expectation maximisation: in each round the expected use of each piece over all segmentations."""
        by, long = defaultdict(list), []
        for w in counts:
            if len(w) < SHORT:
                by[len(w) + 1].append(w)
            else:
                long.append(w)
        blocks = []  # the matches are the same in every round
        for n, all_ in by.items():
            for at in range(0, len(all_), 20_000):
                words = all_[at : at + 20_000]
                found = self._ids([b" " + w for w in words], n)
                matches = {}
                for place, x in found.items():
                    on = np.flatnonzero(x)
                    if len(on):
                        matches[place] = on.astype(np.int32), x[on].astype(np.int32)
                blocks.append((n, np.array([counts[w] for w in words]), matches))
        scaled = [self._matched(words, counts) for words in self._shared_out(long)]
        for _ in range(rounds):
            used = np.zeros_like(self.p)
            for n, weight, matches in blocks:
                alpha = np.zeros((n + 1, len(weight), len(self.languages)))
                alpha[0] = 1
                for (i, j), (on, x) in matches.items():
                    alpha[j, on] += alpha[i, on] * self.p[x]
                beta = np.zeros_like(alpha)
                beta[n] = weight / alpha[n]
                for (i, j), (on, x) in reversed(matches.items()):
                    through = self.p[x] * beta[j, on]
                    beta[i, on] += through
                    np.add.at(used, x, alpha[i, on] * through)
            for block in scaled:
                self._use(used, *block)
            whole = used.sum(axis=1, keepdims=True) + 1
            whole[0] = 0
            self.p = (1 - SMOOTHED) * used / np.maximum(used.sum(axis=0), 1e-9) + SMOOTHED * whole / whole.sum()
            self.p[0] = 0

    def _shared_out(self, words: list[bytes]) -> Iterator[list[bytes]]:
        """The words in blocks of like lengths, the longest first."""
        held: list[bytes] = []
        for w in sorted(words, key=lambda w: (-len(w), w)):
            if held and (len(held) + 1) * (len(held[0]) + 1) * len(self.languages) > CELLS:
                yield held
                held = []
            held.append(w)
        if held:
            yield held

    def _matched(self, words: list[bytes], counts: dict[bytes, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Lengths and counts of the words, and places and numbers of their pieces; a place is (end, which size, word)."""
        get, places, found = self.pieces.get, [], []
        for r, word in enumerate(words):
            w = b" " + word
            for j in range(1, len(w) + 1):
                for s, k in enumerate(self.sizes):
                    if k > j:
                        break
                    x = get(w[j - k : j])
                    if x:
                        places.append((j * len(self.sizes) + s) * len(words) + r)
                        found.append(x)
        return np.array([len(w) + 1 for w in words]), np.array([counts[w] for w in words]), np.array(places, np.int64), np.array(found, np.int32)

    def _use(self, used: np.ndarray, lengths: np.ndarray, weight: np.ndarray, places: np.ndarray, found: np.ndarray) -> None:
        """Adds the expected use of each piece in words of any length; the sums are held as logarithms. Where no
        piece of a size ends or begins, its number is 0, whose probability is 0."""
        n, count, size = int(lengths[0]), len(lengths), np.array(self.sizes)
        x = np.zeros((n + 1, len(size), count), np.int32)
        x.ravel()[places] = found
        open_ = [int(np.count_nonzero(lengths >= j)) for j in range(n + 2)]  # words that reach position j come first
        alpha = np.full((n + 1, count, len(self.languages)), -np.inf)
        alpha[0] = 0
        for j in range(1, n + 1):
            a = open_[j]
            last = alpha[j - 1, :a]
            before = np.exp(np.minimum(alpha[np.maximum(j - size, 0), :a] - last, HIGHEST))
            alpha[j, :a] = last + np.log((before * self.p[x[j, :, :a]]).sum(axis=0))
        beta = np.full((n + 1, count, len(self.languages)), -np.inf)
        beta[lengths, np.arange(count)] = 0
        whole, which = alpha[lengths, np.arange(count)], np.arange(len(size))
        for i in range(n - 1, -1, -1):
            a = open_[i + 1]
            end = np.where(i + size <= n, i + size, 0)  # nothing ends at 0
            from_i, next_ = x[end, which, :a], beta[i + 1, :a]
            through = np.exp(np.minimum(beta[end, :a] - next_, HIGHEST)) * self.p[from_i]
            beta[i, :a] = next_ + np.log(through.sum(axis=0))
            through *= weight[:a] * np.exp(alpha[i, :a] + next_ - whole[:a])
            on = from_i > 0
            np.add.at(used, from_i[on], through[on])


def fit(labelled: DataFrame, pieces: dict[bytes, int], train_docs: int = TRAIN_DOCS) -> Unigrams | None:
    """Learns from (doc_id, text, lang), on average from ``train_docs`` rows of a language; None without any."""
    rows = labelled.filter("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    if not sizes:
        return None
    languages = sorted(sizes)
    share = F.create_map(*[F.lit(x) for k in languages for x in (k, min(1.0, train_docs / sizes[k]))])
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("language-id")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = rows.filter(drawn < share[F.col("lang")]).select("lang", "text")
    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in short(source):
            seen: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True):
                seen[lang].update(text.encode("utf-8", "surrogatepass").split())
            yield from batches(((k, w, n) for k, c in seen.items() for w, n in c.items()), schema, 20_000)

    counted = rows.mapInArrow(run, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    place = {k: i for i, k in enumerate(languages)}
    counts: dict[bytes, np.ndarray] = defaultdict(lambda: np.zeros(len(languages)))
    table = Stash(labelled.sparkSession, "language-words").keep(counted, "words").toArrow()  # the words of a bounded sample
    for lang, word, n in zip(*(c.to_pylist() for c in table.columns), strict=True):
        counts[word][place[lang]] += n
    model = Unigrams(pieces, languages)
    model.learn(counts)
    return model


def predict(docs: DataFrame, model: Unigrams | None, *keep: Column) -> DataFrame:
    """``keep`` of each row with lang_pred and score, the posterior over the learned languages at equal priors.

    Null texts and texts without a letter are ``und`` with a score of 0, as are all where nothing was learned.
    """
    rows = docs.select(column(docs, "text", "string"), *keep)
    held = docs.sparkSession.sparkContext.broadcast((model.pieces, model.languages, model.p.astype(np.float32)) if model else None)
    extra = rows.drop("text").schema

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Unigrams(held.value[0], held.value[1], held.value[2].astype(np.float64)) if held.value else None
        known: dict[bytes, int] = {}
        table = none = np.empty((0, len(model.languages) if model else 0), np.float32)
        for x in short(source):
            texts = x.column(0).to_pylist()
            lettered = [bool(model and t and any(map(str.isalpha, t))) for t in texts]
            split = [t.encode("utf-8", "surrogatepass").split() if on else [] for t, on in zip(texts, lettered, strict=True)]
            if model:
                if len(known) > REMEMBERED:
                    known, table = {}, none
                new = list({w for words in split for w in words if w not in known})
                if new:
                    found = model.scores(new).astype(np.float32)
                    table = _grown(table, len(known), found)
                    known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
            names, scores = [], []
            for words, on in zip(split, lettered, strict=True):
                if not on:
                    names.append("und")
                    scores.append(0.0)
                    continue
                total = table[np.fromiter(map(known.__getitem__, words), np.int64, len(words))].sum(axis=0, dtype=np.float64)
                best = int(total.argmax())
                names.append(model.languages[best])
                scores.append(1 / float(np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([*x.columns[1:], pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=[*x.schema.names[1:], "lang_pred", "score"])

    kind = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in extra), "lang_pred string, score double"])
    return rows.mapInArrow(run, kind)


def _grown(table: np.ndarray, used: int, more: np.ndarray) -> np.ndarray:
    """``more`` after the first ``used`` rows, in a table that doubles when it is full."""
    if used + len(more) > len(table):
        wider = np.empty((max(2 * len(table), used + len(more)), more.shape[1]), np.float32)
        wider[:used] = table[:used]
        table = wider
    table[used : used + len(more)] = more
    return table


def language_report(docs: DataFrame, vocabulary_path: str, **options) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score; learned where crc32 of the doc_id modulo 4 is not 2.

    A row without ``doc_id`` is not held out and nothing is learned from it; only the text is an input of a
    prediction, from a very long one too the whole; of languages that are equally likely the first by name is
    predicted; repeated rows get the same result; other columns are not read; an empty table gives none.
    """
    rest = F.pmod(F.crc32(column(docs, "doc_id", "string")), F.lit(4))
    labelled = docs.select(column(docs, "doc_id", "long"), column(docs, "text", "string"), column(docs, "lang", "string")).filter(rest != 2)
    model = fit(labelled, vocabulary(vocabulary_path), **options)
    held_out = F.coalesce(rest == 2, F.lit(False)).alias("held_out")
    return predict(docs, model, column(docs, "doc_id", "long"), held_out)
