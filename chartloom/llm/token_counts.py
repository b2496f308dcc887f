"""Token counts of a unigram tokenizer without its tokens: Aho-Corasick matches and count-only Viterbi.

The automaton enumerates every vocabulary piece in a word by its end, the longest first, which is the
order of their starts. For each end the dynamic programme keeps the best score and the number of pieces
on the path to it; a later start replaces an earlier one only by a strictly better score, as in the
``tokenizers`` library, so ties give the same counts. Characters that no piece covers score ten less
than the worst piece and count as their bytes where the vocabulary has all bytes, else as one a run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, column, short

#: What stands for the space before a word, and what an unknown character scores less than the worst piece.
SPACE, PENALTY = "▁", 10.0
#: Words whose counts a worker remembers; a matter of speed only.
REMEMBERED = 500_000

_CONTROL = re.compile("[\x1c-\x1f]")
_WORDS = re.compile("[^\t-\r \x85\xa0  -     　]+")


def words_of(text: str | None) -> list[str]:
    """What stands between Unicode white space; four control characters that ``split`` takes for it are not."""
    if not text:
        return []
    return _WORDS.findall(text) if _CONTROL.search(text) else text.split()


def vocabulary(path: str) -> list[tuple[str, float]]:
    """The pieces of a sentencepiece model and their scores, as unigrams."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Counts of words."""

    def __init__(self, pieces: list[tuple[str, float]], most: int = REMEMBERED):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        last = dict(pieces)
        for piece, score in last.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(s for _, s in pieces) - PENALTY
        self.bytes = all(f"<0x{b:02X}>" in last for b in range(256))
        self.known, self.most = {}, most

    def word(self, word: str) -> int:
        text = word if word.startswith(SPACE) else SPACE + word
        n = len(text)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        done = 0  # every end up to here has its best path
        single = False

        def close(end: int) -> None:
            """The unknown character that ends here, where no piece is just that character."""
            path = score[end - 1] + self.unknown
            if count[end] == 0 or path > score[end]:
                more = len(text[end - 1].encode("utf-8", "surrogatepass")) if self.bytes else int(not unknown[end - 1])
                score[end], count[end], unknown[end] = path, count[end - 1] + more, True

        for last, (length, value) in self.automaton.iter(text):
            end = last + 1
            while done + 1 < end:  # ends that are behind us
                done += 1
                if not single:
                    close(done)
                single = False
            start = end - length
            path = score[start] + value
            if count[end] == 0 or path > score[end]:
                score[end], count[end], unknown[end] = path, count[start] + 1, False
            single = single or length == 1
        while done < n:
            done += 1
            if not single:
                close(done)
            single = False
        return count[n]

    def __call__(self, words: list[str]) -> int:
        known = self.known
        if len(known) > self.most:
            known.clear()
        try:
            return sum(map(known.__getitem__, words))
        except KeyError:
            for w in words:
                if w not in known:
                    known[w] = self.word(w)
            return sum(map(known.__getitem__, words))


def token_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_tokens.

    Null and empty texts have none; null ids stay null; repeated rows give repeated results; an empty
    table gives none. One pass, nothing is shuffled; other columns are not read.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary(vocabulary_path))

        def counted() -> Iterator[tuple]:
            for x in short(source):
                for doc_id, text in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True):
                    words = words_of(text)
                    yield doc_id, len(words), counter(words)

        yield from batches(counted(), schema)

    return docs.select(column(docs, "doc_id", "long"), column(docs, "text", "string")).mapInArrow(run, "doc_id long, n_words long, n_tokens long")


def source_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """Per source: documents, words and tokens; summed in each task before anything is shuffled."""
    schema = pa.schema([("source", pa.string()), ("n_words", pa.int64()), ("n_tokens", pa.int64())])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(vocabulary(vocabulary_path))
        rows = ((s, len(w), counter(w)) for x in short(source) for s, w in ((s, words_of(t)) for s, t in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True)))
        yield from batches(rows, schema)

    counted = docs.select(column(docs, "source", "string"), column(docs, "text", "string")).mapInArrow(run, "source string, n_words long, n_tokens long")
    return counted.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("n_words").alias("n_words"), F.sum("n_tokens").alias("n_tokens"))
