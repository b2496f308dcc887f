"""Line-first quality rules, in DataFrame expressions only.

Every line is judged by itself (punctuation, navigation, boilerplate), lines that fail are removed, and
a document that loses too much of its text is rejected; so is one that is too short or repeats itself.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, column, packed, unpacked

#: A document may lose this share of its words' characters with its lines, in hundredths.
MOST_LOST = 40
LEAST_WORDS = 10
#: Words in windows found twice or more, in hundredths of all words.
MOST_REPEATED = 20
WINDOW = 5

_SPACE = r"[\x20\x09-\x0D]"
_SYMBOLS = r"[#*$%&|<>]"

# What lines are judged by.
#: A line of at least this many words has a sentence's end somewhere, or goes on in the next line.
SENTENCE_WORDS = 8
ENDED = r"[.!?:;…।۔؟]['\"”’»)\]]*(?:[\x20\x09-\x0D]|\z)|[。！？]"
GOES_ON = r"^[\x20\x09-\x0D]*\p{Ll}"
#: Symbols in a line, in hundredths of its characters.
MOST_SYMBOLS = 10
#: Runs of exclamation or question marks in a line, in hundredths of its words, in lines of three words and more.
SHOUTED = r"[!?]{2,}"
MOST_SHOUTED = 30
#: Marks between menu entries; a line with three of them is navigation.
SEPARATED = r"[\x20\x09][|»›•·>][\x20\x09]"
LEAST_SEPARATORS = 3
#: Whole short lines that are navigation, and how short they are.
SHORT_LINE = 80
NAVIGATION = r"(?i)^[\x20\x09-\x0D]*(home|menu|search|log ?in|sign ?(in|up)|next( page)?|previous( page)?|back to top|read more|share( this)?|skip to content|site ?map|contact( us)?|about( us)?)[.:>» ]*[\x20\x09-\x0D]*$"
#: Notices that belong to a page, not to its text, and what a text with one of them has in lower case.
NOTICES = ("rights reserved", "terms of", "policy", "cookies", "javascript", "lorem ipsum", "newsletter", "click here", "powered by")
BOILERPLATE = r"(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie policy|(uses?|accept( all)?) cookies|enable javascript|javascript is (disabled|required)|lorem ipsum|subscribe to (our|the) newsletter|click here to|powered by [a-z]+$)"


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def words_of(text: Column) -> Column:
    """The words of a text; none of a null text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE + "+"))


def rare_marks(text: Column, n_symbols: Column) -> Column:
    """Which rules a text needs at all, by bits: symbols, runs of marks, separators, notices."""
    noticed = reduce(or_, [F.contains(F.lower(text), F.lit(x)) for x in NOTICES])
    marks = (n_symbols > 0, text.rlike(SHOUTED), text.rlike(SEPARATED), noticed)
    return reduce(add, [F.when(m, 1 << k).otherwise(0) for k, m in enumerate(marks)])


def marked_lines(text: Column, marks: Column) -> Column:
    """(line, full, bad) of each line: whether it has a word, and whether it is to go; lines without a word
    stay, as they carry no text. ``marks`` are the text's ``rare_marks``."""
    has = lambda k: marks.bitwiseAND(1 << k) > 0

    def bad(x: Column, n: Column, after: Column) -> Column:
        open_ = (n >= SENTENCE_WORDS) & ~x.rlike(ENDED) & ~F.coalesce(after.rlike(GOES_ON), F.lit(False))
        symbols = has(0) & (100 * _count(x, _SYMBOLS) > MOST_SYMBOLS * F.length(x))
        shouted = has(1) & (n >= 3) & (100 * _count(x, SHOUTED) > MOST_SHOUTED * n)
        navigation = (has(2) & (_count(x, SEPARATED) >= LEAST_SEPARATORS)) | ((F.length(x) <= SHORT_LINE) & x.rlike(NAVIGATION))
        return (n > 0) & (open_ | symbols | shouted | navigation | (has(3) & x.rlike(BOILERPLATE)))

    counted = F.transform(F.split(text, "\n"), lambda x: F.struct(x.alias("line"), _count(x, WORD).alias("n")))
    marked = lambda d: F.transform(d, lambda x, i: F.struct(x["line"].alias("line"), (x["n"] > 0).alias("full"), bad(x["line"], x["n"], F.get(d, i + 1)["line"]).alias("bad")))
    return F.element_at(F.transform(F.array(counted), marked), 1)


def window_hashes(hashes: Column) -> Column:
    """A hash of every run of ``WINDOW`` words, whose hashes are given as a column."""
    n = F.size(hashes) - WINDOW + 1
    made = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]))
    return F.when(n > 0, made).otherwise(F.array().cast("array<bigint>"))


def measures(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct ``q`` of the measures, and ``q_lines``, every line and whether it is to go."""
    held = docs.withColumn("q_text", F.coalesce(column(docs, "text", "string"), F.lit("")))
    held = held.withColumn("q_words", words_of(F.col("q_text"))).withColumn("q_symbols", _count(F.col("q_text"), _SYMBOLS))
    held = held.withColumn("q_marks", rare_marks(F.col("q_text"), F.col("q_symbols")))
    held = held.withColumn("q_lines", marked_lines(F.col("q_text"), F.col("q_marks"))).drop("q_marks")
    held = held.withColumn("q_hashes", F.transform("q_words", lambda w: F.xxhash64(w)))
    held = held.withColumn("q_windows", window_hashes(F.col("q_hashes"))).drop("q_hashes")
    # Equal windows stand side by side once sorted, which only documents with a repeated window need. The
    # marked starts, in order, cover WINDOW words each, or as many as there are up to the next.
    pairs = F.array_sort(F.transform("q_windows", lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
    sorted_ = F.when(F.size(F.array_distinct("q_windows")) < F.size("q_windows"), pairs)
    held = held.withColumn("q_sorted", sorted_).drop("q_windows")
    at = lambda i: F.get(F.col("q_sorted"), i)["g"]
    marked = F.filter(F.col("q_sorted"), lambda x, j: F.coalesce(x["g"] == at(j - 1), F.lit(False)) | F.coalesce(x["g"] == at(j + 1), F.lit(False)))
    held = held.withColumn("q_starts", F.array_sort(F.transform(marked, lambda x: x["i"]))).drop("q_sorted")
    steps = F.transform("q_starts", lambda x, j: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("q_starts"), j + 1) - x, F.lit(WINDOW))))
    n_repeat = F.coalesce(F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0))
    of = lambda c: F.transform(F.filter("q_lines", lambda x: x[c]), lambda x: x["line"])
    held = held.withColumn("q_full", of("full")).withColumn("q_bad", of("bad"))
    q = F.struct(
        F.size("q_words").cast("long").alias("n_words"),
        F.length(F.array_join("q_words", "")).cast("long").alias("word_chars"),
        F.col("q_symbols").cast("long").alias("n_symbols"),
        (F.size("q_full") - F.size(F.array_distinct("q_full"))).cast("long").alias("n_dup_lines"),
        n_repeat.cast("long").alias("n_repeat_words"),
        F.size("q_bad").cast("long").alias("n_bad_lines"),
        F.length(F.regexp_replace(F.array_join("q_bad", ""), _SPACE + "+", "")).cast("long").alias("lost_chars"),
    )
    held = held.withColumn("q", q).drop("q_words", "q_full", "q_starts")
    return held


def _verdict(q: Column) -> tuple[Column, Column]:
    failed = (q["n_words"] < LEAST_WORDS) | (100 * q["n_repeat_words"] > MOST_REPEATED * q["n_words"])
    return failed, ~failed & (100 * q["lost_chars"] <= MOST_LOST * q["word_chars"])


def quality_rules(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, the measures, base_failed and kept.

    A null or empty text has no words and fails; a null ``doc_id`` stays null; repeated rows give repeated
    results; an empty table gives none. Other columns are not read.
    """
    held = measures(docs.select(column(docs, "doc_id", "long"), column(docs, "text", "string")))
    failed, kept = _verdict(F.col("q"))
    return held.select("doc_id", *[F.col("q")[k].alias(k) for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], failed.alias("base_failed"), kept.alias("kept"), *[F.col("q")[k].alias(k) for k in ("n_bad_lines", "lost_chars")])


def clean(docs: DataFrame) -> DataFrame:
    """The rows that are kept, without the lines that failed; all columns stay, ``n_chars`` follows the text."""
    # the row number keeps the filter above the measures; pushed below, it would repeat them for each use
    held = measures(packed(docs, text="string")).withColumn("q_row", F.monotonically_increasing_id())
    kept = held.filter(_verdict(F.col("q"))[1] & (F.col("q_row") >= 0))
    text = F.when(F.col("q")["n_bad_lines"] == 0, F.col("text")).otherwise(F.array_join(F.transform(F.filter("q_lines", lambda x: ~x["bad"]), lambda x: x["line"]), "\n"))
    kept = kept.withColumn("text", text)
    chars = {"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {}
    return unpacked(kept, docs.columns, text=F.col("text"), **chars)
