"""What the operators must not leave out: cases that bounds on support, length or ids once dropped."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers

from chartloom.llm import common, language_id, near_duplicates, pii, secrets

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_terms_of_rare_entities(spark, monkeypatch):
    """Entities of one, two and more documents against brute force, whatever the filter of terms lets through."""
    draw = random.Random(30)
    words = [f"word{i}" for i in range(60)]
    mails = [f"m{i}@mail.example.com" for i in range(12)]
    texts = [" ".join([*draw.sample(words, 6), f"only{i}", *(f"nick{m[:-17]} {m}" for m in (draw.sample(mails, draw.choice([1, 1, 2])) if i % 8 == 0 else []))]) for i in range(120)]
    texts += [texts[8], "first@solo.example.com second@solo.example.com Quirin said hello word1"]
    docs = [*enumerate(texts), (0, texts[0])]
    mail = re.compile(r"\S+@\S+")
    holds = [(set(mail.findall(t)), set(re.findall(r"\w+", mail.sub(" ", t.lower()))), t) for _, t in docs]
    n_entity, n_term, n_both = Counter(), Counter(), defaultdict(int)
    for entities, terms, _ in holds:
        n_entity.update(entities)
        n_term.update(set(re.findall(r"[a-z0-9]+", _.lower())))
        for e in entities:
            for t in terms:
                n_both[e, t] += 1
    p = {e: n / len(docs) for e, n in n_entity.items()}
    share = {(e, t): math.log2((n + p[e]) / (n_term[t] + 1) / p[e]) / -math.log2(p[e]) for (e, t), n in n_both.items()}
    risky = {k for k, v in share.items() if v >= 0.8}
    assert {1, 2} <= {n_entity[e] for e, _ in risky}
    expected = sorted((i, sum(any((e, t) in risky for e in entities) for t in re.findall(r"\w+", mail.sub(" ", text.lower())))) for (i, _), (entities, _, text) in zip(docs, holds, strict=True))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for bits in (1 << 25, 1 << 15):  # a full filter lets more through and changes nothing
        monkeypatch.setattr(common, "FILTER_BITS", bits)
        found = pii.personal_data(df).collect()
        assert sorted((r["doc_id"], r["n_term"]) for r in found) == expected
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(df).collect()}
    assert clean[121] == "[EMAIL] [EMAIL] [TERM] [TERM] [TERM] word1"


def test_long_words_are_learned_as_short_ones(monkeypatch):
    """The scaled sums give the probabilities of the plain ones, in blocks of any size."""
    draw = random.Random(31)
    pieces = {p: i for i, p in enumerate([b" ", b"a", b"b", b"ab", b" a", b"ba", b"abab", b"b" * 16], 1)}
    words = ["".join(draw.choice("ab") for _ in range(draw.randint(1, 23))).encode() for _ in range(200)] + [b"b" * 22]
    counts = {w: np.array([draw.randint(0, 3), draw.randint(0, 3)], float) for w in words}
    learned = []
    for short, cells in ((24, 800_000), (1, 800_000), (1, 100), (9, 500)):
        monkeypatch.setattr(language_id, "SHORT", short)
        monkeypatch.setattr(language_id, "CELLS", cells)
        model = language_id.Unigrams(pieces, ["x", "y"])
        model.learn(counts)
        learned.append(model.p)
    assert all(np.allclose(learned[0], p, rtol=1e-9, atol=0) for p in learned[1:])
    model = language_id.Unigrams(pieces, ["x", "y"])
    model.learn({b"ab" * 3000: np.array([1.0, 0.0])})  # no underflow
    assert np.isfinite(model.p).all() and model.p[pieces[b"abab"], 0] > 0.5


def test_languages_without_spaces(spark):
    """Clauses of many characters are one word each; digits and a Latin word are in every text."""
    draw = random.Random(32)
    letters = {"en": ["the", "thing", "with"], "ja": "のはがをにでとたしてるます日本語", "th": "กขคงจชซดตนบปมยรลวสหอะาิีเแ", "zh": "的一是不了在人有我他这中大来上国日本"}
    clause = lambda k: " ".join(draw.choice(letters[k]) for _ in range(9)) if k == "en" else "".join(draw.choice(letters[k]) for _ in range(draw.randint(9, 40)))
    docs = [(i, f"{clause(k)} {draw.randint(1, 99)} ok {clause(k)}", k) for i in range(400) for k in [draw.choice(list(letters))]]
    found = language_id.language_report(spark.createDataFrame(docs, "doc_id long, text string, lang string"), RANKS).filter("held_out").collect()
    right = Counter(docs[r["doc_id"]][2] for r in found if r["lang_pred"] == docs[r["doc_id"]][2])
    held = Counter(docs[r["doc_id"]][2] for r in found)
    assert len(held) == 4 and all(right[k] >= 0.95 * held[k] for k in held)


def test_the_language_sample_is_the_one_before_the_speed_up():
    assert language_id.TRAIN_DOCS >= 1000


def test_whole_tokens_are_scored():
    """A token is not judged by its first characters, however long it is."""
    draw = random.Random(33)
    some = lambda letters, n: "".join(draw.choice(letters) for _ in range(n))
    key = lambda n: some("ABCDEF0123456789", n)
    grammar = secrets.Grammar({0: [key(draw.randint(60, 300)) for _ in range(200)]}, [some("ghijklmnopqrstuvw/", draw.randint(20, 300)) for _ in range(200)])
    assert all(grammar.accepts(key(n)) for n in (100, 200, 290))
    assert not any(grammar.accepts(key(90) + some("ghijklmnopqrstuvw/", n)) for n in (200, 1000, 5000))
    paths = secrets.Grammar({0: ["/srv/" + "abc/" * 20 + key(200) for _ in range(200)]}, [some("/abc", draw.randint(20, 300)) for _ in range(200)])
    automaton = paths.kinds[0][0]
    word = secrets.symbols("/srv/" + "abc/" * 20 + key(200))
    assert len(word) == 285 and automaton.likelihood(word) != automaton.likelihood(word[:85])


def shingle_set(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(zip(*(w[i:] for i in range(k)), strict=False)) if len(w) >= k else frozenset([tuple(w)]) if w else frozenset()


def one_of_each(rows, k):
    """(doc_id, set) of the rows that stay, by brute force over the distinct sets."""
    low, part = {}, {}
    for i, t in rows:
        s = shingle_set(t, k)
        if s:
            part[s] = s
            low[s] = min((x for x in (low.get(s), i) if x is not None), default=None)

    def root(s):
        while part[s] != s:
            s = part[s]
        return s

    named = [s for s in part if low[s] is not None]
    for a in named:
        for b in named:
            if 100 * len(a & b) >= 80 * len(a | b):
                part[root(a)] = root(b)
    group = defaultdict(list)
    for s in part:
        group[root(s)].append(s)
    stay = [(min((low[s] for s in g if low[s] is not None), default=None), frozenset(g)) for g in group.values()]
    bare = [(i, t) for i, t in rows if not shingle_set(t, k)]
    return stay, len({x for x in bare if x[0] is not None}) + sum(i is None for i, _ in bare)


def test_one_row_of_each_group_stays(spark, odd, rows):
    """Repeated rows, rows without id, and ids with several texts."""
    words = [f"t{i}" for i in range(60)]
    text, near, other = " ".join(words), " ".join([*words[:-1], "x"]), " ".join(f"o{i}" for i in range(30))
    far = " ".join([*words[:-1], "x", "y", *(f"z{i}" for i in range(10))])
    more = [(1, text), (1, text), (2, near), (2, other), (None, other), (None, "no id here"), (None, "no id here"), (None, "No id  here"), (4, ""), (4, ""), (4, None), (None, ""), (None, "")]
    more += [(7, "a text of the id"), (7, "another one of it"), (7, "A  text of the id"), (2, far), (8, far), (9, far + " end")]
    for k in (2, 5):
        for df, have in ((odd, [(i, t) for i, t, _ in rows]), (spark.createDataFrame(more, "doc_id long, text string"), more)):
            found = near_duplicates.drop_near_duplicates(df, k)
            assert found.columns == df.columns
            kept = [(r["doc_id"], r["text"]) for r in found.collect()]
            stay, bare = one_of_each(have, k)
            assert not Counter(kept) - Counter(have) and sum(not shingle_set(t, k) for _, t in kept) == bare
            assert len(kept) == len(stay) + bare
            assert all(sum(i == low and shingle_set(t, k) in group for i, t in kept) == 1 for low, group in stay)


def test_a_long_text_of_numbers(spark):
    """A megabyte of numbers, most of them addresses, is placed in a time that does not grow with its square."""
    import time

    draw = random.Random(12)
    text = " ".join(f"{draw.randint(0, 400)}.{draw.randint(0, 255)}.{draw.randint(0, 255)}.{draw.randint(0, 255)} {draw.randint(0, 9)} word" for _ in range(48_000))
    assert len(text) > 1_000_000
    want = [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    pii.base_spans(df.limit(0)).collect()
    began = time.time()
    spans = pii.base_spans(df).first()["base"]
    assert [(s["start"], s["kind"], s["end"]) for s in spans if s["kind"] == 1] == want
    terms = pii._terms(pii.base_spans(df)).groupBy("term").count().collect()
    assert {r["term"]: r["count"] for r in terms}["word"] == 48_000
    assert time.time() - began < 40
