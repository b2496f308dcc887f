"""Collocations against counts of all phrases."""

import random
import re
from collections import Counter

import numpy as np

from chartloom.llm import collocations
from chartloom.llm.collocations import Bitmaps, Filter

COLUMNS = ("lang", "rank", "phrase", "a", "l", "r", "n", "score")
KIND = "doc_id long, text string, lang string, phrase string, f string, n string, rank string, salt string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def brute(rows, top=2000):
    f = {}
    for text, lang in rows:
        c = f.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            for m in range(1, 5):
                c.update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, c in f.items():
        n = sum(v for p, v in c.items() if len(p) == 1)
        some = {p: a for p, a in c.items() if len(p) > 1 and a >= 30}
        whole = Counter()
        for p, a in some.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    whole[p[i : i + m]] = max(whole[p[i : i + m]], a)
        rows_ = []
        for p, a in some.items():
            if 100 * whole[p] >= 80 * a:
                continue
            score, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(rows_)[:top], 1)]
    return sorted(out)


def corpus():
    draw = random.Random(9)
    words = ["the", "The", "of", "new", "york", "Über", "日本", "ice", "cream", "a", "b", "\xa0nbsp", "Ünder", "c"]
    texts = []
    for i in range(400):
        w = [draw.choice(words) for _ in range(draw.randint(0, 60))]
        for _ in range(draw.randint(0, 3)):
            w[draw.randint(0, len(w)) : 0] = ["kingdom", "of", "heaven", "now"]
        texts.append("".join(x + draw.choice([" ", " ", " ", "\t", ", ", "\n", "  ", ".", " ?"]) for x in w))
    rows = [(t, draw.choice(["en", "de", None, "und"])) for t in texts]
    return [*rows, *rows[:20], (None, "en"), ("", "fr"), ("rare words", "fr"), ("x" * 500_000, "en"), ("go on " * 100_000, "long")]


def found(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_phrases(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, x, "a", "b", "c", "d", "e") for i, (t, x) in enumerate(rows)], KIND).repartition(3)
    want = brute(rows)
    assert len(want) >= 40 and {r[0] for r in want} == {"en", "de", "und", "long"}
    assert found(collocations.collocations(docs)) == want
    assert found(collocations.collocations(docs, top=3)) == brute(rows, 3)
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert collocations.collocations(spark.createDataFrame([(1, "... !", None, "", "", "", "", "")], KIND)).count() == 0


def test_bitmaps_and_blocks():
    draw = np.random.default_rng(1)
    at = np.concatenate([draw.choice(200, 5000), [0]])
    b = Bitmaps(at, 200)
    words = np.array([1, 7, 3, 199])
    assert b.of(words).tolist() == [i for w in words for i in np.flatnonzero(at == w)]
    assert b.size(words).tolist() == [int((at == w).sum()) for w in words]
    sizes = draw.integers(1, 50, 300)
    cut = collocations.blocks(sizes, 100)
    assert np.concatenate([sizes[x] for x in cut]).tolist() == sizes.tolist() and max(sizes[x].sum() for x in cut) <= 150
    assert collocations.blocks(np.empty(0, int)) == []


def test_filter_and_packed_hashes():
    draw = np.random.default_rng(2)
    keys = draw.integers(0, 2**63, 1000).astype(np.uint64) * np.uint64(2)
    batch = collocations.packed(np.concatenate([keys, keys[:500], *[keys[:10]] * 40]))
    back = np.concatenate([np.frombuffer(x, np.uint64) for x in batch.column("keys").to_pylist()])
    n = np.concatenate([np.frombuffer(x, np.uint8) for x in batch.column("counts").to_pylist()])
    assert back.tolist() == sorted(set(keys.tolist())) and sorted(back[n == 30].tolist()) == sorted(keys[:10].tolist())
    assert all(b == k >> 48 for b, ks in zip(batch.column("bucket").to_pylist(), batch.column("keys").to_pylist(), strict=True) for k in np.frombuffer(ks, np.uint64).tolist())
    bits = np.zeros(1 << 10, np.uint8)
    for k in keys.tolist():
        for at in (k & 8191, k >> 32 & 8191):
            bits[at >> 3] |= 1 << (at & 7)
    assert Filter(bits)(keys).all()
