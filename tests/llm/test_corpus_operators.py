"""The corpus operators on odd rows, held against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from chartloom.llm import decontamination, language_id, mixing, near_duplicates, pii, quality, repeated_passages, secrets, token_blocks, token_counts
from chartloom.llm.common import WordHashes, windows

BPE, RANKS, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))
SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def got(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def ordered(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize(("planes", "chunk"), [("byte", 64), ("bit", 100), ("byte", 65536)])
def test_token_blocks(spark, odd, rows, empty, tmp_path, planes, chunk):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    path = str(tmp_path / "chunks")
    token_blocks.write_blocks(odd, path, BPE, chunk_ids=chunk, planes=planes)
    found = token_blocks.read_documents(spark, path, planes, chunk).collect()
    ids = [(i, [*t.encode(x or "", add_special_tokens=False).ids, 2]) for i, x, _ in rows]
    assert ordered((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in found) == ordered((i, len(v), zlib.crc32(np.array(v, "<u4").tobytes())) for i, v in ids)
    at, last = 0, -1
    for r in sorted(found, key=lambda r: r["start"]):  # without gaps, in the order of the ids
        assert r["start"] == at and (r["doc_id"] if r["doc_id"] is not None else -1) >= last
        at, last = at + r["n_tokens"], r["doc_id"] if r["doc_id"] is not None else -1
    index = token_blocks.read_index(spark, path).collect()
    assert sum(r["n_ids"] for r in index) == at and max(r["n_ids"] for r in index) <= chunk
    assert token_blocks.token_blocks(empty, BPE).count() == 0


def test_encoder_is_the_tokenizer():
    from tokenizers import Tokenizer

    t, e, draw = Tokenizer.from_file(BPE), token_blocks.Encoder(BPE), random.Random(1)
    t.encode_special_tokens = True
    for _ in range(3000):
        s = "".join(draw.choice(["a", "the", "Ab", "1", "23", ".", ",", "'s", " ", "  ", "\n", "\n\n", "\t", " ", "é", "日", "<|endoftext|>", "\0", "-"]) for _ in range(draw.randint(0, 12)))
        assert b"".join(next(iter(e([s])))) == np.array(t.encode(s, add_special_tokens=False).ids, "<u4").tobytes(), repr(s)


def test_crc_of_a_row_of_parts():
    a, b = random.Random(2).randbytes(1000), random.Random(3).randbytes(4 * 65536)
    assert token_blocks.crc32_after(zlib.crc32(a), len(b)) ^ zlib.crc32(b) == zlib.crc32(a + b)


def distance(p, t):
    before = [0] * (len(t) + 1)
    for i, c in enumerate(p, 1):
        now = [i]
        for j, d in enumerate(t, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (c != d)))
        before = now
    return min(before)


def test_decontamination(spark, odd, rows, empty):
    draw = random.Random(4)
    item = " ".join("".join(draw.choice("abcdefgh") for _ in range(6)) for _ in range(20))
    edits = lambda n: "".join("#"[:0] if i % 9 == 4 and i // 9 < n else c for i, c in enumerate(item))
    k = decontamination.budget(decontamination.normalised(item))
    texts = [item, f"x {item.upper().replace(' ', ' - ')} y", edits(k), edits(k + 6), None, "", "clean text of no item at all", "a Short, one", "ashort one shorty"]
    docs = spark.createDataFrame([*enumerate(texts), (0, item), (None, item)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "short"), (None, "another item that nobody has"), (1, item)], "item_id long, text string")
    found = decontamination.matches(docs, bench, block_chars=40)
    expected = [(i, 1, distance(decontamination.normalised(item), decontamination.normalised(t))) for i, t in [*enumerate(texts), (0, item), (None, item)] if t]
    assert got(found, "doc_id", "item_id", "distance") == ordered([*(x for x in expected if x[2] <= k), (7, 4, 0)])
    assert got(decontamination.decontaminate(docs, bench), "doc_id") == ordered((i,) for i in (3, 4, 5, 6, 8))
    assert got(decontamination.decontaminate(docs, bench, least_chars=6), "doc_id") == ordered((i,) for i in (3, 4, 5, 6, 7, 8))
    assert decontamination.decontaminate(docs.drop("text"), bench).count() == docs.count()
    assert decontamination.decontaminate(odd, bench).columns == odd.columns
    assert decontamination.matches(odd, bench.limit(0)).count() == decontamination.matches(empty, bench).count() == 0


def test_budget_decides_short_items(spark):
    """Items of 14 and 15 characters have an edit, those of 13 have none and stand as whole words."""
    items = ["abcde fghij klm", "abcdefg hijklm", "nopqrs tuvwxy"]
    assert [decontamination.budget(i) for i in items] == [1, 1, 0]
    texts = ["x abcde fghijklm y", "abcdefg hijkl", "nopqrs tuvwx", "xnopqrs tuvwxy", "(Nopqrs, tuvwxy)", "abcd fghi klm"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    expected = [(d, i, n) for d, t in enumerate(texts) for i, x in enumerate(items) if (n := distance(x, decontamination.normalised(t))) <= decontamination.budget(x)]
    assert got(decontamination.matches(docs, bench), "doc_id", "item_id", "distance") == ordered(x for x in expected if x != (3, 2, 0))


def test_least_distance():
    draw = random.Random(6)
    for _ in range(500):
        p, t = ("".join(draw.choice("abc") for _ in range(draw.randint(lo, 14))) for lo in (1, 0))
        assert decontamination.least_distance(decontamination.masks_of(p), len(p), t) == distance(p, t)


def shingles(text, k):
    w = (text or "").encode().lower().split()
    return frozenset(zip(*(w[i:] for i in range(k)), strict=False)) if len(w) >= k else frozenset([tuple(w)]) if w else frozenset()


def components(rows, k):
    sets = {(i, t): shingles(t, k) for i, t, _ in rows}
    parent = {x: x for x in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    with_id = [x for x in sets if x[0] is not None and sets[x]]
    for a in with_id:
        for b in with_id:
            n = len(sets[a] & sets[b])
            if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                parent[root(a)] = root(b)
    least = defaultdict(lambda: 10**9)
    for x in with_id:
        least[root(x)] = min(least[root(x)], x[0])
    return sets, {x: least[root(x)] for x in with_id}


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(odd, rows, empty, k):
    sets, of = components(rows, k)
    by_set = {sets[x]: c for x, c in of.items()}
    expected = [(i, len(sets[i, t]), i if not sets[i, t] else by_set.get(sets[i, t])) for i, t, _ in rows]
    found = near_duplicates.near_duplicates(odd, k)
    assert got(found, "doc_id", "n_shingles", "component_id") == ordered(expected)
    assert all(r["kept"] == (r["component_id"] is None or r["doc_id"] == r["component_id"]) for r in found.collect())
    assert near_duplicates.near_duplicates(empty, k).count() == 0


def test_a_chain_and_a_large_group(spark):
    """Links that only neighbours have, and many different near copies of one text."""
    chain = [" ".join(f"c{j}" for j in range(i, i + 60)) for i in range(0, 40, 4)]
    base = [f"g{i}" for i in range(80)]
    group = [" ".join([*base[:i], f"x{i}", *base[i + 1 :]]) for i in range(80)]
    rows = [(i, t, None) for i, t in enumerate([*chain, *group, *group[:5]])]
    sets, of = components(rows, 2)
    found = near_duplicates.near_duplicates(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), 2)
    assert got(found, "doc_id", "component_id") == ordered((i, of[i, t]) for i, t, _ in rows)


KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    return sum((2 * d - 9 * (d > 4)) if i % 2 else d for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def holds(kind, m):
    digits = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(p) < 256 for p in m.split(".")), "card": 14 <= len(digits) <= 19 and luhn(digits or "0"), "phone": 10 <= len(digits) <= 15}[kind]


def personal(text):
    spans = sorted((m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(KINDS.items()) for m in re.finditer(p, text or "") if holds(kind, m[0]))
    n = Counter(s[3] for s in spans)
    return *(n[k] for k in KINDS), hashlib.sha256(",".join(f"{s[3]}:{s[0]}:{s[2]}" for s in spans).encode()).hexdigest()


def test_personal_data(spark, odd, rows, empty):
    draw = random.Random(8)
    parts = ["a", "b@c", ".d", "@", ".", "1", "22", "255", "256", "4111111111111111", "+39", " ", "-", "(", ")", "é", "𝔘", "\n", "_", "%", "x.y@z.w-v.u", "000.1.2.3"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 30))) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    columns = ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    assert got(pii.personal_data(docs), *columns) == ordered((i, *personal(t)) for i, t in enumerate(texts))
    assert got(pii.personal_data(odd), *columns) == ordered((i, *personal(t)) for i, t, _ in rows)
    assert pii.personal_data(empty).count() == 0
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(odd).collect() if r["doc_id"] is not None}
    assert clean[10].startswith("mail [EMAIL] or [PHONE] now ") and "[CARD], [IP] 1.2.3.999" in clean[15]
    assert pii.sanitise(odd).columns == odd.columns


def test_disclosing_terms(spark):
    """A nickname that stands with one address only is found; what stands everywhere is not."""
    texts = [f"the report of Zorro{i} says write to z@mail.example.com today" if i < 3 else f"the report {i} says nothing today" for i in range(40)]
    texts = [t.replace(f"Zorro{i}", "Zorro") for i, t in enumerate(texts)]
    rows = {r["doc_id"]: r for r in pii.personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    start = texts[0].index("Zorro")
    assert f"term:{start}:{start + 5}" in rows[0]["spans"] and "email:" in rows[0]["spans"]
    assert all(f"term:{texts[0].index(w)}:" not in rows[0]["spans"] for w in ("report", "today"))
    assert all(rows[i]["spans"] == "" for i in range(3, 40))


def test_mixing(spark, odd, rows, empty):
    report = mixing.mix_report(odd)
    found = report.collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(SPACE.findall(t or ""))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    target, left, open_ = {}, 1.5 * sum(sizes.values()), set(order)
    while True:  # the excess goes round until no source is above its limit
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] >= 2 * sizes[s]}
        if not full:
            break
        for s in full:
            target[s] = 2 * sizes[s]
            left -= target[s]
        open_ -= full
        if not open_:
            break
    target |= {s: level * weight[s] for s in open_}
    assert ordered((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6)) for r in found) == ordered((i, len(SPACE.findall(t or "")), sizes[s], round(float(target[s]), 6)) for i, t, s in rows)
    assert all(r["taken"] <= 2 * r["size"] and (not r["size"] or r["taken"] % r["size"] == 0) for r in found)
    assert got(report, *report.columns) == got(mixing.mix_report(odd), *report.columns)
    mixed = mixing.mix(odd)
    assert mixed.columns == odd.columns and sum(len(SPACE.findall(r["text"] or "")) for r in mixed.collect()) == sum(r["taken"] for r in found)
    assert mixing.mix_report(empty).count() == mixing.mix(empty).count() == 0


def passages(rows):
    words = [(i, (t or "").encode().split()) for i, t, _ in rows]
    low = {}
    for i, w in words:
        for s in range(len(w) - 49):
            x = tuple(w[s : s + 50])
            if i is not None:
                low[x] = min(low.get(x, i), i)
    for i, w in words:
        gone = {p for s in range(len(w) - 49) if i is not None and low[tuple(w[s : s + 50])] < i for p in range(s, s + 50)}
        yield i, len(w), len(gone), hashlib.sha256(b" ".join(x for p, x in enumerate(w) if p not in gone)).hexdigest()


def test_repeated_passages(spark, odd, rows, empty):
    columns = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert got(repeated_passages.repeated_passages(odd), *columns) == ordered(passages(rows))
    draw = random.Random(9)
    pool = [[f"p{k}w{i}" for i in range(draw.randint(40, 120))] for k in range(6)]
    texts = [" ".join(w for _ in range(draw.randint(1, 4)) for w in (draw.choice(pool)[draw.randint(0, 30) :] if draw.random() < 0.7 else [f"u{draw.random()}" for _ in range(20)])) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert got(repeated_passages.repeated_passages(docs), *columns) == ordered(passages([(i, t, None) for i, t in enumerate(texts)]))
    cut = {r["doc_id"]: r["text"] for r in repeated_passages.without_repeats(docs).collect()}
    assert {(i, hashlib.sha256(" ".join(cut[i].split()).encode()).hexdigest()) for i in cut} == {(r[0], r[3]) for r in passages([(i, t, None) for i, t in enumerate(texts)])}
    assert repeated_passages.without_repeats(odd).columns == odd.columns
    assert repeated_passages.repeated_passages(empty).count() == 0


def test_the_cover_has_every_difference_once():
    differences = Counter((a - b) % repeated_passages.PERIOD for a in repeated_passages.COVER for b in repeated_passages.COVER if a != b)
    assert differences == Counter(range(1, repeated_passages.PERIOD))


def test_window_hashes():
    h = WordHashes()([b"a", b"b", b"c", b"a", b"b", b"c", b"d"])
    for n in (1, 2, 3):
        w = windows(h, n)
        assert len(w) == 8 - n and w[0] == w[3]
    assert len(windows(h, 8)) == 0 and len({int(windows(h[i:], n)[0]) for i, n in ((0, 2), (0, 3), (1, 2), (1, 3))}) == 4


def test_language_id(spark, odd, rows, empty):
    draw = random.Random(10)
    lexicon = {"en": ["the", "thing", "with", "that", "other"], "de": ["der", "nicht", "schön", "und", "ich"], "fr": ["le", "quelle", "être", "où", "nous"]}
    docs = [(i, " ".join(draw.choice(lexicon[k]) + draw.choice(["", "s", "e", "n"]) for _ in range(draw.randint(3, 40))), k) for i in range(300) for k in [draw.choice(list(lexicon))]]
    df = spark.createDataFrame([*docs, (900, "12 34 !", "en"), (901, None, "de"), (902, "the" * 200, "en"), (None, "nicht und ich", "de")], "doc_id long, text string, lang string")
    found = language_id.language_report(df, RANKS).collect()
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in found)
    truth = {i: k for i, _, k in docs}
    held = [r for r in found if r["held_out"] and r["doc_id"] in truth]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    assert {r["doc_id"]: r["lang_pred"] for r in found if r["doc_id"] in (900, 901)} == {900: "und", 901: "und"}
    assert len(language_id.language_report(odd, RANKS).collect()) == len(rows)
    assert language_id.language_report(empty, RANKS).count() == 0


def test_segmentations_are_summed():
    """Against every segmentation, one by one; the batch form and the long form are the same."""
    pieces = {p: i for i, p in enumerate([b" ", b"a", b"b", b"ab", b" a", b"ba"], 1)}
    p = np.random.Generator(np.random.PCG64(1)).random((len(pieces) + 1, 2))
    model = language_id.Unigrams(pieces, ["x", "y"], p)

    def total(w):
        return np.ones(2) if not w else sum((p[i] * total(w[len(k) :]) for k, i in pieces.items() if w.startswith(k)), np.zeros(2))

    for w in (b"a", b"abba", b"babab"):
        assert np.allclose(np.exp(model.scores([w])[0]), total(b" " + w)) and np.allclose(model._long(b" " + w), model.scores([w])[0])


SECRETS = {"assign": re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), "access": re.compile("AKIA[A-Z0-9]+"), "hex": re.compile("[0-9a-f]+")}


def secret(text):
    fits = {"assign": lambda m: len(m[2]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}
    spans = sorted((m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(SECRETS.items()) for m in p.finditer(text or "") if fits[kind](m))
    return *(sum(s[1] == k for s in spans) for k in range(3)), hashlib.sha256(",".join(f"{s[3]}:{s[0]}:{s[2]}" for s in spans).encode()).hexdigest()


def test_secrets(spark, odd, rows, empty):
    draw = random.Random(11)
    parts = ["token", "=", ": ", "secret", "API_key", "ſecret", '"', "abcdef", "AKIA", "A1B2C3D4E5F6G7H8", "0123456789abcdef", "deadbeefdeadbeef", " ", "é", "xyz", "/+"]
    texts = ["".join(draw.choice(parts) for _ in range(draw.randint(1, 14))) for _ in range(500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    columns = ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")
    found = secrets.secrets(docs)
    assert got(found, *columns) == ordered((i, *secret(t)) for i, t in enumerate(texts))
    assert got(secrets.secrets(odd), *columns) == ordered((i, *secret(t)) for i, t, _ in rows)
    assert secrets.secrets(empty).count() == 0


def test_inferred_formats():
    """Keys of one form are learned; what is not of the form scores lower."""
    draw = random.Random(12)
    key = lambda: "sk-" + "".join(draw.choice("ABCDEF0123456789") for _ in range(24))
    word = lambda: "".join(draw.choice("ghijklmnopqrstuvw") for _ in range(27))
    grammar = secrets.Grammar({0: [key() for _ in range(200)]}, [word() for _ in range(100)])
    assert sum(grammar.accepts(key()) for _ in range(100)) >= 90
    assert not any(grammar.accepts(x) for x in (word(), word()[:-2] + "42", "http://example.com/page/12345/index.html"))
    automaton = grammar.kinds[0][0]
    assert automaton.states < 60  # far fewer than the tree has
    assert len(automaton.next) == automaton.states == len(automaton.ends)  # and no others are kept
    assert all(t < automaton.states for ways in automaton.next for t in ways.values())


def test_long_examples_are_read_whole():
    """Keys of 150 characters that end in another form than they start with: what follows the first part counts."""
    draw = random.Random(13)
    take = lambda letters, n: "".join(draw.choice(letters) for _ in range(n))
    key = lambda: take("0123456789", 100) + "-" + take("ghijkl", 49)
    grammar = secrets.Grammar({0: [key() for _ in range(200)]}, [take("ghijkl", 9) for _ in range(100)])
    assert sum(grammar.accepts(key()) for _ in range(50)) >= 40
    assert not any(grammar.accepts(take("0123456789", 100) + "-" + take("GHIJKL", 49)) for _ in range(20))


def test_token_counts(odd, rows, empty):
    from tokenizers import Tokenizer, models, pre_tokenizers

    def tokenizer(vocabulary, fallback):
        t = Tokenizer(models.Unigram(vocabulary, 0, fallback))
        t.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=False)])
        return lambda s: len(t.encode(s, add_special_tokens=False).ids)

    vocabulary = token_counts.vocabulary(PIECES)
    exact = tokenizer(vocabulary, True)
    assert got(token_counts.token_counts(odd, PIECES), "doc_id", "n_tokens") == ordered((i, exact(t or "")) for i, t, _ in rows)
    assert token_counts.token_counts(empty, PIECES).count() == 0
    ties = [("<unk>", 0.0), ("▁", -2.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁a", -3.0), ("ba", -2.0), ("bab", -3.0)]
    draw = random.Random(13)
    for table, fallback, letters in ((vocabulary, True, "abcthe日𝔘é▁<s>0 \x1c"), (ties, False, "abxy ")):
        counter, exact = token_counts.Counter(table), tokenizer(table, fallback)
        for _ in range(1500):
            s = "".join(draw.choice(letters) for _ in range(draw.randint(0, 20)))
            assert counter(token_counts.words_of(s)) == exact(s), repr(s)
    per_source = {r["source"]: r["n_docs"] for r in token_counts.source_counts(odd, PIECES).collect()}
    assert per_source == Counter(s for _, _, s in rows)


def measured(text):
    text = text or ""
    w = SPACE.findall(text)
    g = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = {p for i in range(len(w) - 4) if g[tuple(w[i : i + 5])] > 1 for p in range(i, i + 5)}
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(again), len(w) < 10 or 100 * len(again) > 20 * len(w)


def test_quality_rules(spark, odd, rows, empty):
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    draw = random.Random(14)
    texts = ["".join(draw.choice(["a ", "b ", "c\n", "é ", "# ", "the end.\n", "\t", "|"]) for _ in range(draw.randint(0, 60))) for _ in range(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert got(quality.quality_rules(docs), *columns) == ordered((i, *measured(t)) for i, t in enumerate(texts))
    assert got(quality.quality_rules(odd), *columns) == ordered((i, *measured(t)) for i, t, _ in rows)
    assert quality.quality_rules(empty).count() == quality.clean(empty).count() == 0
    assert quality.clean(odd).columns == odd.columns


def test_wrapped_and_open_lines_stay(spark):
    """Prose with lines broken anywhere, a long line without its last mark, and other scripts' marks."""
    words = " ".join(f"w{i} goes on." if i % 17 == 16 else f"w{i}" for i in range(200)).split()
    wrapped = "\n".join(" ".join(words[i : i + 12]) for i in range(0, 200, 12))
    texts = [wrapped, " ".join(words) + " card 4111", "\n".join(" ".join(f"क{i}{j}" for j in range(9)) + " है।" for i in range(9)), "\n".join(" ".join(f"Item{i}{j}" for j in range(12)) for i in range(20))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r["doc_id"]: r["kept"] for r in quality.quality_rules(docs).collect()} == {0: True, 1: True, 2: True, 3: False}


def test_lines_go_first(spark):
    prose = "\n".join(f"This line{i} has{i} some{i} words{i} that{i} anyone{i} can read{i} to{i} the end{i}." for i in range(12))
    texts = [prose, prose + "\nHome | About | Contact | Login\nWe use cookies, click here to accept.", "\n".join(["a | b | c | d e f g"] * 9 + [prose[:80] + "."]), "BUY!! NOW!! THIS!! IS!! IT!! OR!! NOT!! EVER!! SO!! GO!! ON!!"]
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    assert {r["doc_id"]: r["kept"] for r in quality.quality_rules(docs).collect()} == {0: True, 1: True, 2: False, 3: False}
    assert got(quality.clean(docs), "doc_id", "text", "n_chars") == [(0, prose, len(prose)), (1, prose, len(prose))]
