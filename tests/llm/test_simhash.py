"""SimHash groups against all pairs."""

import random

import numpy as np
import xxhash

from chartloom.llm import simhash

KIND = "doc_id long, text string, fp string, low string, part string, fingerprint string"


def bits(text):
    words = (text or "").encode().lower().split()
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, fps, radius=3):
    part = list(range(len(fps)))

    def top(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                part[top(i)] = top(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[top(i)] = min(d, least.get(top(i), d))
    return sorted(((d, f"{f:016x}", least.get(top(i))) for i, (d, f) in enumerate(zip(ids, fps, strict=True))), key=repr)


def found(df):
    return sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in df.collect()), key=repr)


def test_groups(spark):
    draw = random.Random(1)
    prose = lambda n: [draw.choice("abcdefgh") + str(draw.randint(0, 300)) for _ in range(n)]
    texts = [None, "", " \t\r", "one", "Two words", "\xc0 \xe0 \xc0", "x" * 200_000]
    for _ in range(12):  # chains of small changes
        now = prose(250)
        for _ in range(5):
            texts.append(" ".join(now))
            now = [*now]
            now[draw.randrange(250)] = "changed"
    texts += [texts[9]] * 4 + [" ".join(prose(150_000))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[8]), (None, "alone"), (3, "another text of that id")]
    docs = spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], KIND).repartition(3)
    want = groups([r[0] for r in rows], [bits(r[1]) for r in rows])
    assert found(simhash.simhash_groups(docs)) == want
    assert found(simhash.simhash_groups(docs, tree=2)) == want  # every shard is several trees
    assert len({x[2] for x in want}) < len(want) - 20
    assert simhash.simhash_groups(docs.limit(0)).count() == 0


def test_the_tree_is_that_of_insertions():
    draw = np.random.default_rng(2)
    fps = np.unique(draw.integers(0, 1 << 12, 200).astype(np.uint64))
    draw.shuffle(fps)
    forest, children = simhash.Forest(fps, np.zeros(len(fps), int)), {}
    for i in range(1, len(fps)):
        at = 0
        while (edge := (at, int(fps[i] ^ fps[at]).bit_count())) in children:
            at = children[edge]
        children[edge] = i
    assert dict(zip(forest.keys.tolist(), forest.children.tolist(), strict=True)) == {65 * n + d: c for (n, d), c in children.items()}
    near = {(q, r) for query, row in forest.search(fps, np.zeros(len(fps), int), 2) for q, r in zip(query.tolist(), row.tolist(), strict=True)}
    assert near == {(i, j) for i in range(len(fps)) for j in range(len(fps)) if int(fps[i] ^ fps[j]).bit_count() <= 2}


def test_every_pair_shares_two_blocks():
    draw = random.Random(3)
    masks = [m % (1 << 64) for m in simhash.masks(3)]
    assert len(masks) == 10
    for _ in range(500):
        a = draw.getrandbits(64)
        b = a
        for k in draw.sample(range(64), 3):
            b ^= 1 << k
        assert any(a & m == b & m for m in masks)


def test_a_dense_ball_in_many_trees(spark):
    fps = sorted({sum(1 << b for b in random.Random(i).sample(range(64), 2)) for i in range(400)})
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    edges = simhash.links(df, simhash.Stash(spark, "ball"), 3, tree=16).collect()
    reach = {}
    for e in edges:
        reach.setdefault(e["u"], set()).add(e["v"])
        reach.setdefault(e["v"], set()).add(e["u"])
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    want = groups(signed, fps)
    todo, seen = [signed[0]], {signed[0]}
    while todo:
        for x in reach.get(todo.pop(), ()):
            if x not in seen:
                seen.add(x)
                todo.append(x)
    assert len(seen) == sum(w[2] == min(x for x in seen) for w in want)
