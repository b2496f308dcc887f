"""The trie of conversations against tries built turn by turn."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from chartloom.llm import prefix_trie
from chartloom.llm.oracle import OP11

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
KIND = "conv_id long, turn long, role string, text string, depth string, name string, low string, length string"


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5, [])[: h[c]] + v[h[c] :] for c, v in own.items()}


def brute(rows):
    turns = rebuilt(rows)
    members = defaultdict(list)
    for c in sorted(turns):
        for d in range(len(turns[c]) + 1):
            members[tuple(turns[c][:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []

    def below(node):
        yield node
        for x in children[node]:
            yield from below(x)

    for node, held in members.items():
        inside = list(below(node))
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in inside if x)
        ends = ",".join(str(c) for c in held if len(turns[c]) == len(node))
        out.append((held[0], len(node), members[node[:-1]][0] if node else None, len(held), len(children[node]), sum(not children[x] for x in inside), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def made(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", "y", "z", "w") for r in rows], KIND).repartition(parts)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def odd_rows():
    draw = random.Random(4)
    rows = []
    for c in [*range(40), 1003, 1004]:  # 1000 is absent
        for t in range(draw.randint(1, 12)):
            rows.append((c, t, draw.choice(["user", "assistant"]), draw.choice(["a", "b", "Über", "", None])))
    rows += [(50 + i, t, "user", "same") for i in range(20) for t in range(11)]  # copies
    rows += [(c, None, None, "null turn") for c in (3, 7)] + [(7, 1, "user", "a"), (7, 1, "user", "a"), (7, 1, None, None)]
    return [*rows, (None, 1, "user", "nobody's"), (100, 0, "user", "é" * 300_000)]


def test_nodes(spark, odd_rows):
    assert found(prefix_trie.prefix_trie(made(spark, odd_rows))) == brute(odd_rows)


def test_sql(spark, odd_rows):
    c = duckdb.connect()
    conversations = made(spark, odd_rows).toPandas()  # noqa: F841
    c.execute("CREATE TABLE t AS SELECT conv_id::bigint AS conv_id, turn::bigint AS turn, role, text FROM conversations")
    by_sql = c.execute(OP11.replace("FROM conversations", "FROM t"))
    names = [x[0] for x in by_sql.description]
    assert sorted((tuple(r[names.index(k)] for k in COLUMNS) for r in by_sql.fetchall()), key=repr) == brute(odd_rows)


def test_runs_of_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "RUN", 4)
    monkeypatch.setattr(prefix_trie, "CHUNK", 8)
    rows = [(5, t, "user", f"t{t % 3}") for t in range(40)] + [(10, t, "user", f"t{t % 3}") for t in range(25)]
    rows += [(15, t, "user", f"t{t % 3}" if t < 30 else "other") for t in range(33)]
    assert found(prefix_trie.prefix_trie(made(spark, rows))) == brute(rows)


def test_nothing(spark):
    assert prefix_trie.prefix_trie(made(spark, [(5, 1, "user", "a")]).limit(0)).count() == 0
    assert found(prefix_trie.prefix_trie(made(spark, [(1001, 0, "user", "a")]))) == brute([(1001, 0, "user", "a")])  # turnless: its base is absent
