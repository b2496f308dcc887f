import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and columns with unlucky names."""
    draw = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "Über", "日本", "end.", "stop."]
    line = lambda n: " ".join(draw.choice(words) for _ in range(n)) + "."
    passage = " ".join(f"w{i}" for i in range(70))
    near = [f"n{i}" for i in range(60)]
    texts = [None, "", " \t\n", "one", "two words", line(30), line(2000), passage, "before " + passage + " after", passage, "mail a.b@mail.example.com or +39 06 1234 5678 now " + line(12)]
    texts += [" ".join(near), " ".join([*near[:-1], "x"]), " ".join([*near, "y"]), "x" * 5000, "token = \"24be64439e3e49cf46b2d7c90f3602a3d0b907ff\" 4111 1111 1111 1111, 10.0.0.255 1.2.3.999"]
    rows = [(i, t, draw.choice(["en", "de", None]), draw.choice(["a", "b", None]), None) for i, t in enumerate(texts)]
    rows += [rows[5], rows[8], (None, texts[7], None, None, None), (None, None, None, None, None), (3, "another text of that id", "en", "a", 1)]
    df = rows and pytest.importorskip("pyspark").sql.SparkSession.active().createDataFrame(rows, SCHEMA)
    for name in ("key", "rid", "rep", "hash", "q", "size", "mix_size", "q_text", "pii_key", "cut_key", "n", "u", "item_id", "kept"):
        df = df.withColumn(name, F.lit("extra"))
    return df.cache()


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture
def rows(odd):
    return [(r["doc_id"], r["text"], r["source"]) for r in odd.collect()]
