"""The pipeline's stages, one after another, on a small corpus with planted cases."""

import random

import corpus_pipeline
from chartloom.llm.queries import queries


def corpus(spark, folder):
    draw = random.Random(20)
    words = ["".join(draw.choice("abcdefghiklmnoprstu") for _ in range(draw.randint(2, 8))) for _ in range(900)]
    prose = lambda n: "\n".join(" ".join(draw.choice(words) for _ in range(14)) + "." for _ in range(n))
    items = [prose(2) for _ in range(3)]
    clean = [prose(6) for _ in range(40)]
    near = clean[0].rsplit(" ", 1)[0] + " changed."
    texts = [*clean, clean[1], near, clean[2] + "\n" + items[0] + "\n" + prose(9), "a | b | c | d | e\n" * 12, "few words", None]
    rows = [(i, t, "en", f"src{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return len(clean)


def test_stages(spark, tmp_path):
    n = corpus(spark, str(tmp_path))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        kept.append(sorted(r["doc_id"] for r in docs.collect()))
        assert k == len(corpus_pipeline.STAGES) - 1 or docs.columns == columns
    assert kept[0] == list(range(n + 3))  # the menu, the short and the null one go
    assert kept[1] == [*range(n), n + 2]  # the copy and the near copy go
    assert kept[2] == list(range(n))  # the one with a benchmark item goes
    assert set(kept[3]) <= set(kept[2]) and max(map(kept[3].count, kept[3])) <= 2
    assert kept[4] == kept[3]
    again = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in again) == sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in docs.collect())


def test_odd_tables(spark, tmp_path, odd):
    """Nulls, repeated rows and ids, and columns with unlucky names go through all stages; an empty table gives none."""
    bench = spark.createDataFrame([(1, "an item that stands in none of these"), (2, None), (None, "")], "item_id long, text string")
    for name, docs in (("odd", odd), ("empty", odd.limit(0))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        bench.write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, f"{tmp_path}/odd")
        assert docs.columns == odd.columns, name
        docs.write.parquet(f"{tmp_path}/stage-{name}")
        docs = spark.read.parquet(f"{tmp_path}/stage-{name}")
        assert {r["doc_id"] for r in docs.collect()} <= {r["doc_id"] for r in odd.collect()}
    found = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    assert sorted((r["doc_id"] for r in found), key=repr) == sorted((r["doc_id"] for r in docs.collect()), key=repr)
    assert found and all(r["n_tokens"] > 1 for r in found)
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").count() == 0


def test_registered():
    assert {x.split("_")[0] for x in queries()} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
