"""Pages are parsed once each, and tried in order."""

from datetime import date

from pyspark.sql import functions as F

from chartloom.sources import pages

ENTRY = '<div><span>{}</span><a href="/film/x/{}/scheda/" title="T{}">x</a><p>Settimane: 1 Distribuzione: D Inc. weekend: &euro; 10 Schermi: 2 Inc. totale: &euro; 20</p></div>'
HEAD = "<h1>dal 4 gennaio 2024 al 7 gennaio 2024</h1>"


def page(*ranks, head=HEAD):
    return f"<html><body>{head}{''.join(ENTRY.format(r, k, k) for k, r in enumerate(ranks))}</body></html>"


def test_the_text_of_a_page_moves_once(spark):
    df = spark.createDataFrame([(1, "IT", page(*range(1, 100))), (2, "FR", page(5, 5, 6)), (3, None, None)], "page_id long, territory string, html string")
    got = {r["page_id"]: r for r in pages.parsed(df).collect()}
    assert len(got) == 3 and [len(got[k]["entries"]) for k in (1, 2, 3)] == [99, 2, 0]
    rows = pages.chart_pages(df, "").filter("page_id = 2").orderBy("rank").collect()
    assert [(r["territory"], r["rank"], r["title"], r["weekly_gross"]) for r in rows] == [("FR", 5, "T0", 1000), ("FR", 6, "T2", 1000)]


def test_refused_pages_have_one_row(spark):
    df = spark.createDataFrame([(1, page(1, 2, head="")), (2, page()), (3, page(1, 2)), (4, None)], "page_id long, html string")
    asked = F.when(F.col("page_id") == 3, F.lit("2024-02-01")).otherwise(F.lit("2024-01-05")).cast("date")
    found = pages.tried(df, "", asked)
    assert found.count() == 4
    want = {1: "the page names no week", 2: "the page has no entry", 3: "the page is of the week 2024-01-04..2024-01-07, which has no 2024-02-01", 4: "the page names no week"}
    assert {r["page_id"]: r["reason"] for r in found.collect()} == want == {r["page_id"]: r["reason"] for r in pages.dead_letters(df, asked).collect()}


def test_first_page_of_each_request(spark):
    bad, good = page(), page(1)
    rows = [("a", 1, 1, good), ("a", 1, 2, good), ("b", 1, 3, bad), ("b", 3, 4, good), ("b", 2, 5, good), ("c", 1, 6, bad), (None, 1, 7, good), ("d", None, 8, bad), ("d", 1, 9, good)]
    df = spark.createDataFrame(rows, "request string, priority long, page_id long, html string").withColumn("day", F.lit(date(2024, 1, 4)))
    got = pages.first_page(df)
    assert {r["request"]: (r["page_id"], r["day"]) for r in got.collect()} == {k: (v, date(2024, 1, 4)) for k, v in (("a", 1), ("b", 5), (None, 7), ("d", 9))}
