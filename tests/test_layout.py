"""Operators by week over a fact in buckets of weeks: the same rows, without an exchange."""

from chartloom.operators import quality
from chartloom.operators import relational as R
from chartloom.sources import layout

from test_weeks import FACT, row


def test_windows_by_week_need_no_exchange(spark, tmp_path):
    rows = [row(100 * k + i, f"t{i}", k, gross=(i * 37) % 11 * 100, movie=i) for k in range(9) for i in range(12)]
    plain = spark.createDataFrame(rows, FACT)
    try:
        dealt = layout.bucketed(plain, "chart_fact_in_buckets", 4)
        for operator in (quality.batch_warnings, quality.order_violations, R.dedupe, R.duplicate_keys):
            assert layout.exchanges(operator(dealt)) == 0 and layout.exchanges(operator(plain)) > 0
            assert sorted(map(repr, operator(dealt).collect())) == sorted(map(repr, operator(plain).collect()))
        # the latest week of a chart takes one exchange, of a few rows of each week
        assert layout.exchanges(R.top_titles(dealt)) == 1 < layout.exchanges(R.top_titles(plain))
        assert sorted(map(repr, R.top_titles(dealt).collect())) == sorted(map(repr, R.top_titles(plain).collect()))
        assert layout.bucketed(plain, "chart_fact_in_buckets", 2, layout.rows_of(plain)).count() == len(rows)
    finally:
        spark.sql("DROP TABLE IF EXISTS chart_fact_in_buckets")
