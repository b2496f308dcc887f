"""The document for a site: latest week, trend and top titles, and the contract that it has to keep."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import date, datetime
from numbers import Real

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import relational as R

TREND, TOP = 8, 5


def payload_rows(fact: DataFrame) -> DataFrame:
    """(territory, document): one JSON document for each chart."""
    chart = list(R.CHART)
    trend = R.weekly_trend(fact, TREND).groupBy(*chart).agg(F.array_sort(F.collect_list(F.struct(F.date_format("week_start", "yyyy-MM-dd").alias("week_start"), "total_gross", "titles"))).alias("weekly_trend"))
    top = R.top_titles(fact, TOP).groupBy(*chart).agg(F.array_sort(F.collect_list(F.struct("rank", "title", F.col("weekly_gross").alias("weekly_gross"), "screen_count"))).alias("top_titles"))
    rows = R.latest_week(fact).join(trend, chart).join(top, chart)
    document = F.struct(F.col("source_name").alias("source"), "territory", F.lit("EUR").alias("currency"), F.date_format("week_start", "yyyy-MM-dd").alias("latest_week"), "weekly_trend", "top_titles")
    return rows.select("territory", F.to_json(document).alias("document"))


def write_site(fact: DataFrame, path: str) -> None:
    """The documents as files of one line of JSON, in a folder for each territory."""
    payload_rows(fact).write.mode("overwrite").partitionBy("territory").text(path)


def problem_rows(documents: DataFrame) -> DataFrame:
    """(territory, problem) for each thing that is wrong with a (territory, document)."""

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in source:
            found = [(t, p) for t, d in zip(x.column(0).to_pylist(), x.column(1).to_pylist(), strict=True) for p in payload_problems(json.loads(d))]
            yield pa.RecordBatch.from_pydict({"territory": [t for t, _ in found], "problem": [p for _, p in found]}, schema=pa.schema([("territory", pa.string()), ("problem", pa.string())]))

    return documents.select("territory", "document").mapInArrow(run, "territory string, problem string")


def payload(fact: DataFrame, report: DataFrame, territory: str, generated_at: str, note: str) -> dict:
    """The document of one chart; no export while a check fails. Levels are nine rows, the document one."""
    levels = [r["level"] for r in report.collect()]
    if "FAIL" in levels:
        raise SystemExit("a health check failed: no export")
    row = payload_rows(fact.filter(F.col("territory") == territory)).first()
    return {"generated_at": generated_at, "has_quality_warnings": "WARN" in levels, "note": note} | (json.loads(row["document"]) if row else {})


def _number(x) -> bool:
    return isinstance(x, Real) and not isinstance(x, bool)


def payload_problems(document: dict) -> list[str]:
    """What is wrong with a document, field by field."""
    found = [f"{k}: a text is expected" for k in ("source", "territory", "currency", "latest_week", "note") if not (isinstance(document.get(k), str) and document[k])]
    if not isinstance(document.get("has_quality_warnings"), bool):
        found.append("has_quality_warnings: true or false is expected")
    for k, read in (("generated_at", datetime.fromisoformat), ("latest_week", date.fromisoformat)):
        try:
            read(str(document.get(k)))
        except ValueError:
            found.append(f"{k}: an ISO date is expected")
    rules = {
        "weekly_trend": lambda r: isinstance(r.get("week_start"), str) and _number(r.get("total_gross")) and isinstance(r.get("titles"), int),
        "top_titles": lambda r: isinstance(r.get("rank"), int) and isinstance(r.get("title"), str) and bool(r["title"]) and _number(r.get("weekly_gross")) and (r.get("screen_count") is None or isinstance(r["screen_count"], int)),
    }
    for k, fits in rules.items():
        rows = document.get(k)
        if not isinstance(rows, list) or not rows:
            found.append(f"{k}: a list with rows is expected")
        else:
            found += [f"{k}[{i}]: fields are missing or of another type" for i, r in enumerate(rows) if not (isinstance(r, dict) and fits(r))]
    return found
