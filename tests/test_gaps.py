"""Gaps told by a stream, out of order and late, against the batch's."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from chartloom.operators.calendar import missing_weeks
from chartloom.streaming.gaps import watch_gaps

KIND = "source_name string, territory string, week_start date"


def test_replayed_weeks_give_the_gaps_of_the_batch(spark, tmp_path):
    draw = random.Random(3)
    first = date(2024, 1, 4)
    weeks = {t: [k for k in range(30) if draw.random() > 0.25 or k in (0, 29)] for t in ("IT", "DE", "FR")}
    rows = [("box", t, first + timedelta(7 * k)) for t, v in weeks.items() for k in v]
    rows.sort(key=lambda r: (r[2].toordinal() + draw.choice([0, 0, 0, 35]), r[1]))  # some come five weeks late
    rows.append(("box", "clock", first + timedelta(7 * 60)))  # time goes on
    source = str(tmp_path / "source")
    for i in range(0, len(rows), 9):
        spark.createDataFrame(rows[i : i + 9], KIND).coalesce(1).write.mode("append").parquet(source)
    out = str(tmp_path / "out")

    def keep(batch, n):
        batch.withColumn("batch", F.lit(n)).write.mode("append").parquet(out)

    stream = watch_gaps(spark.readStream.schema(KIND).option("maxFilesPerTrigger", 1).parquet(source))
    stream.writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    told = spark.read.parquet(out)
    last = told.groupBy("territory", "expected").agg(F.max_by("status", F.struct("batch", F.col("status") == "missing")).alias("status")).filter("status = 'missing'")
    want = missing_weeks(spark.createDataFrame([r for r in rows if r[1] != "clock"], KIND)).select("territory", "expected")
    assert want.count() > 3
    horizon = {t: first + timedelta(7 * (29 - 12)) for t in weeks}  # what the chart's state still has
    got = {(r["territory"], r["expected"]) for r in last.collect() if r["expected"] >= horizon.get(r["territory"], date.max)}
    assert got == {tuple(r) for r in want.collect()}
