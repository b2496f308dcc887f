"""The chart fact in a folder for each week, and loads that rewrite only the weeks they touch.

A load has two phases. First the run and the raw snapshots are written, whatever becomes of the data. Then the records
are staged in one pass, which parts them into accepted and refused and counts both; the accepted ones are merged into
their weeks, and the run is closed. A load that is killed between the phases leaves a run that is open, which ``sweep``
closes, and no week half written: Spark moves a week's files into place when all of them are there. A load that comes
again gives the same rows.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import relational as R
from ..operators.merge import stamped, upsert_chart
from ..operators.quality import quarantine

RUN = "run_id long, pipeline_name string, status string, at long, records_read long, records_refused long, error_message string"
WEEK = "week_start"


class SchemaChanged(ValueError):
    """The columns that come are not those that the table was made with."""


def fingerprint(schema: StructType) -> str:
    """What names and types of a table's columns make, whatever their order."""
    columns = sorted((f.name, f.dataType.simpleString()) for f in schema.fields)
    return hashlib.sha256(json.dumps(columns).encode()).hexdigest()


def now() -> int:
    return time.time_ns() // 1000


class Weeks:
    """The tables of a chart under ``root``: fact, snapshots, refused rows and runs."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _there(self, table: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    # -- the fact --------------------------------------------------------------------------------

    def _held(self, schema: StructType) -> None:
        """Writes the manifest of a new table; of one that is there, the schema has to be the same."""
        found = fingerprint(schema)
        if not self._there("fact_schema"):
            row = [(found, schema.json())]
            self.spark.createDataFrame(row, "fingerprint string, schema string").coalesce(1).write.json(self.path("fact_schema"))
            return
        row = self.spark.read.schema("fingerprint string, schema string").json(self.path("fact_schema")).first()
        if row["fingerprint"] != found:
            was = {f.name: f.dataType.simpleString() for f in StructType.fromJson(json.loads(row["schema"])).fields}
            comes = {f.name: f.dataType.simpleString() for f in schema.fields}
            odd = sorted(k for k in was.keys() | comes.keys() if was.get(k) != comes.get(k))
            raise SchemaChanged(f"columns that differ from the table's: {', '.join(odd)}")

    def fact(self) -> DataFrame:
        """The fact as its manifest says; a file that has other columns stops whoever reads it."""
        row = self.spark.read.schema("fingerprint string, schema string").json(self.path("fact_schema")).first()
        schema = StructType.fromJson(json.loads(row["schema"]))
        found = self.spark.read.parquet(self.path("fact"))
        if fingerprint(found.schema) != row["fingerprint"]:
            raise SchemaChanged("the files of the fact have other columns than its manifest")
        return found.select(*schema.names)

    def merge(self, batch: DataFrame, run_id: int | None = None, at: int | None = None) -> None:
        """Upserts chart rows: only the weeks of the batch are read and written. ``created_at`` of a row stays."""
        batch = stamped(batch, ["ingestion_run_id", "created_at", "updated_at"], run_id, at or now())
        self._held(batch.schema)
        weeks = batch.select(WEEK).distinct()
        old = self.fact().join(weeks, WEEK, "left_semi").select(*batch.columns) if self._there("fact") else batch.limit(0)
        rows = upsert_chart(old, batch).hint("rebalance", WEEK)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(WEEK).parquet(self.path("fact"))

    # -- runs ------------------------------------------------------------------------------------

    def log(self, run_id: int, pipeline: str, status: str, at: int, read: int = 0, refused: int = 0, error: str | None = None) -> None:
        self.spark.createDataFrame([(run_id, pipeline, status, at, read, refused, error)], RUN).coalesce(1).write.mode("append").parquet(self.path("runs"))

    def runs(self) -> DataFrame:
        """The last state of each run."""
        rows = self.spark.read.schema(RUN).parquet(self.path("runs"))
        last = F.max_by(F.struct(*[c for c in rows.columns if c != "run_id"]), F.struct("at", F.col("status") != "running"))
        return rows.groupBy("run_id").agg(last.alias("x")).select("run_id", "x.*")

    def sweep(self, before: int) -> int:
        """Closes runs that were begun before that time and are open still; gives their number."""
        open_ = self.runs().filter((F.col("status") == "running") & (F.col("at") < before))
        closed = open_.withColumn("status", F.lit("failed")).withColumn("at", F.lit(now())).withColumn("error_message", F.lit("the load has ended without closing its run"))
        watch = Observation()
        closed.observe(watch, F.count("*").alias("n")).write.mode("append").parquet(self.path("runs"))
        return watch.get["n"]

    # -- loads -----------------------------------------------------------------------------------

    def begin(self, run_id: int, pipeline: str, snapshots: DataFrame, at: int) -> None:
        """The first phase: the run, and the pages as they came."""
        self.log(run_id, pipeline, "running", at)
        snapshots.withColumn("run_id", F.lit(run_id).cast("long")).write.mode("append").partitionBy("run_id").parquet(self.path("snapshots"))

    def stage(self, run_id: int, records: DataFrame) -> tuple[DataFrame, dict[str, int]]:
        """The accepted records, and how many were read and refused, from one pass that writes both kinds."""
        watch, staged = Observation(), f"{self.root}/staged/{uuid.uuid4().hex}"
        rows = quarantine(records).withColumn("refused", F.col("reason").isNotNull())
        rows.observe(watch, F.count("*").alias("read"), F.count("reason").alias("refused")).write.partitionBy("refused").parquet(staged)
        counted = watch.get
        both = self.spark.read.schema(StructType([*rows.schema.fields])).parquet(staged)
        if counted["refused"]:
            both.filter("refused").drop("refused").withColumn("run_id", F.lit(run_id).cast("long")).write.mode("append").partitionBy("run_id").parquet(self.path("refused"))
        return both.filter("not refused").select(*records.columns), counted

    def load(self, pipeline: str, snapshots: DataFrame, records: DataFrame, run_id: int, at: int | None = None) -> dict[str, int]:
        """Both phases. A failure in the second one leaves the snapshots and a failed run, and no row in the fact."""
        at = at or now()
        self.begin(run_id, pipeline, snapshots, at)
        counted = {"read": 0, "refused": 0}
        try:
            accepted, counted = self.stage(run_id, records)
            self.merge(accepted, run_id, at)
        except Exception as e:
            self.log(run_id, pipeline, "failed", max(now(), at + 1), counted["read"], counted["refused"], str(e)[:500])
            raise
        self.log(run_id, pipeline, "success", max(now(), at + 1), counted["read"], counted["refused"])
        return counted

    def stream(self, batches: DataFrame, checkpoint: str) -> StreamingQuery:
        """Merges all micro-batches that are there and stops; each rewrites its own weeks only. A batch that comes again
        after a restart, or rows of an old week that come late, are upserts like any other."""

        def merge(batch: DataFrame, run: int) -> None:
            if not batch.isEmpty():
                self.merge(R.dedupe(batch), run)

        return batches.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
