"""Versioned tables: a state is staged, checked and published; runs are logged whatever becomes of the data."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN = "run_id string, pipeline_name string, status string, at_micros long, records_read long, records_written long, error_message string"


class Store:
    """Tables under a root folder; each version has a folder, and the log of publications names the current one."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self, name: str) -> str:
        return f"{self.root}/_log/{name}"

    def _exists(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)

    def version(self, table: str) -> str | None:
        if not self._exists(self._log("published")):
            return None
        row = self.spark.read.parquet(self._log("published")).filter(F.col("table") == table).agg(F.max_by("version", "seq")).first()
        return row[0]

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{table}/{self.version(table)}")

    def stage(self, table: str, df: DataFrame) -> str:
        """Writes a version that nobody reads yet."""
        version = uuid.uuid4().hex
        df.write.parquet(f"{self.root}/{table}/{version}")
        return version

    def publish(self, versions: dict[str, str], read: dict[str, str | None] | None = None) -> None:
        """Makes staged versions current, all at once: one file is added to the log. ``read`` names the versions
        that they were made from; if one is not current any more, nothing is published."""
        stale = [t for t, v in (read or {}).items() if self.version(t) != v]
        if stale:
            raise ValueError(f"changed since they were read: {', '.join(stale)}")
        seq = time.time_ns()
        rows = [(t, v, seq) for t, v in versions.items()]
        self.spark.createDataFrame(rows, "table string, version string, seq long").coalesce(1).write.mode("append").parquet(self._log("published"))

    def backup(self, to: str, stamp: str, keep: int = 3) -> list[str]:
        """Copies the current version of every table to ``to``/``stamp`` and removes all but the last copies, by name;
        gives the names of those that are left. A copy counts once its list of tables is written."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        log = self.spark.read.parquet(self._log("published"))
        tables = sorted(r["table"] for r in log.select("table").distinct().collect())  # a row for each table
        for t in tables:
            self.read(t).write.mode("overwrite").parquet(f"{to}/{stamp}/{t}")
        self.spark.createDataFrame([(t,) for t in tables], "table string").coalesce(1).write.mode("overwrite").json(f"{to}/{stamp}/_tables")
        root = jvm.org.apache.hadoop.fs.Path(to)
        files = root.getFileSystem(conf)
        names = sorted(x.getPath().getName() for x in files.listStatus(root) if files.exists(jvm.org.apache.hadoop.fs.Path(x.getPath(), "_tables")))
        for name in names[:-keep]:
            files.delete(jvm.org.apache.hadoop.fs.Path(root, name), True)
        return names[-keep:]

    def log_run(self, *row) -> None:
        self.spark.createDataFrame([row], RUN).write.mode("append").parquet(self._log("runs"))

    def runs(self) -> DataFrame:
        """The last state of each run."""
        rows = self.spark.read.parquet(self._log("runs"))
        return rows.groupBy("run_id").agg(F.max_by(F.struct(*[c for c in rows.columns if c != "run_id"]), "at_micros").alias("x")).select("run_id", "x.*")

    def load(self, pipeline: str, records: DataFrame, change: Callable[[DataFrame], dict[str, DataFrame]], check: Callable[[dict[str, DataFrame]], DataFrame] | None = None, dry_run: bool = False) -> int:
        """Runs ``change`` on the records and publishes the tables that it gives, if ``check`` (name, n) finds nothing.

        A dry run writes nothing. A failure leaves the data as it was and a failed run in the log.
        """
        if dry_run:
            return 0
        run, now = uuid.uuid4().hex, lambda: time.time_ns() // 1000
        read = records.count()
        self.log_run(run, pipeline, "running", now(), read, 0, None)
        try:
            changed = change(records)
            was = {t: self.version(t) for t in changed}
            versions = {t: self.stage(t, df) for t, df in changed.items()}
            staged = {t: self.spark.read.parquet(f"{self.root}/{t}/{v}") for t, v in versions.items()}
            broken = check(staged).filter("n > 0").collect() if check else []  # a row for each constraint
            if broken:
                raise ValueError("; ".join(f"{r['name']}: {r['n']}" for r in broken))
            self.publish(versions, was)
            written = sum(df.count() for df in staged.values())
        except Exception as e:
            self.log_run(run, pipeline, "failed", now(), read, 0, str(e)[:500])
            raise
        self.log_run(run, pipeline, "success", now(), read, written, None)
        return read
