"""The expectation log of a lake: counters per table, micro-batch and expectation.

A run writes its counters to the log once per table. Queries that go on write a small file per
table and micro-batch, in a folder for the hour. Once an hour and the next one are over, its files
are appended to the log as one and the folder goes, so files do not pile up: a day leaves 24 in the
log, and at most two hours' files wait beside it. Readers take both. Rows that are in both, because
an attempt to merge failed between its two steps, count once, as repeated micro-batches do.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from plantlens import schemas
from plantlens.plans.catalog import refresh
from plantlens.sources.files import delete_folder, names_in
from plantlens.sources.tables import read_table, table_path

Counts = dict[str, int]
HOUR = "%Y-%m-%dT%H"


def waiting_path(lake: str) -> str:
    return f"{lake.rstrip('/')}/_log_arrivals"


def log_entries(table: str, run_id: str, batch_id: int, time: str, counts: Counts) -> list[tuple]:
    rows = counts.get("rows") or 0
    return [
        (table, run_id, batch_id, time, rows, name, failed or 0)
        for name, failed in counts.items()
        if name != "rows"
    ]


def _rows(spark: SparkSession, entries: list[tuple]) -> DataFrame:
    types = {"batch_time": "string"}
    ddl = ", ".join(
        f"{f.name} {types.get(f.name, f.dataType.simpleString())}"
        for f in schemas.EXPECTATION_LOG_SCHEMA
    )
    rows = spark.createDataFrame(entries, ddl)
    return rows.withColumn("batch_time", F.to_timestamp("batch_time")).coalesce(1)


def append_to_log(spark: SparkSession, lake: str, entries: list[tuple]) -> None:
    """Add the counters of a run to the log: a few rows per table and micro-batch."""
    if entries:
        path = table_path(lake, schemas.EXPECTATION_LOG)
        _rows(spark, entries).write.mode("append").parquet(path)


def append_arrivals(
    spark: SparkSession, lake: str, entries: list[tuple], now: datetime | None = None
) -> None:
    """Add the counters of one micro-batch to the files of the hour; merge hours that are over."""
    if not entries:
        return
    now = now or datetime.now(timezone.utc)
    _rows(spark, entries).write.mode("append").parquet(f"{waiting_path(lake)}/{now:{HOUR}}")
    merge_log(spark, lake, now)


def merge_log(spark: SparkSession, lake: str, now: datetime | None = None) -> None:
    """Move the hours before the last one into the log, one file each.

    The last hour stays, for readers that were planned while it was the present one.
    """
    now = now or datetime.now(timezone.utc)
    last = f"{now - timedelta(hours=1):{HOUR}}"
    for hour in names_in(spark, waiting_path(lake)):
        if hour < last:
            folder = f"{waiting_path(lake)}/{hour}"
            rows = spark.read.schema(schemas.EXPECTATION_LOG.schema).parquet(folder)
            path = table_path(lake, schemas.EXPECTATION_LOG)
            rows.coalesce(1).write.mode("append").parquet(path)
            delete_folder(spark, folder)


def read_log(spark: SparkSession, lake: str) -> DataFrame:
    """The log and the counters that wait to be merged into it; a row may be there twice."""
    log = read_table(spark, lake, schemas.EXPECTATION_LOG)
    hours = [f"{waiting_path(lake)}/{hour}" for hour in names_in(spark, waiting_path(lake))]
    if not hours:
        return log
    return log.unionByName(spark.read.schema(log.schema).parquet(*hours))


class ExpectationLogger(StreamingQueryListener):
    """Writes the counters of running queries to the expectation log, batch by batch."""

    def __init__(self, spark: SparkSession, lake: str, run_ids: set[str]):
        self.spark, self.lake, self.run_ids = spark, lake, run_ids

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        if str(progress.runId) not in self.run_ids or not progress.numInputRows:
            return
        for table, metrics in progress.observedMetrics.items():
            entries = log_entries(
                table, str(progress.runId), progress.batchId, progress.timestamp, metrics.asDict()
            )
            append_arrivals(self.spark, self.lake, entries)
        refresh(self.spark, self.lake)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def logged_expectations(spark: SparkSession, lake: str) -> DataFrame:
    """Rows and failed rows per table and expectation over all logged micro-batches.

    A micro-batch that was done again after a failure counts once, as it was done last.
    """
    log = read_log(spark, lake)
    last = log.groupBy("table_name", "batch_id", "expectation").agg(
        F.max_by(F.struct("rows", "failed"), "batch_time").alias("last")
    )
    return last.groupBy("table_name", "expectation").agg(
        F.sum("last.rows").alias("rows"), F.sum("last.failed").alias("failed")
    )
