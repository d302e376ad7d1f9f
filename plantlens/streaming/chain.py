"""The ingest chain: landed files -> bronze -> silver -> dimensions and statistics -> fact.

Four streaming steps, each with its own checkpoint. Bronze, silver and fact are append-only,
without state or shuffle. The third step merges what has arrived into the short tables, so that no
run reads what earlier ones have read. A run takes what has arrived since the last one and stops.
The checkpoint makes it safe to run again after a failure: finished micro-batches are not
repeated, an unfinished one is.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from plantlens import schemas
from plantlens.operators.dimensions import Dimensions, attribute_sets, dimensions_of_sets
from plantlens.operators.history import add_attribute_sets, add_statistics
from plantlens.operators.out_of_spec import parameter_stats
from plantlens.operators.parse import fact_rows, parse_lines
from plantlens.operators.quality import expectation_report, observe_expectations
from plantlens.plans.catalog import keep_open, point_short_tables, point_to_copies
from plantlens.plans.views import read_dimensions
from plantlens.session import require_utc
from plantlens.sources.compaction import FILE_BYTES, compact_table
from plantlens.sources.landing import stream_lines
from plantlens.sources.short_tables import batches_written, read_short_table, write_short_tables
from plantlens.sources.tables import (
    TableBounds,
    append_stream,
    read_stored,
    read_table,
    stream_table,
    triggered,
)
from plantlens.streaming.log import (
    Counts,
    ExpectationLogger,
    append_to_log,
    log_entries,
    logged_expectations,
    merge_log,
)

__all__ = ["compact", "finish", "follow", "ingest", "logged_expectations", "run"]


def start_bronze(
    spark: SparkSession,
    landing: str,
    lake: str,
    path_glob: str | None = None,
    every: str | None = None,
    archive: str | None = None,
    **bounds,
) -> StreamingQuery:
    """`bounds` are `max_files` or `max_bytes` of a micro-batch, here and below.

    Files are those of the folder or table that a step reads; a chain of steps takes `later_bounds`.
    """
    lines = stream_lines(spark, landing, path_glob, archive=archive, **bounds)
    return append_stream(lines, lake, schemas.BRONZE, every)


def start_silver(
    spark: SparkSession, lake: str, every: str | None = None, **bounds
) -> StreamingQuery:
    readings = parse_lines(stream_table(spark, lake, schemas.BRONZE, **bounds))
    return append_stream(_observed(readings, schemas.SILVER), lake, schemas.SILVER, every)


def start_fact(
    spark: SparkSession, lake: str, every: str | None = None, **bounds
) -> StreamingQuery:
    rows = fact_rows(stream_table(spark, lake, schemas.SILVER, **bounds))
    return append_stream(_observed(rows, schemas.FACT), lake, schemas.FACT, every)


def start_short_tables(
    spark: SparkSession,
    lake: str,
    every: str | None = None,
    **bounds,
) -> StreamingQuery:
    """Dimensions and statistics, replaced once per micro-batch of silver.

    They are made of those before and the readings of the batch, and kept under the batch's number,
    so a batch that is done again after a failure is not added twice. A registered lake is pointed
    to them.
    """

    def merge(arrived: DataFrame, batch_id: int) -> None:
        done = batches_written(spark, lake)
        if batch_id in done:
            return
        before = [number for number in done if number < batch_id]
        known = before[-1] if before else None
        _write_short_tables(
            arrived.sparkSession,
            lake,
            batch_id,
            add_attribute_sets(_known(arrived, lake, schemas.SETS, known), arrived),
            add_statistics(_known(arrived, lake, schemas.STATS, known), arrived),
        )

    readings = stream_table(spark, lake, schemas.SILVER, **bounds)
    writer = (
        readings.writeStream.foreachBatch(merge)
        .queryName("short_tables")
        .option("checkpointLocation", f"{lake.rstrip('/')}/_checkpoints/_short_tables")
    )
    return triggered(writer, every).start()


def _known(arrived: DataFrame, lake: str, spec: schemas.TableSpec, number: int | None) -> DataFrame:
    spark = arrived.sparkSession
    if number is None:
        return spark.createDataFrame([], spec.schema)
    return read_short_table(spark, lake, spec, number)


def _write_short_tables(
    spark: SparkSession, lake: str, number: int, sets: DataFrame, stats: DataFrame
) -> None:
    def dimensions_of(written: DataFrame) -> list[tuple[schemas.TableSpec, DataFrame]]:
        dims = dimensions_of_sets(written)
        return [
            (schemas.DIM_LINE, dims.line),
            (schemas.DIM_MACHINE, dims.machine),
            (schemas.DIM_DATE, dims.date),
            (schemas.DIM_STAGE, dims.stage),
        ]

    tables = [(schemas.STATS, stats), (schemas.SETS, sets)]
    write_short_tables(spark, lake, number, tables, dimensions_of)
    point_short_tables(spark, lake)


def _observed(df: DataFrame, spec: schemas.TableSpec) -> DataFrame:
    return observe_expectations(df, spec.name, spec.expectations)


def finish(query: StreamingQuery, poll_seconds: float = 0.5) -> Counts:
    """Wait for a query and add up the counters it observed, batch by batch.

    Only the latest batches are kept by the query, so they are gathered while it runs.
    """
    per_batch = _observed_batches(query, poll_seconds)
    totals: Counter = Counter()
    for _, counts in per_batch.values():
        totals.update({name: count or 0 for name, count in counts.items()})
    return dict(totals)


def _observed_batches(query: StreamingQuery, poll_seconds: float) -> dict[int, tuple[str, Counts]]:
    """Time and counters of each micro-batch of a query that runs until it has ended."""
    per_batch: dict[int, tuple[str, Counts]] = {}
    stopped = False
    while not stopped:
        stopped = query.awaitTermination(poll_seconds)
        for progress in query.recentProgress:
            for metrics in progress.observedMetrics.values():
                per_batch[progress.batchId] = (progress.timestamp, metrics.asDict())
    return per_batch


def later_bounds(spark: SparkSession, lake: str, **bounds) -> TableBounds:
    """Bounds of the steps after bronze, by the table that each one reads."""
    return TableBounds(spark, lake, (schemas.BRONZE, schemas.SILVER), **bounds)


def ingest(
    spark: SparkSession,
    landing: str,
    lake: str,
    path_glob: str | None = None,
    archive: str | None = None,
    **bounds,
) -> dict[str, Counts]:
    """Take one increment through all tables.

    Returns, for silver and fact, the rows appended and the rows that failed each expectation.
    The same counters go to the expectation log. Dimensions come before the fact, since the KPIs
    leave out fact rows whose dimension row is missing. `max_files` counts landed files; the later
    steps take what has become of about as many.
    """
    require_utc(spark)
    merge_log(spark, lake)
    later = later_bounds(spark, lake, **bounds)
    finish(start_bronze(spark, landing, lake, path_glob, archive=archive, **bounds))
    lines = later.of(schemas.BRONZE)
    silver = logged(spark, lake, schemas.SILVER, start_silver(spark, lake, **lines))
    readings = later.of(schemas.SILVER)
    finish(start_short_tables(spark, lake, **readings))
    fact = logged(spark, lake, schemas.FACT, start_fact(spark, lake, **readings))
    return {schemas.SILVER.name: silver, schemas.FACT.name: fact}


def logged(
    spark: SparkSession, lake: str, spec: schemas.TableSpec, query: StreamingQuery
) -> Counts:
    """Wait for a query, add its counters to the expectation log and return their sums."""
    run_id, entries, totals = str(query.runId), [], Counter()
    for batch_id, (time, counts) in _observed_batches(query, 0.5).items():
        entries += log_entries(spec.name, run_id, batch_id, time, counts)
        totals.update({name: count or 0 for name, count in counts.items()})
    append_to_log(spark, lake, entries)
    return dict(totals)


def follow(
    spark: SparkSession,
    landing: str,
    lake: str,
    path_glob: str | None = None,
    every: str = "5 seconds",
    archive: str | None = None,
    **bounds,
) -> list[StreamingQuery]:
    """Keep all tables, the KPIs by name and the expectation log up to date.

    This goes on until the returned queries are stopped. The backlog is taken first, which also
    makes sure that each step finds the table it reads. The names are views, computed when read.
    """
    run(spark, landing, lake, path_glob=path_glob, archive=archive, **bounds)
    later = later_bounds(spark, lake, **bounds)
    readings = later.of(schemas.SILVER)
    counted = [
        start_silver(spark, lake, every, **later.of(schemas.BRONZE)),
        start_fact(spark, lake, every, **readings),
    ]
    run_ids = {str(query.runId) for query in counted}
    spark.streams.addListener(ExpectationLogger(spark, lake, run_ids))
    return [
        start_bronze(spark, landing, lake, path_glob, every, archive=archive, **bounds),
        *counted,
        start_short_tables(spark, lake, every, **readings),
    ]


def rebuild_short_tables(spark: SparkSession, lake: str) -> Dimensions:
    """Dimensions and statistics from all of silver and the fact, for repair and comparison.

    The increments go on from what is built here, so no other step may run meanwhile.
    """
    require_utc(spark)
    done = batches_written(spark, lake)
    sets = attribute_sets(read_table(spark, lake, schemas.SILVER))
    stats = parameter_stats(read_table(spark, lake, schemas.FACT))
    number = done[-1] if done else 0
    _write_short_tables(spark, lake, number, sets, stats)
    return read_dimensions(spark, lake)


def run(spark: SparkSession, landing: str, lake: str, **options) -> dict[str, Counts]:
    """One increment; tables and KPIs by name then stand for it. Returns the counters."""
    counts = ingest(spark, landing, lake, **options)
    keep_open(spark, lake)
    return counts


def compact(
    spark: SparkSession,
    lake: str,
    tables: tuple[schemas.TableSpec, ...] = schemas.STREAMED,
    file_bytes: int = FILE_BYTES,
) -> dict[str, int]:
    """Copy what has been appended to streamed tables; the rows copied. Streams may go on."""
    copied = {}
    for spec in tables:
        stored = read_stored(spark, lake, spec)
        copied[spec.name] = compact_table(spark, lake, spec, stored, file_bytes)
        point_to_copies(spark, lake, spec)
    return copied


def stored_expectations(spark: SparkSession, lake: str, spec: schemas.TableSpec) -> DataFrame:
    """Expectations over everything stored in a table, whatever run it came from."""
    return expectation_report(read_table(spark, lake, spec), spec.expectations)
