"""Compacted copies of streamed tables: few large files, clustered for the KPIs.

Every row carries the time of the micro-batch that loaded it. A compaction copies the rows loaded
since the last one, up to the newest load time stored, into a folder named by that time; readers take
all copies and, from the table itself, the rows loaded later. So the bound is all that a reader needs
to know: no list of files is made or compared. Micro-batches of a table follow each other and are
committed whole by Spark's log of the sink, so that no row of an earlier load time can come later, as
long as the clock of the writer does not step back. Tables are laid out by day of loading, so that
days behind the bound are not opened at all.

The table itself is never touched: streams that write or read it go on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.schemas import LOAD_DAY, TableSpec
from plantlens.sources.files import exists, names_in

FILE_BYTES = 512 << 20
# Rows of a parameter and machine lie together, so that row groups without them are skipped.
CLUSTERED_BY = {"gold_fact_telemetry": ["parameter_name", "machine_id", "event_timestamp"]}


def copies_folder(lake: str, spec: TableSpec) -> str:
    return f"{lake.rstrip('/')}/_compacted/{spec.name}"


def copy_paths(spark: SparkSession, lake: str, spec: TableSpec) -> dict[int, str]:
    """Finished copies by the load time, in microseconds, up to which each one goes."""
    folder = copies_folder(lake, spec)
    paths = {int(n.removeprefix("upto=")): f"{folder}/{n}" for n in names_in(spark, folder)}
    return {upto: p for upto, p in sorted(paths.items()) if exists(spark, f"{p}/_SUCCESS")}


def loaded_after(spec: TableSpec, bound: int) -> Column:
    """Rows that no copy up to `bound` holds, with the days before it pruned."""
    time = F.timestamp_micros(F.lit(bound))
    recent = F.col(LOAD_DAY).isNull() | (F.col(LOAD_DAY) >= F.to_date(time))
    return recent & F.coalesce(F.col(spec.loaded) > time, F.lit(True))


def with_copies(spark: SparkSession, lake: str, spec: TableSpec, stored: DataFrame) -> DataFrame:
    """The rows of a stored table, those that have been copied from the copies."""
    copies = copy_paths(spark, lake, spec)
    if not copies:
        return stored.select(*spec.schema.names)
    copied = spark.read.schema(spec.schema).parquet(*copies.values())
    later = stored.where(loaded_after(spec, max(copies)))
    return copied.unionByName(later.select(*spec.schema.names))


def compact_table(
    spark: SparkSession, lake: str, spec: TableSpec, stored: DataFrame, file_bytes: int = FILE_BYTES
) -> int:
    """Copy the rows of `stored` that no copy holds yet; returns their number.

    One range shuffle by the columns that cluster the table, or by its partition columns, into files
    of about `file_bytes`.
    """
    copies = copy_paths(spark, lake, spec)
    fresh = stored.where(loaded_after(spec, max(copies))) if copies else stored
    newest = fresh.agg(F.unix_micros(F.max(spec.loaded))).first()[0]
    if newest is None:
        return 0
    rows = fresh.where(F.col(spec.loaded) <= F.timestamp_micros(F.lit(newest)))
    size = int(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    n_files = max(1, -(-size // file_bytes))
    order = CLUSTERED_BY.get(spec.name) or [*spec.partition_by, spec.loaded]
    path = f"{copies_folder(lake, spec)}/upto={newest}"
    dealt = rows.select(*spec.schema.names).repartitionByRange(n_files, *order)
    # A folder of that name without success marker is what a failed attempt has left.
    dealt.sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
    return spark.read.schema(spec.schema).parquet(path).count()
