"""Stored tables: parquet folders below the folder of the lake.

Streamed tables grow by appends, in one folder each, by day of loading, and may have compacted copies
beside it, see `sources.compaction`. Short tables are replaced together, see `sources.short_tables`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plantlens.schemas import LOAD_DAY, SHORT, TableSpec
from plantlens.sources.compaction import with_copies
from plantlens.sources.files import count_files, exists, make_folder, names_in
from plantlens.sources.landing import REMEMBER_FILES_FOR, bounded
from plantlens.sources.short_tables import read_short_table


def table_path(lake: str, spec: TableSpec) -> str:
    return f"{lake.rstrip('/')}/{spec.name}"


def checkpoint_path(lake: str, spec: TableSpec) -> str:
    return f"{lake.rstrip('/')}/_checkpoints/{spec.name}"


def read_table(spark: SparkSession, lake: str, spec: TableSpec) -> DataFrame:
    """Snapshot of a table. The schema is given, so partition values keep their types."""
    if spec in SHORT:
        return read_short_table(spark, lake, spec)
    if not exists(spark, table_path(lake, spec)):
        return spark.createDataFrame([], spec.schema)
    stored = read_stored(spark, lake, spec)
    if not spec.loaded:
        return stored.select(*spec.schema.names)
    return with_copies(spark, lake, spec, stored)


def read_stored(spark: SparkSession, lake: str, spec: TableSpec) -> DataFrame:
    """A table as it is laid out, without its compacted copies."""
    return spark.read.schema(spec.stored_schema).parquet(table_path(lake, spec))


def laid_out(df: DataFrame, spec: TableSpec) -> DataFrame:
    return df.withColumn(LOAD_DAY, F.to_date(spec.loaded)) if spec.loaded else df


def stream_table(
    spark: SparkSession,
    lake: str,
    spec: TableSpec,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Rows appended to a table since the reader's checkpoint."""
    reader = spark.readStream.schema(spec.stored_schema).option("maxFileAge", REMEMBER_FILES_FOR)
    rows = bounded(reader, max_files, max_bytes).parquet(table_path(lake, spec))
    return rows.select(*spec.schema.names)


class TableBounds:
    """Bounds of the micro-batches that read stored tables, made of those of the landed files.

    `max_files` counts landed files. Tasks and partitions make many files of one, the more the larger
    it is, so as many files of a table are taken at once as one micro-batch has written: on average
    since this object was made, or over all if nothing was written since. What follows a table then
    has about as many micro-batches as the table itself, however many files they hold.
    """

    def __init__(
        self, spark: SparkSession, lake: str, specs: tuple[TableSpec, ...], **bounds
    ):
        self.spark, self.lake, self.bounds = spark, lake, bounds
        self.before = {spec.name: self._appended(spec) for spec in specs} if self._by_files else {}

    @property
    def _by_files(self) -> bool:
        return bool(self.bounds.get("max_files"))

    def _appended(self, spec: TableSpec) -> tuple[int, int]:
        """Files and micro-batches that a stream has appended to a table."""
        path = table_path(self.lake, spec)
        files = count_files(self.spark, path) - count_files(self.spark, f"{path}/_spark_metadata")
        done = names_in(self.spark, f"{checkpoint_path(self.lake, spec)}/commits")
        return files, max((int(name) + 1 for name in done if name.isdigit()), default=0)

    def of(self, spec: TableSpec) -> dict[str, int]:
        """The bounds for a stream that reads this table now."""
        if not self._by_files:
            return self.bounds
        files, batches = self._appended(spec)
        files_before, batches_before = self.before[spec.name]
        if batches > batches_before:
            files, batches = files - files_before, batches - batches_before
        written = -(-files // max(1, batches))
        return {**self.bounds, "max_files": max(self.bounds["max_files"], written)}


def triggered(writer, every: str | None):
    """Take what is there and stop, or go on at an interval such as "5 seconds"."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def append_stream(
    df: DataFrame, lake: str, spec: TableSpec, every: str | None = None
) -> StreamingQuery:
    """Append what has arrived to a table; progress is kept in a checkpoint of the lake.

    Without `every` the query takes what is there and stops. With it, for instance
    "5 seconds", it goes on until it is stopped.
    """
    writer = (
        laid_out(df, spec).writeStream.format("parquet")
        .outputMode("append")
        .queryName(spec.name)
        .option("checkpointLocation", checkpoint_path(lake, spec))
    )
    writer = triggered(writer, every)
    if spec.stored_partitions:
        writer = writer.partitionBy(*spec.stored_partitions)
    return writer.start(table_path(lake, spec))


def overwrite_table(df: DataFrame, lake: str, spec: TableSpec) -> None:
    """Write a streamed table from a batch, where no stream writes it."""
    writer = laid_out(df.select(*spec.schema.names), spec).write.mode("overwrite")
    if spec.stored_partitions:
        writer = writer.partitionBy(*spec.stored_partitions)
    writer.parquet(table_path(lake, spec))


def register_table(
    spark: SparkSession, lake: str, spec: TableSpec, database: str, path: str | None = None
) -> str:
    """Make a stored table known to the catalog, with its comment and properties."""
    name = f"{database}.{spec.name}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spec.stored_schema)
    parts = spec.stored_partitions
    partitions = f"PARTITIONED BY ({', '.join(parts)})" if parts else ""
    properties = ", ".join(f"'{k}' = '{v}'" for k, v in spec.properties.items())
    place = path or table_path(lake, spec)
    make_folder(spark, place)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet {partitions} "
        f"LOCATION '{place}' COMMENT '{spec.comment}' TBLPROPERTIES ({properties})"
    )
    # Tables written by a stream list their own files and need no partitions in the catalog.
    if not exists(spark, f"{place}/_spark_metadata"):
        if any(column.isPartition for column in spark.catalog.listColumns(name)):
            spark.catalog.recoverPartitions(name)
    return name
