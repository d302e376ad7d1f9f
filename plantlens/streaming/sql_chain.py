"""The ingest chain in SQL: each step is a query over a streaming view.

What has arrived in a table is a streaming temporary view, `<table>_arrivals`; landed lines are
`landed_lines`, with the text in `value` and the file in `_metadata`. A step runs its query over the
view of the step before and appends the rows to its table, under the checkpoint of that table. So
lakes made in SQL and by `streaming.chain` are the same, and either may go on with the other's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from plantlens import schemas
from plantlens.functions.sql import create_functions, text
from plantlens.operators.quality import observe_expectations
from plantlens.schemas import TableSpec
from plantlens.session import require_utc
from plantlens.sources.landing import REMEMBER_FILES_FOR, bounded
from plantlens.sources.tables import append_stream, stream_table
from plantlens.streaming.chain import finish, later_bounds, logged, start_short_tables
from plantlens.streaming.log import Counts, merge_log

LANDED = "landed_lines"


def arrivals(spec: TableSpec) -> str:
    return f"{spec.name}_arrivals"


def _fields() -> str:
    """The columns of a reading, its time parsed; a malformed time is NULL."""
    return ",\n  ".join(
        "try_to_timestamp(reading.`timestamp`) AS event_timestamp"
        if name == "timestamp"
        else f"reading.{name}"
        for name in schemas.READING_SCHEMA.names
    )


_READING_DDL = ", ".join(
    f"`{field.name}` {field.dataType.simpleString()}" for field in schemas.READING_SCHEMA
)

BRONZE_SQL = f"""
SELECT value AS raw_content,
  _metadata.file_path AS _source_file,
  _metadata.file_modification_time AS _source_file_timestamp,
  _metadata.file_size AS _source_file_size,
  current_timestamp() AS _ingested_at
FROM {LANDED}"""

SILVER_SQL = f"""
SELECT {_fields()},
  _source_file,
  current_timestamp() AS _loaded_at
FROM (SELECT from_json(raw_content, {text(_READING_DDL)}) AS reading, _source_file
  FROM {arrivals(schemas.BRONZE)})"""

FACT_SQL = f"""
SELECT record_id, event_timestamp, date_key_of(event_timestamp) AS date_key,
  hour(event_timestamp) AS hour_of_day, plant_id, line_id, machine_id, process_stage, is_anomaly,
  parameter_name, parameter_value, _source_file, current_timestamp() AS _loaded_at
FROM {arrivals(schemas.SILVER)}
LATERAL VIEW explode(telemetry) AS parameter_name, parameter_value"""


def landed_view(
    spark: SparkSession, landing: str, path_glob: str | None = None, **bounds
) -> DataFrame:
    """The lines of files that have landed, as the streaming view `landed_lines`."""
    options = {"recursiveFileLookup": "true", "maxFileAge": REMEMBER_FILES_FOR}
    if path_glob:
        options["pathGlobFilter"] = path_glob
    reader = bounded(
        spark.readStream.options(**options),
        bounds.get("max_files"),
        bounds.get("max_bytes"),
    )
    lines = reader.text(landing).select("value", "_metadata")
    lines.createOrReplaceTempView(LANDED)
    return lines


def arrivals_view(spark: SparkSession, lake: str, spec: TableSpec, **bounds) -> DataFrame:
    """What is appended to a table, as the streaming view `<table>_arrivals`."""
    rows = stream_table(spark, lake, spec, **bounds)
    rows.createOrReplaceTempView(arrivals(spec))
    return rows


def append_sql(
    spark: SparkSession, lake: str, spec: TableSpec, sql: str, every: str | None = None
) -> StreamingQuery:
    """Append the rows of a query over streaming views to a table, its expectations counted.

    The query must give the columns of the table by name; anything else is refused before it runs.
    """
    rows = spark.sql(sql)
    if not rows.isStreaming:
        raise ValueError(f"the query for {spec.name} reads no streaming view")
    wanted, given = set(spec.schema.names), set(rows.columns)
    if wanted != given or len(rows.columns) != len(given):
        raise ValueError(f"the query for {spec.name} gives {rows.columns}, not {spec.schema.names}")
    types = {f.name: f.dataType for f in rows.schema}
    wrong = [f.name for f in spec.schema if f.dataType != types[f.name]]
    if wrong:
        raise ValueError(f"the query for {spec.name} gives other types of {wrong}")
    rows = rows.select(*spec.schema.names)
    if spec.expectations:
        rows = observe_expectations(rows, spec.name, spec.expectations)
    return append_stream(rows, lake, spec, every)


def ingest_sql(
    spark: SparkSession,
    landing: str,
    lake: str,
    path_glob: str | None = None,
    bronze_sql: str = BRONZE_SQL,
    silver_sql: str = SILVER_SQL,
    fact_sql: str = FACT_SQL,
    **bounds,
) -> dict[str, Counts]:
    """One increment, as `chain.ingest` takes it, with the three steps given in SQL."""
    require_utc(spark)
    merge_log(spark, lake)
    create_functions(spark)
    later = later_bounds(spark, lake, **bounds)
    landed_view(spark, landing, path_glob, **bounds)
    finish(append_sql(spark, lake, schemas.BRONZE, bronze_sql))
    arrivals_view(spark, lake, schemas.BRONZE, **later.of(schemas.BRONZE))
    silver = logged(
        spark, lake, schemas.SILVER, append_sql(spark, lake, schemas.SILVER, silver_sql)
    )
    readings = later.of(schemas.SILVER)
    finish(start_short_tables(spark, lake, **readings))
    arrivals_view(spark, lake, schemas.SILVER, **readings)
    fact = logged(spark, lake, schemas.FACT, append_sql(spark, lake, schemas.FACT, fact_sql))
    return {schemas.SILVER.name: silver, schemas.FACT.name: fact}
