"""A stored lake in the catalog: tables with comments and properties, and the KPIs as views.

The views are catalog views in SQL over the registered tables. They hold no files and no figures: each
query computes from what is stored then, in any session that shares the catalog. Streamed tables are
read through a view `<table>_now`, which takes compacted rows from their copies; a compaction replaces
that view in one step. Short tables are pointed to their newest folder by their location.

In the views the fact meets the dimensions before it is grouped. The dimensions are short, Spark
broadcasts them by their size, and groups are summed on the map side first. Readings are counted in two
steps, the record id being part of the first key, so that a large group is spread over all tasks.

A session that was not made by `session.build_session` may keep the file list of a table it has read;
`REFRESH TABLE` drops it, which `run` and `follow` do for their own session.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import SparkSession

from plantlens import schemas
from plantlens.functions.measures import SIGMA_LIMIT
from plantlens.functions.sql import create_functions
from plantlens.plans.kpis import POWER, VIBRATION
from plantlens.schemas import LOAD_DAY, TableSpec
from plantlens.sources.compaction import copy_paths
from plantlens.sources.short_tables import short_table_path
from plantlens.sources.tables import register_table

COMMENTS = {
    "mv_anomaly_rate": "Flagged share of readings per line, machine and hour",
    "mv_vibration_trend": "Hourly vibration per machine; a rise points to wear",
    "mv_parameter_stability": "Hourly coefficient of variation per machine and parameter",
    "mv_process_stage_anomaly_rate": "Flagged share of readings per stage category and day",
    "mv_power_consumption": "Hourly power per machine; a drift points to trouble",
    "mv_hourly_anomaly_heatmap": "Flagged readings per line, hour and shift",
    "mv_parameter_out_of_spec": "Daily share of values beyond two deviations of their series",
}

# The session's setting that holds the database of the lake that is open.
OPEN_LAKE = "plantlens.open_lake"

# Readings with parameters, with the keys of the fact. `{db}` is the database of the lake.
_READINGS = """
  SELECT record_id, line_id, machine_id, process_stage, is_anomaly, size(telemetry) AS parameters,
    year(event_timestamp) * 10000 + month(event_timestamp) * 100 + dayofmonth(event_timestamp) AS date_key,
    hour(event_timestamp) AS hour_of_day
  FROM {db}.silver_telemetry_now WHERE size(telemetry) > 0"""
_PER_READING = """bool_or(is_anomaly) AS flagged, sum(if(is_anomaly, parameters, 0)) AS flagged_parameters"""
_COUNTS = """count(record_id) AS total_readings,
    count(CASE WHEN flagged THEN record_id END) AS anomaly_readings,
    sum(flagged_parameters) AS flagged_parameters"""
_RATE = "round({part} * 100.0 / nullif({whole}, 0), 2)"
_ANOMALY_RATE = _RATE.format(part="anomaly_readings", whole="total_readings")


def _counted(keys: str, readings: str = f"({_READINGS})") -> str:
    return f"""(SELECT {keys}, {_COUNTS} FROM (
    SELECT {keys}, record_id, {_PER_READING} FROM {readings} GROUP BY {keys}, record_id)
  GROUP BY {keys})"""


def _hourly(parameter: str, digits: int, names: str, keys: str) -> str:
    mean, high, low, sd = names.split()
    return f"""
SELECT {keys},
  round(avg(f.parameter_value), {digits}) AS {mean}, round(max(f.parameter_value), {digits}) AS {high},
  round(min(f.parameter_value), {digits}) AS {low}, round(stddev_samp(f.parameter_value), {digits}) AS {sd},
  count(*) AS reading_count
FROM {{db}}.gold_fact_telemetry_now f
JOIN {{db}}.gold_dim_production_line l ON f.line_id = l.line_id
JOIN {{db}}.gold_dim_machine m ON f.machine_id = m.machine_id
WHERE f.parameter_name = '{parameter}'
GROUP BY {keys}"""


VIEW_SQL = {
    "mv_anomaly_rate": f"""
SELECT c.line_id, line_name, product_type, c.machine_id, machine_type, date_key, hour_of_day,
  total_readings, anomaly_readings, {_ANOMALY_RATE} AS anomaly_rate_pct
FROM {_counted("line_id, machine_id, date_key, hour_of_day")} c
JOIN (SELECT DISTINCT line_id, line_name, product_type FROM {{db}}.gold_dim_production_line) l
  ON c.line_id = l.line_id
JOIN (SELECT DISTINCT machine_id, machine_type FROM {{db}}.gold_dim_machine) m
  ON c.machine_id = m.machine_id""",
    "mv_vibration_trend": _hourly(
        VIBRATION,
        6,
        "avg_vibration_mm_s_rms max_vibration_mm_s_rms min_vibration_mm_s_rms stddev_vibration",
        "f.line_id, l.line_name, f.machine_id, m.machine_type, m.process_stage, f.date_key, f.hour_of_day",
    ),
    "mv_parameter_stability": """
SELECT f.line_id, f.machine_id, m.machine_type, s.stage_category, f.parameter_name, f.date_key,
  f.hour_of_day, round(avg(f.parameter_value), 6) AS mean_value,
  round(stddev_samp(f.parameter_value), 6) AS stddev_value,
  round(CASE WHEN abs(avg(f.parameter_value)) > 0
    THEN stddev_samp(f.parameter_value) / abs(avg(f.parameter_value)) END, 6) AS stability_index,
  count(*) AS reading_count
FROM {db}.gold_fact_telemetry_now f
JOIN {db}.gold_dim_machine m ON f.machine_id = m.machine_id
JOIN {db}.gold_dim_process_stage s ON f.process_stage = s.process_stage
GROUP BY f.line_id, f.machine_id, m.machine_type, s.stage_category, f.parameter_name, f.date_key,
  f.hour_of_day""",
    "mv_process_stage_anomaly_rate": f"""
SELECT stage_category, stage_sequence, c.line_id, product_type, date_key, total_readings,
  anomaly_readings, {_ANOMALY_RATE} AS anomaly_rate_pct
FROM {_counted(
    "stage_category, stage_sequence, line_id, date_key",
    f'''(SELECT r.*, stage_category, stage_sequence FROM ({_READINGS}) r
      JOIN (SELECT DISTINCT process_stage, stage_category, stage_sequence
            FROM {{db}}.gold_dim_process_stage) s ON r.process_stage = s.process_stage)''',
)} c
JOIN (SELECT DISTINCT line_id, product_type FROM {{db}}.gold_dim_production_line) l
  ON c.line_id = l.line_id""",
    "mv_power_consumption": _hourly(
        POWER,
        4,
        "avg_power_kw max_power_kw min_power_kw stddev_power_kw",
        "f.line_id, l.line_name, l.product_type, f.machine_id, m.machine_type, f.date_key, f.hour_of_day",
    ),
    "mv_hourly_anomaly_heatmap": f"""
SELECT c.line_id, line_name, product_type, date_key, hour_of_day,
  CASE WHEN hour_of_day BETWEEN 6 AND 13 THEN 'Day' WHEN hour_of_day BETWEEN 14 AND 21 THEN 'Swing'
    ELSE 'Night' END AS shift,
  total_readings, anomaly_readings, {_ANOMALY_RATE} AS anomaly_rate_pct,
  flagged_parameters * weight AS anomaly_param_violations
FROM {_counted("line_id, date_key, hour_of_day")} c
JOIN (SELECT line_id, line_name, product_type, count(*) AS weight
      FROM {{db}}.gold_dim_production_line GROUP BY ALL) l ON c.line_id = l.line_id""",
    "mv_parameter_out_of_spec": f"""
SELECT f.line_id, d.machine_type, f.machine_id, d.stage_category, f.parameter_name, f.date_key,
  round(first(t.overall_mean), 6) AS param_mean, round(first(t.overall_stddev), 6) AS param_stddev,
  count(*) AS total_readings,
  sum(int(coalesce(abs(f.parameter_value - t.overall_mean) > {SIGMA_LIMIT} * t.overall_stddev, false)))
    AS out_of_spec_count,
  {_RATE.format(
    part=f"sum(int(coalesce(abs(f.parameter_value - t.overall_mean) > {SIGMA_LIMIT} * t.overall_stddev, false)))",
    whole="count(*)",
)} AS out_of_spec_rate_pct
FROM {{db}}.gold_fact_telemetry_now f
JOIN {{db}}.gold_parameter_stats t
  ON f.machine_id = t.machine_id AND f.parameter_name = t.parameter_name AND t.overall_stddev > 0
JOIN (SELECT m.machine_id, m.machine_type, s.stage_category
      FROM {{db}}.gold_dim_machine m JOIN {{db}}.gold_dim_process_stage s
        ON m.process_stage = s.process_stage) d ON f.machine_id = d.machine_id
GROUP BY f.line_id, d.machine_type, f.machine_id, d.stage_category, f.parameter_name, f.date_key""",
}


def database_of(lake: str) -> str:
    """The database of a lake, unless another one is given."""
    return f"lake_{hashlib.md5(lake.rstrip('/').encode()).hexdigest()[:12]}"


def register_lake(spark: SparkSession, lake: str, database: str | None = None) -> list[str]:
    """Tables, KPIs and functions of a lake in the catalog; returns the names of the tables.

    May be called again at any time; what is there already stays, and views are replaced.
    """
    db = database or database_of(lake)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{lake.rstrip('/')}/_catalog'")
    create_functions(spark, db)
    names = []
    for spec in schemas.TABLES:
        path = short_table_path(spark, lake, spec) if spec in schemas.SHORT else None
        names.append(register_table(spark, lake, spec, db, path))
    point_short_tables(spark, lake, db)
    for spec in schemas.STREAMED:
        point_to_copies(spark, lake, spec, db)
    for name, sql in VIEW_SQL.items():
        comment = COMMENTS[name].replace("'", "''")
        spark.sql(f"CREATE OR REPLACE VIEW {db}.{name} COMMENT '{comment}' AS {sql.format(db=db)}")
    refresh(spark, lake, db)
    return names


def point_short_tables(spark: SparkSession, lake: str, database: str | None = None) -> None:
    """Let the short tables of a registered lake stand for their newest state, in one step each."""
    db = database or database_of(lake)
    if not spark.catalog.databaseExists(db):
        return
    for spec in schemas.SHORT:
        path = short_table_path(spark, lake, spec)
        if path and spark.catalog.tableExists(f"{db}.{spec.name}"):
            spark.sql(f"ALTER TABLE {db}.{spec.name} SET LOCATION '{path}'")


def point_to_copies(
    spark: SparkSession, lake: str, spec: TableSpec, database: str | None = None
) -> None:
    """Let `<table>_now` take from the compacted copies what they hold, and the rest from the table."""
    db = database or database_of(lake)
    if not spark.catalog.databaseExists(db):
        return
    columns = ", ".join(f"`{name}`" for name in spec.schema.names)
    copies = copy_paths(spark, lake, spec)
    parts = [f"SELECT {columns} FROM parquet.`{path}`" for path in copies.values()]
    later = ""
    if copies:
        time = f"timestamp_micros({max(copies)})"
        later = (
            f" WHERE ({LOAD_DAY} IS NULL OR {LOAD_DAY} >= to_date({time}))"
            f" AND coalesce({spec.loaded} > {time}, true)"
        )
    parts.append(f"SELECT {columns} FROM {db}.{spec.name}{later}")
    spark.sql(f"CREATE OR REPLACE VIEW {db}.{spec.name}_now AS {' UNION ALL '.join(parts)}")


def refresh(spark: SparkSession, lake: str, database: str | None = None) -> None:
    """Drop what this session remembers of the files of a registered lake."""
    db = database or database_of(lake)
    if spark.catalog.databaseExists(db):
        for spec in schemas.TABLES:
            spark.sql(f"REFRESH TABLE {db}.{spec.name}")


def keep_open(spark: SparkSession, lake: str) -> None:
    """Open a lake, if it is not the one this session has open, and see its newest files."""
    if spark.conf.get(OPEN_LAKE, "") == database_of(lake):
        refresh(spark, lake)
    else:
        open_lake(spark, lake)


def open_lake(spark: SparkSession, lake: str, database: str | None = None) -> list[str]:
    """Register a lake and let its names and functions stand without the database in this session.

    The short names are temporary views in SQL, resolved when read, so they never have to be made again.
    """
    db = database or database_of(lake)
    register_lake(spark, lake, db)
    spark.conf.set(OPEN_LAKE, db)
    create_functions(spark)
    streamed = {spec.name for spec in schemas.STREAMED}
    names = [*(spec.name for spec in schemas.TABLES), *VIEW_SQL]
    for name in names:
        source = f"{name}_now" if name in streamed else name
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT * FROM {db}.{source}")
    comments = spark.createDataFrame(list(COMMENTS.items()), "name string, comment string")
    comments.createOrReplaceTempView("kpi_comments")
    return names
