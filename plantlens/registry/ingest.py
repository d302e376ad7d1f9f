"""Sources, sinks and the streaming chain, over the readings landed as JSON lines."""

from __future__ import annotations

import time
import uuid

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens import schemas
from plantlens.operators.parse import parse_lines
from plantlens.registry.bindings import (
    damaged_lines,
    dimensions,
    first_delivery,
    landing,
    second_delivery,
    silver,
)
from plantlens.registry.checks import DAMAGED_FACT, FACT_FAILURES, SILVER_FAILURES
from plantlens.registry.core import query
from plantlens.registry.oracle import WITH
from plantlens.plans.catalog import VIEW_SQL, database_of, register_lake
from plantlens.plans.views import VIEWS, read_dimensions
from plantlens.registry.products import KPI_SQL, SILVER_SQL, flat_silver, with_double_rates
from plantlens.session import shared_dir, use_utc
from plantlens.sources.export import export_json_lines
from plantlens.sources.files import names_in, set_modified
from plantlens.sources.short_tables import read_short_table, write_short_tables
from plantlens.sources.landing import read_json_inferred, read_lines
from plantlens.sources.tables import overwrite_table, read_table
from plantlens.streaming.chain import (
    compact,
    finish,
    ingest,
    logged_expectations,
    run,
    start_bronze,
    start_fact,
    start_silver,
    stored_expectations,
)
from plantlens.streaming.hourly import hourly_kpis, start_hourly
from plantlens.streaming.sql_chain import ingest_sql

# Rows and failures of every expectation, from three places that must agree.
_EXPECTED = " UNION ALL ".join(
    [
        f"SELECT 'silver_telemetry' AS table_name, '{name}' AS expectation, count(*) AS rows, "
        f"count(*) FILTER ({failing}) AS failed FROM silver"
        for name, failing in SILVER_FAILURES.items()
    ]
    + [
        f"SELECT 'gold_fact_telemetry', '{name}', count(*), count(*) FILTER ({failing}) FROM damaged"
        for name, failing in FACT_FAILURES.items()
    ]
)
DAMAGED_COUNTS_SQL = f"""{DAMAGED_FACT}, expected AS ({_EXPECTED})
SELECT source, expected.* FROM expected,
  (SELECT unnest(['observed', 'logged', 'stored']) AS source)"""

DELIVERY_SQL = """CASE WHEN event_timestamp < TIMESTAMP '2024-01-16' THEN 'batch'
  ELSE 'streaming' END"""


def _delivery() -> Column:
    return F.regexp_extract("_source_file", "/(batch|streaming)/", 1).alias("delivery")


def _bronze(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    lake = shared_dir(spark, "lake")
    finish(start_bronze(spark, landing(spark, sf_dir), lake, **options))
    return read_table(spark, lake, schemas.BRONZE)


def _chained(spark: SparkSession, sf_dir: str, **options) -> str:
    """A new lake holding all landed readings."""
    lake = shared_dir(spark, "lake")
    ingest(spark, landing(spark, sf_dir), lake, **options)
    return lake


def _in_two_increments(spark: SparkSession, sf_dir: str) -> str:
    """A new lake whose second delivery was landed after the first run of the chain."""
    path, lake = shared_dir(spark, "landing"), shared_dir(spark, "lake")
    readings = silver(spark, sf_dir)
    export_json_lines(first_delivery(readings), f"{path}/batch")
    ingest(spark, path, lake)
    export_json_lines(second_delivery(readings), f"{path}/streaming")
    ingest(spark, path, lake)
    return lake


# --- sources -------------------------------------------------------------------------------


@query("src_01_incremental_text", f"{WITH} SELECT record_id, machine_id FROM silver")
def incremental_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.col("raw_content")
    return _bronze(spark, sf_dir).select(
        F.get_json_object(raw, "$.record_id").alias("record_id"),
        F.get_json_object(raw, "$.machine_id").alias("machine_id"),
    )


@query(
    "src_01b_late_file",
    f"""{WITH} SELECT {DELIVERY_SQL} AS delivery, line_id, count(*) AS lines
    FROM silver GROUP BY ALL""",
)
def late_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later files are dated eleven years ahead for the first line, 1970 for the others."""
    path, lake = shared_dir(spark, "landing"), shared_dir(spark, "lake")
    readings = silver(spark, sf_dir)
    export_json_lines(first_delivery(readings), f"{path}/batch")
    finish(start_bronze(spark, path, lake))
    eleven_years = 11 * 365 * 24 * 3600 * 1000
    for number, line in enumerate(("PL-01", "PL-02", "PL-03", "PL-04")):
        folder = f"{path}/streaming/{number}"
        export_json_lines(second_delivery(readings).filter(F.col("line_id") == line), folder)
        for part in names_in(spark, f"{folder}/line_id={line}"):
            date = 0 if number else int(time.time() * 1000) + eleven_years
            set_modified(spark, f"{folder}/line_id={line}/{part}", date)
        finish(start_bronze(spark, path, lake))
    lines = read_table(spark, lake, schemas.BRONZE)
    line = F.get_json_object("raw_content", "$.line_id").alias("line_id")
    return lines.groupBy(_delivery(), line).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "src_02_existing_files",
    f"{WITH} SELECT {DELIVERY_SQL} AS delivery, count(*) AS lines FROM silver GROUP BY ALL",
)
def existing_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backlog of files, worked off in micro-batches of three files."""
    lines = _bronze(spark, sf_dir, max_files=3)
    return lines.groupBy(_delivery()).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "src_03_recursive_path",
    f"""{WITH} SELECT {DELIVERY_SQL} AS delivery, line_id, count(*) AS lines
    FROM silver GROUP BY ALL""",
)
def recursive_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _bronze(spark, sf_dir, path_glob="*.txt")
    line = F.regexp_extract("_source_file", "/line_id=([^/]+)/", 1).alias("line_id")
    return lines.groupBy(_delivery(), line).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "src_04_tracking",
    f"""{WITH} SELECT {DELIVERY_SQL} AS delivery, count(*) AS lines,
    count(DISTINCT record_id) AS readings FROM silver GROUP BY ALL""",
)
def tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After two runs, with files landed in between, every line is there once."""
    lake = _in_two_increments(spark, sf_dir)
    lines = read_table(spark, lake, schemas.BRONZE)
    record = F.get_json_object("raw_content", "$.record_id").alias("record_id")
    per_record = lines.groupBy(_delivery(), record).agg(F.count(F.lit(1)).alias("lines"))
    return per_record.groupBy("delivery").agg(
        F.sum("lines").alias("lines"), F.count("record_id").alias("readings")
    )


@query(
    "src_05_file_lineage",
    f"""{WITH} SELECT line_id, count(*) AS lines, count(*) AS with_path, count(*) AS with_time,
    count(*) AS with_size FROM silver GROUP BY line_id""",
)
def file_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_lines(spark, landing(spark, sf_dir))
    line = F.get_json_object("raw_content", "$.line_id").alias("line_id")
    inside = F.contains("_source_file", F.concat(F.lit("line_id="), line, F.lit("/")))
    return lines.groupBy(line).agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(inside).alias("with_path"),
        F.count("_source_file_timestamp").alias("with_time"),
        F.count_if(F.col("_source_file_size") > 0).alias("with_size"),
    )


@query(
    "src_06_processing_time",
    f"""{WITH} SELECT line_id, count(*) AS ingested, count(*) AS ingested_after_landing
    FROM silver GROUP BY line_id""",
)
def processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _bronze(spark, sf_dir)
    after = F.col("_ingested_at") >= F.col("_source_file_timestamp")
    return lines.groupBy(F.get_json_object("raw_content", "$.line_id").alias("line_id")).agg(
        F.count("_ingested_at").alias("ingested"),
        F.count_if(after).alias("ingested_after_landing"),
    )


@query(
    "src_07_stream_of_table",
    f"{WITH} SELECT machine_id, count(*) AS readings FROM silver GROUP BY machine_id",
)
def stream_of_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver is fed by the stream of the bronze table."""
    lake = shared_dir(spark, "lake")
    finish(start_bronze(spark, landing(spark, sf_dir), lake))
    finish(start_silver(spark, lake))
    readings = read_table(spark, lake, schemas.SILVER)
    return readings.groupBy("machine_id").agg(F.count(F.lit(1)).alias("readings"))


@query(
    "src_08_batch_table",
    f"""{WITH} SELECT line_id, parameter_name, count(*) AS rows FROM fact
    GROUP BY line_id, parameter_name""",
)
def batch_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, _chained(spark, sf_dir), schemas.FACT)
    return rows.groupBy("line_id", "parameter_name").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "src_09_inferred_json",
    f"""{WITH} SELECT line_id, machine_id, count(*) AS count,
    count(film) AS with_film_stress FROM silver WHERE is_anomaly GROUP BY line_id, machine_id""",
)
def inferred_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With inferred columns the sensor map is a struct, one field per parameter."""
    readings = read_json_inferred(spark, landing(spark, sf_dir), path_glob="part-*")
    flagged = readings.filter("is_anomaly = true").groupBy("line_id", "machine_id")
    return flagged.agg(
        F.count(F.lit(1)).alias("count"),
        F.count("telemetry.film_stress_mpa").alias("with_film_stress"),
    )


@query(
    "src_10_landing_folder",
    f"""{WITH} SELECT record_id, machine_id, is_anomaly FROM silver
    WHERE event_timestamp >= TIMESTAMP '2024-01-16'""",
)
def landing_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = read_json_inferred(spark, f"{landing(spark, sf_dir)}/streaming")
    return readings.select("record_id", "machine_id", "is_anomaly")


# --- sinks ---------------------------------------------------------------------------------


@query(
    "snk_01_append_table",
    f"""{WITH} SELECT {DELIVERY_SQL} AS delivery, parameter_name, count(*) AS rows
    FROM fact GROUP BY ALL""",
)
def append_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, _in_two_increments(spark, sf_dir), schemas.FACT)
    return rows.groupBy(_delivery(), "parameter_name").agg(F.count(F.lit(1)).alias("rows"))


@query("snk_02_partitioned_table", f"{SILVER_SQL} WHERE line_id = 'PL-02'")
def partitioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line of silver; only its partition is read."""
    readings = read_table(spark, _chained(spark, sf_dir), schemas.SILVER)
    return flat_silver(readings.filter(F.col("line_id") == "PL-02"))


@query("snk_03_materialized_dimension", f"{WITH} SELECT * FROM machine")
def materialized_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice; a reader that was open on the first state still has it."""
    lake = shared_dir(spark, "lake")
    machines = dimensions(spark, sf_dir).machine
    write_short_tables(spark, lake, 0, [(schemas.DIM_MACHINE, machines)])
    early = read_short_table(spark, lake, schemas.DIM_MACHINE)
    write_short_tables(spark, lake, 1, [(schemas.DIM_MACHINE, machines.limit(0))])
    late = read_short_table(spark, lake, schemas.DIM_MACHINE)
    return early.unionByName(late)


def _kpi_by_name(name: str, number: str):
    """Registers a KPI of a stored lake, read by name after the first and the second delivery."""
    sql = KPI_SQL[name]
    both = f"SELECT 'second' AS state, q.* FROM ({sql}) q UNION ALL " + (
        f"SELECT 'first', q.* FROM ({sql.replace('FROM events)', FIRST_EVENTS)}) q"
    )

    @query(number, both)
    def by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
        path, lake = shared_dir(spark, "landing"), shared_dir(spark, "lake")
        readings = silver(spark, sf_dir)
        export_json_lines(first_delivery(readings), f"{path}/batch")
        run(spark, path, lake)
        first = spark.table(name).withColumn("state", F.lit("first"))
        export_json_lines(second_delivery(readings), f"{path}/streaming")
        run(spark, path, lake)
        second = spark.table(name).withColumn("state", F.lit("second"))
        return with_double_rates(second.unionByName(first))


FIRST_EVENTS = "FROM events WHERE ts < TIMESTAMP '2024-01-16')"
for place, kpi_name in enumerate(VIEWS):
    suffix = kpi_name.removeprefix("mv_")
    _kpi_by_name(kpi_name, f"snk_04{'abcdefg'[place]}_view_{suffix}")


def _kpi_by_state(name: str, number: str):
    """Registers a KPI of the hourly moments, after a first and a second delivery."""

    @query(number, KPI_SQL[name])
    def by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
        path, lake = shared_dir(spark, "landing"), shared_dir(spark, "lake")
        readings = silver(spark, sf_dir)
        for half in (first_delivery, second_delivery):
            export_json_lines(half(readings), f"{path}/{half.__name__}")
            ingest(spark, path, lake)
            finish(start_hourly(spark, lake))
        return hourly_kpis(spark, lake)[name]


_kpi_by_state("mv_vibration_trend", "dp_09b_vibration_by_state")
_kpi_by_state("mv_parameter_stability", "dp_10b_stability_by_state")
_kpi_by_state("mv_power_consumption", "dp_12b_power_by_state")


@query("snk_04_view", KPI_SQL["mv_hourly_anomaly_heatmap"])
def view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A KPI of a stored lake, in SQL."""
    run(spark, landing(spark, sf_dir), shared_dir(spark, "lake"))
    return with_double_rates(spark.sql("SELECT * FROM mv_hourly_anomaly_heatmap"))


@query("snk_04b_view_out_of_spec", KPI_SQL["mv_parameter_out_of_spec"])
def view_out_of_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    run(spark, landing(spark, sf_dir), shared_dir(spark, "lake"))
    return with_double_rates(spark.table("mv_parameter_out_of_spec"))


_ROWS = {
    "bronze_raw_telemetry": "silver",
    "silver_telemetry": "silver",
    "gold_fact_telemetry": "fact",
    "gold_dim_production_line": "line",
    "gold_dim_machine": "machine",
    "gold_dim_date": "day",
    "gold_dim_process_stage": "stage",
    "gold_parameter_stats": "series",
}


@query(
    "snk_05_comments_and_properties",
    f"{WITH} "
    + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{name.split('_')[0]}' AS quality, true AS has_comment, "
        f"(SELECT count(*) FROM {rows}) AS rows"
        for name, rows in _ROWS.items()
    ),
)
def comments_and_properties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stored tables as the catalog shows them, with their rows."""
    lake = _chained(spark, sf_dir)
    described = []
    names = register_lake(spark, lake, f"plantlens_{uuid.uuid4().hex}")
    for name, spec in zip(names, schemas.TABLES, strict=True):
        shown = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
        properties = {row["key"]: row["value"] for row in shown}
        comment = spark.catalog.getTable(name).description
        described.append(
            spark.table(name)
            .agg(F.count(F.lit(1)).alias("rows"))
            .select(
                F.lit(spec.name).alias("table_name"),
                F.lit(properties["quality"]).alias("quality"),
                F.lit(comment == spec.comment).alias("has_comment"),
                "rows",
            )
        )
    return reduce(DataFrame.unionByName, described)


@query(
    "snk_05b_view_comments",
    " UNION ALL ".join(f"SELECT '{name}' AS name, true AS has_comment" for name in VIEWS),
)
def view_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPIs of a lake with their comments, in SQL."""
    run(spark, landing(spark, sf_dir), shared_dir(spark, "lake"))
    return spark.sql("SELECT name, length(comment) > 20 AS has_comment FROM kpi_comments")


@query(
    "snk_08_catalog_views",
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, true AS has_comment, count(*) AS rows FROM ({KPI_SQL[name]})"
        for name in VIEWS
    ),
)
def catalog_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The KPIs in a session that never opens the lake, after an increment it was not told of."""
    path, lake = shared_dir(spark, "landing"), shared_dir(spark, "lake")
    readings = silver(spark, sf_dir)
    export_json_lines(first_delivery(readings), f"{path}/batch")
    run(spark, path, lake)
    compact(spark, lake)
    export_json_lines(second_delivery(readings), f"{path}/streaming")
    ingest(spark, path, lake)
    reader, db, found = use_utc(spark.newSession()), database_of(lake), []
    for name in VIEW_SQL:
        shown = reader.sql(f"DESCRIBE TABLE EXTENDED {db}.{name}").where("col_name = 'Comment'")
        has_comment = len(shown.first()["data_type"]) > 20
        counted = reader.table(f"{db}.{name}").agg(F.count(F.lit(1)).alias("rows"))
        found.append(counted.select(F.lit(name).alias("name"), F.lit(has_comment).alias("has_comment"), "rows"))
    return reduce(DataFrame.unionByName, found)


@query(
    "snk_07_compacted_table",
    f"""{WITH} SELECT {DELIVERY_SQL} AS delivery, machine_id, parameter_name, count(*) AS rows
    FROM fact GROUP BY ALL""",
)
def compacted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compacted between two deliveries, so that the rows come from a copy and from new files."""
    path, lake = shared_dir(spark, "landing"), shared_dir(spark, "lake")
    readings = silver(spark, sf_dir)
    export_json_lines(first_delivery(readings), f"{path}/batch")
    ingest(spark, path, lake, max_files=2)
    compact(spark, lake)
    export_json_lines(second_delivery(readings), f"{path}/streaming")
    ingest(spark, path, lake)
    rows = read_table(spark, lake, schemas.FACT)
    return rows.groupBy(_delivery(), "machine_id", "parameter_name").agg(
        F.count(F.lit(1)).alias("rows")
    )


@query("snk_06_json_export", SILVER_SQL)
def json_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exported as JSON lines, read back and parsed."""
    path = shared_dir(spark, "export")
    export_json_lines(silver(spark, sf_dir), path)
    return flat_silver(parse_lines(read_lines(spark, path)))


# --- streaming -----------------------------------------------------------------------------

FACT_SQL = f"""{WITH} SELECT record_id, date_trunc('milliseconds', event_timestamp)
  AS event_timestamp, date_key, hour_of_day, plant_id, line_id, machine_id, process_stage,
  is_anomaly, parameter_name, parameter_value FROM fact"""


def _comparable_fact(rows: DataFrame) -> DataFrame:
    """Fact rows without path and load time, their time without a zone."""
    when = F.col("event_timestamp").cast("timestamp_ntz")
    return rows.drop("_source_file", "_loaded_at").withColumn("event_timestamp", when)


@query("str_01_chain", FACT_SQL)
def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _comparable_fact(read_table(spark, _chained(spark, sf_dir), schemas.FACT))


@query("str_02_increments", FACT_SQL)
def increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _in_two_increments(spark, sf_dir)
    return _comparable_fact(read_table(spark, lake, schemas.FACT))


@query("str_01b_chain_in_sql", FACT_SQL)
def chain_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first delivery in SQL, in micro-batches of two files, the second by DataFrames."""
    path, lake = shared_dir(spark, "landing"), shared_dir(spark, "lake")
    readings = silver(spark, sf_dir)
    export_json_lines(first_delivery(readings), f"{path}/batch")
    ingest_sql(spark, path, lake, max_files=2)
    export_json_lines(second_delivery(readings), f"{path}/streaming")
    ingest(spark, path, lake)
    return _comparable_fact(read_table(spark, lake, schemas.FACT))


@query("str_03b_silver_in_sql", SILVER_SQL)
def silver_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = shared_dir(spark, "lake")
    ingest_sql(spark, landing(spark, sf_dir), lake)
    return flat_silver(read_table(spark, lake, schemas.SILVER))


@query("str_03_parse_in_stream", SILVER_SQL)
def parse_in_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = shared_dir(spark, "lake")
    finish(start_bronze(spark, landing(spark, sf_dir), lake))
    finish(start_silver(spark, lake))
    return flat_silver(read_table(spark, lake, schemas.SILVER))


@query(
    "str_04_explode_in_stream",
    f"{WITH} SELECT record_id, parameter_name, parameter_value FROM fact",
)
def explode_in_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact stream alone, over a silver table written by a batch job."""
    lake = shared_dir(spark, "lake")
    readings = silver(spark, sf_dir).withColumns(
        {"_source_file": F.lit("batch"), "_loaded_at": F.current_timestamp()}
    )
    when = F.col("event_timestamp").cast("timestamp")
    overwrite_table(readings.withColumn("event_timestamp", when), lake, schemas.SILVER)
    finish(start_fact(spark, lake))
    rows = read_table(spark, lake, schemas.FACT)
    return rows.select("record_id", "parameter_name", "parameter_value")


@query("str_05_expectations_in_stream", DAMAGED_COUNTS_SQL)
def expectations_in_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters of a stream of damaged lines: those returned, logged, and of the stored tables."""
    path, lake = shared_dir(spark, "landing"), shared_dir(spark, "lake")
    damaged = damaged_lines(spark, sf_dir, errors=True).select(F.col("raw_content").alias("value"))
    damaged.repartition(6).write.text(path)
    returned = ingest(spark, path, lake, max_files=2)
    observed = spark.createDataFrame(
        [
            ("observed", table, name, counts["rows"], failed)
            for table, counts in returned.items()
            for name, failed in counts.items()
            if name != "rows"
        ],
        "source STRING, table_name STRING, expectation STRING, rows BIGINT, failed BIGINT",
    )
    logged = logged_expectations(spark, lake).withColumn("source", F.lit("logged"))
    stored = [
        stored_expectations(spark, lake, spec).select(
            F.lit("stored").alias("source"),
            F.lit(spec.name).alias("table_name"),
            "expectation",
            (F.col("passed") + F.col("failed")).alias("rows"),
            "failed",
        )
        for spec in (schemas.SILVER, schemas.FACT)
    ]
    return reduce(DataFrame.unionByName, [observed, logged, *stored])


@query(
    "str_06_dimensions_beside_streams",
    f"""{WITH} SELECT machine_id, count(*) AS fact_rows, count(DISTINCT date_key) AS days
    FROM fact JOIN machine USING (machine_id) JOIN day USING (date_key) GROUP BY machine_id""",
)
def dimensions_beside_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of the fact finds its partner in the dimensions kept beside the streams."""
    lake = _chained(spark, sf_dir)
    dims = read_dimensions(spark, lake)
    daily = (
        read_table(spark, lake, schemas.FACT)
        .groupBy("machine_id", "date_key")
        .agg(F.count(F.lit(1)).alias("fact_rows"))
    )
    joined = daily.join(dims.machine, "machine_id").join(dims.date, "date_key")
    return joined.groupBy("machine_id").agg(
        F.sum("fact_rows").alias("fact_rows"), F.count(F.lit(1)).alias("days")
    )
