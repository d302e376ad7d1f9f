"""Tables of the model and the KPIs over them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.operators.aggregates import readings_of_silver
from plantlens.operators.dimensions import dates, machines, process_stages, production_lines
from plantlens.operators.parse import fact_rows, parameter_rows, parse_lines
from plantlens.plans import kpis
from plantlens.registry.bindings import dimensions, fact, landing, silver
from plantlens.registry.core import query
from plantlens.registry.oracle import WITH, rate
from plantlens.session import materialize
from plantlens.sources.landing import read_lines


def with_double_rates(df: DataFrame) -> DataFrame:
    """Percentages as DOUBLE, the type the SQL check gives them."""
    rates = [f.name for f in df.schema if f.dataType.typeName() == "decimal"]
    return df.withColumns({name: F.col(name).cast("double") for name in rates})


@query(
    "dp_01_bronze",
    f"""{WITH} SELECT record_id, line_id, true AS has_file, true AS has_time,
    true AS has_size, true AS has_ingest_time FROM silver""",
)
def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_lines(spark, landing(spark, sf_dir))
    return lines.select(
        F.get_json_object("raw_content", "$.record_id").alias("record_id"),
        F.get_json_object("raw_content", "$.line_id").alias("line_id"),
        F.col("_source_file").isNotNull().alias("has_file"),
        F.col("_source_file_timestamp").isNotNull().alias("has_time"),
        (F.col("_source_file_size") > 0).alias("has_size"),
        F.col("_ingested_at").isNotNull().alias("has_ingest_time"),
    )


SILVER_COLUMNS = [
    "record_id",
    "event_timestamp",
    "plant_id",
    "line_id",
    "line_name",
    "product_type",
    "target_frequency_band_ghz_min",
    "target_frequency_band_ghz_max",
    "machine_id",
    "machine_type",
    "process_stage",
    "is_anomaly",
]
SILVER_SQL = f"""{WITH} SELECT record_id,
    date_trunc('milliseconds', event_timestamp) AS event_timestamp, plant_id, line_id, line_name,
    product_type, target_frequency_band_ghz_min, target_frequency_band_ghz_max, machine_id,
    machine_type, process_stage, is_anomaly, value AS vibration, k AS power, film,
    CAST(CASE WHEN film IS NULL THEN 3 ELSE 4 END AS INT) AS parameters FROM silver"""


def flat_silver(readings: DataFrame) -> DataFrame:
    """Silver with its map laid out, and times without a zone as in the SQL check."""

    def sensor(name: str) -> F.Column:
        return F.element_at("telemetry", F.lit(name))

    return readings.select(
        *SILVER_COLUMNS,
        sensor("vibration_mm_s_rms").alias("vibration"),
        sensor("power_consumption_kw").alias("power"),
        sensor("film_stress_mpa").alias("film"),
        F.size("telemetry").alias("parameters"),
    ).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp_ntz"))


@query("dp_02_silver", SILVER_SQL)
def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_silver(parse_lines(read_lines(spark, landing(spark, sf_dir))))


@query("dp_03_production_lines", f"{WITH} SELECT * FROM line")
def line_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return production_lines(silver(spark, sf_dir))


@query("dp_04_machines", f"{WITH} SELECT * FROM machine")
def machine_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return machines(silver(spark, sf_dir))


@query("dp_05_dates", f"{WITH} SELECT * FROM day")
def date_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dates(silver(spark, sf_dir))


@query("dp_06_process_stages", f"{WITH} SELECT * FROM stage")
def stage_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return process_stages(silver(spark, sf_dir))


@query("dp_07_fact", f"{WITH} SELECT * FROM fact")
def fact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_rows(silver(spark, sf_dir))


COUNTS = f"""count(DISTINCT f.record_id) AS total_readings,
    count(DISTINCT f.record_id) FILTER (f.is_anomaly) AS anomaly_readings,
    {rate('count(DISTINCT f.record_id) FILTER (f.is_anomaly)', 'count(DISTINCT f.record_id)')}
      AS anomaly_rate_pct"""


ANOMALY_RATE_SQL = f"""{WITH} SELECT f.line_id, line.line_name, line.product_type, f.machine_id,
    machine.machine_type, f.date_key, f.hour_of_day, {COUNTS}
    FROM fact f JOIN line ON f.line_id = line.line_id
      JOIN machine ON f.machine_id = machine.machine_id GROUP BY ALL"""


@query("dp_08_anomaly_rate", ANOMALY_RATE_SQL)
def anomaly_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = dimensions(spark, sf_dir)
    readings = readings_of_silver(silver(spark, sf_dir))
    return with_double_rates(kpis.anomaly_rate(readings, dims.line, dims.machine))


VIBRATION_SQL = f"""{WITH} SELECT f.line_id, line_name, f.machine_id, machine_type, machine.process_stage,
    date_key, hour_of_day, round(avg(parameter_value), 6) AS avg_vibration_mm_s_rms,
    round(max(parameter_value), 6) AS max_vibration_mm_s_rms,
    round(min(parameter_value), 6) AS min_vibration_mm_s_rms,
    round(stddev_samp(parameter_value), 6) AS stddev_vibration, count(*) AS reading_count
    FROM fact f JOIN line ON f.line_id = line.line_id
      JOIN machine ON f.machine_id = machine.machine_id
    WHERE parameter_name = 'vibration_mm_s_rms' GROUP BY ALL"""


@query("dp_09_vibration_trend", VIBRATION_SQL)
def vibration_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = dimensions(spark, sf_dir)
    rows = parameter_rows(silver(spark, sf_dir), kpis.VIBRATION)
    return kpis.vibration_trend(rows, dims.line, dims.machine)


STABILITY_SQL = f"""{WITH} SELECT f.line_id, f.machine_id, machine_type, stage_category, parameter_name,
    date_key, hour_of_day, round(avg(parameter_value), 6) AS mean_value,
    round(stddev_samp(parameter_value), 6) AS stddev_value,
    round(CASE WHEN avg(parameter_value) <> 0
      THEN stddev_samp(parameter_value) / abs(avg(parameter_value)) END, 6) AS stability_index,
    count(*) AS reading_count
    FROM fact f JOIN machine ON f.machine_id = machine.machine_id
      JOIN stage ON f.process_stage = stage.process_stage GROUP BY ALL"""


@query("dp_10_parameter_stability", STABILITY_SQL)
def parameter_stability(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = dimensions(spark, sf_dir)
    return kpis.parameter_stability(fact(spark, sf_dir), dims.machine, dims.stage)


STAGE_RATE_SQL = f"""{WITH} SELECT stage_category, stage_sequence, f.line_id, product_type, date_key, {COUNTS}
    FROM fact f JOIN stage ON f.process_stage = stage.process_stage
      JOIN line ON f.line_id = line.line_id GROUP BY ALL"""


@query("dp_11_process_stage_anomaly_rate", STAGE_RATE_SQL)
def process_stage_anomaly_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = dimensions(spark, sf_dir)
    readings = readings_of_silver(silver(spark, sf_dir))
    stages = materialize(dims.stage)
    return with_double_rates(kpis.process_stage_anomaly_rate(readings, stages, dims.line))


POWER_SQL = f"""{WITH} SELECT f.line_id, line_name, product_type, f.machine_id, machine_type, date_key,
    hour_of_day, round(avg(parameter_value), 4) AS avg_power_kw,
    round(max(parameter_value), 4) AS max_power_kw, round(min(parameter_value), 4) AS min_power_kw,
    round(stddev_samp(parameter_value), 4) AS stddev_power_kw, count(*) AS reading_count
    FROM fact f JOIN line ON f.line_id = line.line_id
      JOIN machine ON f.machine_id = machine.machine_id
    WHERE parameter_name = 'power_consumption_kw' GROUP BY ALL"""


@query("dp_12_power_consumption", POWER_SQL)
def power_consumption(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = dimensions(spark, sf_dir)
    rows = parameter_rows(silver(spark, sf_dir), kpis.POWER)
    return kpis.power_consumption(rows, dims.line, dims.machine)


HEATMAP_SQL = f"""{WITH} SELECT f.line_id, line_name, product_type, date_key, hour_of_day,
    CASE WHEN hour_of_day < 6 OR hour_of_day > 21 THEN 'Night' WHEN hour_of_day < 14 THEN 'Day'
      ELSE 'Swing' END AS shift, {COUNTS},
    count(*) FILTER (f.is_anomaly) AS anomaly_param_violations
    FROM fact f JOIN line ON f.line_id = line.line_id GROUP BY ALL"""


@query("dp_13_hourly_anomaly_heatmap", HEATMAP_SQL)
def hourly_anomaly_heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = dimensions(spark, sf_dir)
    readings = readings_of_silver(silver(spark, sf_dir))
    return with_double_rates(kpis.hourly_anomaly_heatmap(readings, dims.line))


OUT_OF_SPEC_SQL = f"""{WITH} SELECT f.line_id, machine_type, f.machine_id, stage_category,
    parameter_name, date_key, round(any_value(mu), 6) AS param_mean,
    round(any_value(sd), 6) AS param_stddev, count(*) AS total_readings,
    CAST(sum(beyond) AS BIGINT) AS out_of_spec_count,
    {rate('sum(beyond)', 'count(*)')} AS out_of_spec_rate_pct
    FROM spec f JOIN machine ON f.machine_id = machine.machine_id
      JOIN stage ON machine.process_stage = stage.process_stage GROUP BY ALL"""


@query("dp_14_parameter_out_of_spec", OUT_OF_SPEC_SQL)
def parameter_out_of_spec(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = dimensions(spark, sf_dir)
    return with_double_rates(
        kpis.parameter_out_of_spec(fact(spark, sf_dir), dims.machine, dims.stage)
    )


KPI_SQL = {
    "mv_anomaly_rate": ANOMALY_RATE_SQL,
    "mv_vibration_trend": VIBRATION_SQL,
    "mv_parameter_stability": STABILITY_SQL,
    "mv_process_stage_anomaly_rate": STAGE_RATE_SQL,
    "mv_power_consumption": POWER_SQL,
    "mv_hourly_anomaly_heatmap": HEATMAP_SQL,
    "mv_parameter_out_of_spec": OUT_OF_SPEC_SQL,
}
