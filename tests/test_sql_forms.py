"""The tables of the model, written once more in Spark SQL, over planted lines and the binding."""

import pytest
from compare import spark_rows
from planted import PLANTED

from plantlens.operators.dimensions import build_dimensions
from plantlens.operators.parse import fact_rows, parse_lines
from plantlens.registry import bindings
from plantlens.schemas import READING_SCHEMA

CALENDAR = """
SELECT CAST(date_format(d, 'yyyyMMdd') AS INT) AS date_key, d AS full_date, year(d) AS year,
  quarter(d) AS quarter, month(d) AS month, date_format(d, 'MMMM') AS month_name,
  day(d) AS day_of_month, dayofweek(d) AS day_of_week, date_format(d, 'EEEE') AS day_name,
  weekofyear(d) AS week_of_year, weekday(d) >= 5 AS is_weekend
FROM (SELECT DISTINCT CAST(event_timestamp AS DATE) AS d FROM s) WHERE d IS NOT NULL
"""
LINES = """
SELECT line_id, line_name, product_type, target_frequency_band_ghz_min,
  target_frequency_band_ghz_max,
  round(target_frequency_band_ghz_max - target_frequency_band_ghz_min, 3) AS target_bandwidth_ghz
FROM s GROUP BY ALL
"""
FACT = """
SELECT record_id, event_timestamp, CAST(date_format(event_timestamp, 'yyyyMMdd') AS INT) AS date_key,
  hour(event_timestamp) AS hour_of_day, plant_id, line_id, machine_id, process_stage, is_anomaly,
  parameter_name, parameter_value
FROM s LATERAL VIEW explode(telemetry) AS parameter_name, parameter_value
"""


@pytest.fixture(scope="module")
def bronze(spark):
    lines = [(line, "file") for line in PLANTED]
    return spark.createDataFrame(lines, "raw_content STRING, _source_file STRING")


@pytest.fixture(scope="module", params=["planted", "binding"])
def readings(request, spark, bronze, sf_dir):
    df = parse_lines(bronze) if request.param == "planted" else bindings.silver(spark, sf_dir)
    df.createOrReplaceTempView("s")
    return df


def test_silver(spark, bronze):
    bronze.createOrReplaceTempView("b")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in READING_SCHEMA)
    columns = ", ".join(
        "CAST(p.telemetry AS STRING) AS telemetry" if n == "telemetry"
        else "try_cast(p.`timestamp` AS TIMESTAMP) AS event_timestamp" if n == "timestamp"
        else f"p.{n}"
        for n in READING_SCHEMA.names
    )
    expected = spark.sql(
        f"SELECT {columns}, _source_file FROM (SELECT from_json(raw_content, '{fields}') AS p, "
        "_source_file FROM b)"
    )
    parsed = parse_lines(bronze).drop("_loaded_at")
    parsed = parsed.withColumn("telemetry", parsed["telemetry"].cast("string"))
    assert spark_rows(parsed) == spark_rows(expected)


def test_dimensions(spark, readings):
    dims = build_dimensions(readings)
    assert spark_rows(dims.line) == spark_rows(spark.sql(LINES))
    machines = "SELECT DISTINCT machine_id, machine_type, process_stage, line_id FROM s"
    assert spark_rows(dims.machine) == spark_rows(spark.sql(machines))
    assert spark_rows(dims.date) == spark_rows(spark.sql(CALENDAR))
    stages = spark.sql("SELECT DISTINCT process_stage FROM s")
    assert spark_rows(dims.stage.select("process_stage")) == spark_rows(stages)


def test_fact(spark, readings):
    rows = fact_rows(readings).drop("_source_file", "_loaded_at")
    assert spark_rows(rows) == spark_rows(spark.sql(FACT))


def test_fact_has_a_row_per_map_entry(readings):
    entries = readings.selectExpr("sum(size(telemetry))").first()[0]
    assert fact_rows(readings).count() == entries
