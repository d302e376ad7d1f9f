"""Expectations over damaged lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.operators.dimensions import machines
from plantlens.operators.parse import fact_rows, parse_lines
from plantlens.operators.quality import duplicate_keys, expectation_report, not_a_number_report
from plantlens.registry.bindings import damaged_lines, fact, silver
from plantlens.registry.core import query
from plantlens.registry.oracle import WITH
from plantlens.schemas import FACT, SILVER

# Damage of the lines, as bindings.damaged_lines makes it. Readings without a record id are those
# of errors with an odd id; a vibration of "NaN" stands in errors whose id is divisible by four.
CUT = "event_type = 'click'"
NO_ID = "event_type = 'error' AND CAST(record_id AS BIGINT) % 2 = 1"
NOT_A_NUMBER = "event_type = 'error' AND CAST(record_id AS BIGINT) % 4 = 0"

# Rows of the fact over the damaged lines; cut lines give none, other readings all of theirs.
DAMAGED_FACT = f"""{WITH}, damaged AS (
  SELECT s.event_type, record_id, f.parameter_name FROM fact f JOIN silver s USING (record_id)
  WHERE s.event_type <> 'click')"""


SILVER_FAILURES = {
    "valid_record_id": f"({CUT} OR {NO_ID})",
    "valid_timestamp": "event_type IN ('click', 'signup')",
    "valid_machine_id": "event_type IN ('click', 'purchase')",
}
# A key of a map cannot be missing, so no exploded row fails on its parameter's name.
FACT_FAILURES = {
    "valid_record": NO_ID,
    "valid_param_name": "false",
    "valid_param_value": "event_type = 'view' AND parameter_name = 'vibration_mm_s_rms'",
}


def _counts(name: str, failing: str, rows: str) -> str:
    return (
        f"SELECT '{name}' AS expectation, count(*) FILTER (NOT ({failing})) AS passed, "
        f"count(*) FILTER ({failing}) AS failed FROM {rows}"
    )


def _silver_sql(name: str) -> str:
    return f"{WITH} {_counts(name, SILVER_FAILURES[name], 'silver')}"


def _fact_sql(name: str) -> str:
    return f"{DAMAGED_FACT} {_counts(name, FACT_FAILURES[name], 'damaged')}"


def _report(df: DataFrame, expectations: dict[str, str], name: str) -> DataFrame:
    return expectation_report(df, {name: expectations[name]})


def _silver_check(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _report(parse_lines(damaged_lines(spark, sf_dir, errors=True)), SILVER.expectations, name)


def _fact_check(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = fact_rows(parse_lines(damaged_lines(spark, sf_dir, errors=True)))
    return _report(rows, FACT.expectations, name)


@query("dq_01_valid_record_id", _silver_sql("valid_record_id"))
def valid_record_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_check(spark, sf_dir, "valid_record_id")


@query("dq_02_valid_timestamp", _silver_sql("valid_timestamp"))
def valid_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_check(spark, sf_dir, "valid_timestamp")


@query("dq_03_valid_machine_id", _silver_sql("valid_machine_id"))
def valid_machine_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver_check(spark, sf_dir, "valid_machine_id")


@query("dq_04_valid_record", _fact_sql("valid_record"))
def valid_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact_check(spark, sf_dir, "valid_record")


@query(
    "dq_05_valid_param_name",
    f"""{WITH} SELECT 'valid_param_name' AS expectation,
    count(*) FILTER (is_anomaly IS NOT TRUE) AS passed, count(*) FILTER (is_anomaly) AS failed
    FROM fact""",
)
def valid_param_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On rows that no map made: those of flagged readings have lost their parameter's name."""
    name = F.when(~F.col("is_anomaly"), F.col("parameter_name"))
    rows = fact(spark, sf_dir).withColumn("parameter_name", name)
    return _report(rows, FACT.expectations, "valid_param_name")


@query("dq_06_valid_param_value", _fact_sql("valid_param_value"))
def valid_param_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact_check(spark, sf_dir, "valid_param_value")


FULL_REPORT_SQL = " UNION ALL ".join(
    [_counts(name, failing, "silver") for name, failing in SILVER_FAILURES.items()]
    + [_counts(name, failing, "damaged") for name, failing in FACT_FAILURES.items()]
)


@query("dq_07_expectation_report", f"{DAMAGED_FACT} {FULL_REPORT_SQL}")
def full_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = parse_lines(damaged_lines(spark, sf_dir, errors=True))
    return expectation_report(readings, SILVER.expectations).unionByName(
        expectation_report(fact_rows(readings), FACT.expectations)
    )


IS_NAN = f"{NOT_A_NUMBER} AND parameter_name = 'vibration_mm_s_rms'"


@query(
    "dq_08_value_is_number",
    f"{DAMAGED_FACT} {_counts('parameter_value_is_number', IS_NAN, 'damaged')}",
)
def value_is_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fact_rows(parse_lines(damaged_lines(spark, sf_dir, errors=True)))
    return not_a_number_report(rows, "parameter_value")


@query(
    "dq_09_duplicate_dimension_keys",
    f"""{WITH} SELECT machine_type, count(*) AS rows
    FROM machine GROUP BY machine_type HAVING count(*) > 1""",
)
def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Machine types used as a key would repeat; the machine id does not."""
    return duplicate_keys(machines(silver(spark, sf_dir)), "machine_type")
