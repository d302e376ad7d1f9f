"""Limits, bursts, findings and reports over the readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.functions.measures import severity
from plantlens.operators.bursts import anomaly_bursts
from plantlens.operators.findings import flagged_machines, parameter_profile, watch_list
from plantlens.operators.limits import check_limits, tally_violations
from plantlens.operators.reports import (
    assemble_reports,
    explain_findings,
    parts_list,
    remediation_steps,
)
from plantlens.registry.bindings import dimensions, fact, knowledge, limits, silver
from plantlens.registry.core import query
from plantlens.registry.oracle import PROFILE, WITH
from plantlens.registry.products import with_double_rates

# The limits of the binding, as conditions on a fact row.
HIGH = """(parameter_name = 'vibration_mm_s_rms' AND parameter_value > 150
    OR parameter_name = 'power_consumption_kw' AND parameter_value > 95
    OR parameter_name = 'hermetic_leak_rate_atm_cc_per_s' AND parameter_value > 0.5)"""
LOW = """(parameter_name = 'power_consumption_kw' AND parameter_value < 5
    OR parameter_name = 'film_stress_mpa' AND parameter_value < 20)"""


@query(
    "ra_01_limit_check",
    f"""{WITH} SELECT machine_id, parameter_name, count(*) AS rows,
    count(*) FILTER ({HIGH}) AS high, count(*) FILTER ({LOW}) AS low,
    count(*) FILTER ({HIGH} OR {LOW}) AS violations FROM fact GROUP BY ALL""",
)
def limit_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = check_limits(fact(spark, sf_dir), limits(spark))
    return checked.groupBy("machine_id", "parameter_name").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("side") == "high").alias("high"),
        F.count_if(F.col("side") == "low").alias("low"),
        F.count_if("violation").alias("violations"),
    )


@query(
    "ra_01b_violating_rows",
    f"""{WITH} SELECT record_id, parameter_name,
    CASE WHEN {HIGH} THEN 'high' ELSE 'low' END AS side FROM fact WHERE {HIGH} OR {LOW}""",
)
def violating_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    checked = check_limits(fact(spark, sf_dir), limits(spark))
    return checked.filter("violation").select("record_id", "parameter_name", "side")


@query(
    "ra_02_violation_tally",
    f"""{WITH} SELECT line_id, count(DISTINCT record_id) AS readings,
    count(DISTINCT record_id) FILTER (is_anomaly) AS flagged_readings,
    count(*) AS parameter_values, count(*) FILTER ({HIGH} OR {LOW}) AS violating_values
    FROM fact GROUP BY line_id""",
)
def violation_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tally_violations(check_limits(fact(spark, sf_dir), limits(spark)))


def _profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parameter_profile(fact(spark, sf_dir))


@query("ra_03_parameter_profile", f"{PROFILE} SELECT * FROM profile")
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_double_rates(_profile(spark, sf_dir))


@query("ra_04_watch_list", f"{PROFILE} SELECT * FROM watch")
def watch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_double_rates(watch_list(_profile(spark, sf_dir)))


@query(
    "ra_04b_watch_list_top",
    f"""{PROFILE} SELECT machine_id, parameter_name, oos_pct, rank FROM watch
    WHERE rank = 1 AND machine_id IN (SELECT machine_id FROM silver WHERE is_anomaly)""",
)
def watch_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = flagged_machines(silver(spark, sf_dir))
    worst = watch_list(_profile(spark, sf_dir), top=1, only_machines=flagged)
    return with_double_rates(worst.select("machine_id", "parameter_name", "oos_pct", "rank"))


@query(
    "ra_05_severity",
    f"""{PROFILE} SELECT machine_id, parameter_name, oos_pct,
    CASE WHEN oos_pct > 6 THEN 'high' WHEN oos_pct > 4 THEN 'medium' ELSE 'low' END AS severity
    FROM profile""",
)
def severity_band(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _profile(spark, sf_dir)
    banded = found.select(
        "machine_id", "parameter_name", "oos_pct", severity(F.col("oos_pct")).alias("severity")
    )
    return with_double_rates(banded)


def _explained(spark: SparkSession, sf_dir: str) -> DataFrame:
    return explain_findings(watch_list(_profile(spark, sf_dir)), knowledge(spark))


EXPLAINED = f"""{PROFILE}, explained AS (
  SELECT * FROM watch LEFT JOIN knowledge USING (machine_id, parameter_name))"""


@query(
    "ra_06_knowledge",
    f"""{EXPLAINED} SELECT machine_id, parameter_name, rank, location, name, threshold, root_cause
    FROM explained""",
)
def knowledge_of_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _explained(spark, sf_dir).select(
        "machine_id", "parameter_name", "rank", "location", "name", "threshold", "root_cause"
    )


@query(
    "ra_07_parts",
    f"""{EXPLAINED}, part_rows AS (
      SELECT machine_id, parameter_name, unnest(parts) AS part FROM explained)
    SELECT machine_id, parameter_name,
    trim(regexp_replace(part, '\\(P/N: [^)]+\\)', '')) AS part_name,
    nullif(regexp_extract(part, '\\(P/N: ([^)]+)\\)', 1), '') AS part_number FROM part_rows""",
)
def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parts_list(_explained(spark, sf_dir))


@query(
    "ra_08_steps",
    f"""{EXPLAINED} SELECT machine_id, parameter_name,
    CAST(unnest(range(1, len(remediation) + 1)) AS INT) AS step_no, unnest(remediation) AS step
    FROM explained""",
)
def steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remediation_steps(_explained(spark, sf_dir))


STAGE_TITLE = """array_to_string(list_transform(
  string_split(replace(process_stage, '_', ' '), ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"""
REPORT_SQL = f"""{EXPLAINED}, printed AS (
  SELECT *, coalesce(name, parameter_name) AS shown FROM explained),
sections AS (
  SELECT machine_id, count(*) AS finding_count, max(location) AS location,
    string_agg(concat_ws(' | ', shown, mean, stddev, CAST(oos_pct AS DECIMAL(18, 2)) || '%',
      severity, threshold), chr(10) ORDER BY rank) AS summary,
    string_agg(concat_ws(chr(10), rank || '. ' || shown || ' (' || parameter_name || ')',
      'Root Cause Analysis' || chr(10) || root_cause,
      CASE WHEN len(parts) > 0 THEN 'Parts Required' || chr(10) ||
        array_to_string(list_transform(parts, lambda p: '  ' || p), chr(10)) END,
      CASE WHEN len(remediation) > 0 THEN 'Remediation Steps' || chr(10) ||
        array_to_string(list_transform(remediation, lambda s, i: '  ' || i || '. ' || s), chr(10))
        END), chr(10) ORDER BY rank) AS details
  FROM printed GROUP BY machine_id)
SELECT s.machine_id, CAST(finding_count AS INT) AS finding_count, location, m.machine_type, m.line_id,
  concat_ws(chr(10), 'MAINTENANCE & REMEDIATION REPORT', 'Machine ID: ' || s.machine_id,
    'Location: ' || location, 'Machine Type: ' || m.machine_type,
    'Line: ' || m.line_id || ' (' || line.product_type || ')', 'Process Stage: ' || {STAGE_TITLE},
    'Parameters: ' || finding_count || ' parameters with anomalies detected', 'ANOMALY SUMMARY',
    summary, details) AS body
FROM sections s JOIN machine m USING (machine_id) JOIN line USING (line_id)"""


@query("ra_09_reports", REPORT_SQL)
def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report per machine, compared as a whole."""
    dims = dimensions(spark, sf_dir)
    assembled = assemble_reports(_explained(spark, sf_dir), dims.machine, dims.line)
    return assembled.select(
        "machine_id", "finding_count", "location", "machine_type", "line_id", "body"
    )


DRIFT_SQL = f"""{EXPLAINED} SELECT machine_id, CAST(count(*) AS INT) AS finding_count,
  'PL-0' || ((CAST(substr(machine_id, 2) AS INT) // 5) + 1) AS line_id,
  any_value(m.machine_type) || ' / ' || any_value(m.machine_type) || ' new' AS machine_type
FROM explained JOIN machine m USING (machine_id) GROUP BY machine_id"""


@query("ra_09b_reports_under_drift", DRIFT_SQL)
def reports_under_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every machine has changed its type once, and still has one report."""
    dims = dimensions(spark, sf_dir)
    renamed = F.concat("machine_type", F.lit(" new"))
    drifted = dims.machine.unionByName(dims.machine.withColumn("machine_type", renamed))
    assembled = assemble_reports(_explained(spark, sf_dir), drifted, dims.line)
    return assembled.select("machine_id", "finding_count", "line_id", "machine_type")


BURSTS_SQL = f"""{WITH}, placed AS (
  SELECT machine_id, event_timestamp, is_anomaly,
    row_number() OVER (PARTITION BY machine_id ORDER BY event_timestamp, record_id)
    - row_number() OVER (PARTITION BY machine_id, is_anomaly ORDER BY event_timestamp, record_id)
      AS island FROM silver)
SELECT machine_id, min(event_timestamp) AS burst_start, max(event_timestamp) AS burst_end,
  count(*) AS readings FROM placed WHERE is_anomaly GROUP BY machine_id, island"""


@query("ra_10_bursts", BURSTS_SQL)
def bursts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomaly_bursts(silver(spark, sf_dir))


@query("ra_10b_bursts_many_slices", BURSTS_SQL)
def bursts_many_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with slices so short that most bursts meet an edge."""
    return anomaly_bursts(silver(spark, sf_dir), slices=50)
