"""SQL for DuckDB: the same telemetry from the driver tables, as common table expressions."""

from __future__ import annotations

from plantlens.functions.stages import STAGES, UNKNOWN_STAGE
from plantlens.registry.bindings import KNOWLEDGE, MACHINE_STAGES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values: list[str]) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]::VARCHAR[]"


_STAGE_ROWS = ", ".join(f"({_text(k)}, {seq}, {_text(cat)})" for k, (seq, cat) in STAGES.items())
_KNOWLEDGE_ROWS = ", ".join(
    "(" + ", ".join([*[_text(v) for v in row[:6]], _list(row[6]), _list(row[7])]) + ")"
    for row in KNOWLEDGE
)

WITH = f"""
WITH numbered AS (
  SELECT *, CAST(user_id % 20 AS INT) AS no, CAST(user_id % 20 AS INT) // 5 + 1 AS line_no,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events),
silver AS (
  SELECT CAST(event_id AS VARCHAR) AS record_id, ts AS event_timestamp, 'P1' AS plant_id,
    'PL-0' || line_no AS line_id, 'Line ' || line_no AS line_name,
    'Product ' || line_no AS product_type,
    CAST(line_no AS DOUBLE) AS target_frequency_band_ghz_min,
    CAST(line_no AS DOUBLE) + 0.25 AS target_frequency_band_ghz_max,
    'M' || lpad(CAST(no AS VARCHAR), 2, '0') AS machine_id, 'Type ' || (no % 5) AS machine_type,
    ({_list(MACHINE_STAGES)})[no + 1] AS process_stage, event_type = 'error' AS is_anomaly,
    CAST(strftime(ts, '%Y%m%d') AS INT) AS date_key, CAST(hour(ts) AS INT) AS hour_of_day,
    value, k, CASE WHEN no % 5 = 0 THEN value + k END AS film, event_type
  FROM numbered),
fact AS (
  SELECT record_id, event_timestamp, date_key, hour_of_day, plant_id, line_id, machine_id,
    process_stage, is_anomaly, p.n AS parameter_name, p.v AS parameter_value
  FROM (SELECT *, unnest([
      {{'n': 'vibration_mm_s_rms', 'v': value}}, {{'n': 'power_consumption_kw', 'v': k}},
      {{'n': 'hermetic_leak_rate_atm_cc_per_s', 'v': CAST(0 AS DOUBLE)}},
      {{'n': 'film_stress_mpa', 'v': film}}]) AS p FROM silver)
  WHERE p.v IS NOT NULL),
stage_table(process_stage, stage_sequence, stage_category) AS (VALUES {_STAGE_ROWS}),
line AS (
  SELECT DISTINCT line_id, line_name, product_type, target_frequency_band_ghz_min,
    target_frequency_band_ghz_max,
    round(target_frequency_band_ghz_max - target_frequency_band_ghz_min, 3) AS target_bandwidth_ghz
  FROM silver),
machine AS (SELECT DISTINCT machine_id, machine_type, process_stage, line_id FROM silver),
day AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, d AS full_date,
    CAST(year(d) AS INT) AS year, CAST(quarter(d) AS INT) AS quarter,
    CAST(month(d) AS INT) AS month, monthname(d) AS month_name, CAST(day(d) AS INT) AS day_of_month,
    CAST(dayofweek(d) + 1 AS INT) AS day_of_week, dayname(d) AS day_name,
    CAST(weekofyear(d) AS INT) AS week_of_year, dayofweek(d) IN (0, 6) AS is_weekend
  FROM (SELECT DISTINCT CAST(event_timestamp AS DATE) AS d FROM silver)),
stage AS (
  SELECT process_stage, CAST(coalesce(t.stage_sequence, {UNKNOWN_STAGE[0]}) AS INT) AS stage_sequence,
    coalesce(t.stage_category, {_text(UNKNOWN_STAGE[1])}) AS stage_category
  FROM (SELECT DISTINCT process_stage FROM silver) LEFT JOIN stage_table t USING (process_stage)),
knowledge(machine_id, location, parameter_name, name, threshold, root_cause, parts, remediation)
  AS (VALUES {_KNOWLEDGE_ROWS}),
series AS (
  SELECT machine_id, parameter_name, avg(parameter_value) AS mu, stddev_samp(parameter_value) AS sd
  FROM fact GROUP BY ALL),
spec AS (
  SELECT f.*, s.mu, s.sd, CAST(abs(f.parameter_value - s.mu) > 2 * s.sd AS INT) AS beyond
  FROM fact f JOIN series s USING (machine_id, parameter_name) WHERE s.sd > 0)
"""


def rate(part: str, whole: str) -> str:
    """A percentage rounded as a decimal, half up."""
    return f"CAST(round(CAST({part} * 100.0 / {whole} AS DECIMAL(18, 9)), 2) AS DOUBLE)"


PROFILE = f"""{WITH}, profile AS (
  SELECT machine_id, parameter_name, round(any_value(mu), 6) AS mean, round(any_value(sd), 6) AS stddev,
    count(*) AS total_readings, CAST(sum(beyond) AS BIGINT) AS out_of_spec_count,
    {rate('sum(beyond)', 'count(*)')} AS oos_pct
  FROM spec GROUP BY machine_id, parameter_name),
watch AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY machine_id ORDER BY oos_pct DESC, parameter_name)
      AS INT) AS rank,
    CASE WHEN oos_pct > 6 THEN 'high' WHEN oos_pct > 4 THEN 'medium' ELSE 'low' END AS severity
  FROM profile WHERE oos_pct > 3)
"""
