"""Projections, predicates and scalar functions over the readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.functions import calendar, measures, stages
from plantlens.functions.sql import create_functions
from plantlens.operators.findings import flagged_machines
from plantlens.operators.out_of_spec import flag_out_of_spec, parameter_stats, varying
from plantlens.operators.parse import fact_rows, keyed_readings, parameter_rows, parse_lines
from plantlens.plans.kpis import POWER, VIBRATION
from plantlens.registry.bindings import damaged_lines, fact, landing, silver, table
from plantlens.registry.core import query
from plantlens.registry.oracle import WITH, rate
from plantlens.registry.products import SILVER_SQL, flat_silver
from plantlens.sources.landing import read_lines


@query("prj_01_rename", f"{WITH} SELECT record_id FROM silver")
def rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = read_lines(spark, landing(spark, sf_dir))
    return renamed.select(F.get_json_object("raw_content", "$.record_id").alias("record_id"))


@query(
    "prj_02_select_alias",
    f"""{WITH} SELECT record_id AS reading, machine_id AS machine,
    event_timestamp AS measured_at FROM silver""",
)
def select_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_readings(silver(spark, sf_dir)).select(
        F.col("record_id").alias("reading"),
        F.col("machine_id").alias("machine"),
        F.col("event_timestamp").alias("measured_at"),
    )


@query(
    "prj_03_add_column",
    f"""{WITH} SELECT record_id, line_id,
    round(target_frequency_band_ghz_max - target_frequency_band_ghz_min, 3) AS bandwidth
    FROM silver""",
)
def add_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    width = measures.bandwidth(
        F.col("target_frequency_band_ghz_max"), F.col("target_frequency_band_ghz_min")
    )
    return silver(spark, sf_dir).withColumn("bandwidth", width).select(
        "record_id", "line_id", "bandwidth"
    )


@query(
    "prj_04_star_and_subquery",
    f"""{WITH} SELECT machine_id, count(*) AS readings, max(hour_of_day) AS last_hour
    FROM silver GROUP BY machine_id""",
)
def star_and_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver(spark, sf_dir).createOrReplaceTempView("plantlens_silver")
    return spark.sql(
        """
        WITH keyed AS (SELECT *, hour(event_timestamp) AS hour_of_day FROM plantlens_silver)
        SELECT machine_id, count(*) AS readings, max(hour_of_day) AS last_hour
        FROM (SELECT machine_id, hour_of_day FROM keyed) GROUP BY machine_id
        """
    )


@query("prj_05_struct_flattening", SILVER_SQL)
def struct_flattening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_silver(parse_lines(read_lines(spark, landing(spark, sf_dir))))


@query(
    "prj_06_stage_sequence",
    f"""{WITH} SELECT record_id, CAST(stage_sequence AS INT) AS stage_sequence
    FROM silver JOIN stage USING (process_stage)""",
)
def stage_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    sequence = stages.stage_sequence(F.col("process_stage"))
    return silver(spark, sf_dir).select("record_id", sequence.alias("stage_sequence"))


@query(
    "prj_07_stage_category",
    f"{WITH} SELECT record_id, stage_category FROM silver JOIN stage USING (process_stage)",
)
def stage_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    category = stages.stage_category(F.col("process_stage"))
    return silver(spark, sf_dir).select("record_id", category.alias("stage_category"))


@query(
    "prj_08_shift",
    f"""{WITH} SELECT record_id, CASE WHEN hour_of_day < 6 OR hour_of_day > 21 THEN 'Night'
    WHEN hour_of_day < 14 THEN 'Day' ELSE 'Swing' END AS shift FROM silver""",
)
def shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    hour = calendar.hour_of_day(F.col("event_timestamp"))
    return silver(spark, sf_dir).select("record_id", calendar.shift(hour).alias("shift"))


@query(
    "prj_09_weekend",
    f"{WITH} SELECT record_id, dayofweek(event_timestamp) IN (0, 6) AS is_weekend FROM silver",
)
def weekend(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = calendar.is_weekend(F.to_date("event_timestamp"))
    return silver(spark, sf_dir).select("record_id", flag.alias("is_weekend"))


@query(
    "prj_10_bandwidth",
    f"""{WITH} SELECT line_id, round(max(target_frequency_band_ghz_max)
    - min(target_frequency_band_ghz_min), 3) AS target_bandwidth_ghz FROM silver GROUP BY line_id""",
)
def bandwidth(spark: SparkSession, sf_dir: str) -> DataFrame:
    width = measures.bandwidth(
        F.max("target_frequency_band_ghz_max"), F.min("target_frequency_band_ghz_min")
    )
    return silver(spark, sf_dir).groupBy("line_id").agg(width.alias("target_bandwidth_ghz"))


@query(
    "prj_11_out_of_spec_flag",
    f"""{WITH} SELECT record_id, parameter_name, beyond AS is_out_of_spec FROM spec""",
)
def out_of_spec_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = flag_out_of_spec(fact(spark, sf_dir))
    return flagged.select("record_id", "parameter_name", "is_out_of_spec")


@query(
    "prj_15_functions_in_sql",
    f"""{WITH} SELECT record_id, date_key, CASE WHEN hour_of_day < 6 OR hour_of_day > 21 THEN 'Night'
      WHEN hour_of_day < 14 THEN 'Day' ELSE 'Swing' END AS shift,
    dayofweek(event_timestamp) IN (0, 6) AS is_weekend,
    CAST(stage_sequence AS INT) AS stage_sequence, stage_category,
    round(target_frequency_band_ghz_max - target_frequency_band_ghz_min, 3) AS bandwidth_ghz
    FROM silver JOIN stage USING (process_stage)""",
)
def functions_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    create_functions(spark)
    return spark.sql(
        """
        SELECT record_id, date_key_of(event_timestamp) AS date_key,
          shift_of(hour(event_timestamp)) AS shift,
          is_weekend_day(to_date(event_timestamp)) AS is_weekend,
          stage_sequence_of(process_stage) AS stage_sequence,
          stage_category_of(process_stage) AS stage_category,
          bandwidth_of(target_frequency_band_ghz_max, target_frequency_band_ghz_min)
            AS bandwidth_ghz
        FROM {readings}""",
        readings=silver(spark, sf_dir),
    )


@query(
    "prj_16_measures_in_sql",
    f"""{WITH}, measured AS (SELECT machine_id, parameter_name, sum(beyond) AS beyond, count(*) AS n,
      any_value(mu) AS mu, any_value(sd) AS sd FROM spec GROUP BY ALL)
    SELECT machine_id, parameter_name, {rate('beyond', 'n')} AS oos_pct,
      round(CASE WHEN mu <> 0 THEN sd / abs(mu) END, 6) AS variation,
      CASE WHEN {rate('beyond', 'n')} > 6 THEN 'high' WHEN {rate('beyond', 'n')} > 4 THEN 'medium'
        ELSE 'low' END AS severity
    FROM measured""",
)
def measures_in_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    create_functions(spark)
    rows = fact(spark, sf_dir)
    return spark.sql(
        """
        SELECT machine_id, parameter_name, CAST(pct AS DOUBLE) AS oos_pct,
          round(variation_of(mu, sd), 6) AS variation, severity_of(pct) AS severity
        FROM (
          SELECT machine_id, parameter_name, first(overall_mean) AS mu, first(overall_stddev) AS sd,
            rate_pct_of(
              sum(out_of_spec_flag_of(parameter_value, overall_mean, overall_stddev)), count(*)
            ) AS pct
          FROM {rows} JOIN {series} USING (machine_id, parameter_name)
          GROUP BY machine_id, parameter_name)""",
        rows=rows,
        series=varying(parameter_stats(rows)),
    )


@query("prj_12_date_key_and_hour", f"{WITH} SELECT record_id, date_key, hour_of_day FROM silver")
def date_key_and_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keyed_readings(silver(spark, sf_dir)).select("record_id", "date_key", "hour_of_day")


@query(
    "prj_13_map_explode",
    f"{WITH} SELECT record_id, parameter_name, parameter_value FROM fact",
)
def map_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fact_rows(silver(spark, sf_dir))
    return rows.select("record_id", "parameter_name", "parameter_value")


# --- predicates ----------------------------------------------------------------------------


@query(
    "flt_01_not_null",
    f"{WITH} SELECT record_id FROM silver WHERE event_type IN ('error', 'view', 'purchase')",
)
def not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = parse_lines(damaged_lines(spark, sf_dir))
    return readings.filter(F.col("event_timestamp").isNotNull()).select("record_id")


@query(
    "flt_02_parameter_equality",
    f"""{WITH} SELECT record_id, parameter_name, parameter_value FROM fact
    WHERE parameter_name IN ('vibration_mm_s_rms', 'power_consumption_kw')""",
)
def parameter_equality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One parameter from the exploded fact, the other straight from the map."""
    readings = silver(spark, sf_dir)
    vibration = fact_rows(readings).filter(F.col("parameter_name") == VIBRATION)
    rows = vibration.unionByName(parameter_rows(readings, POWER))
    return rows.select("record_id", "parameter_name", "parameter_value")


@query(
    "flt_03_aggregate_filter",
    f"""{WITH} SELECT machine_id, parameter_name, round(mu, 6) AS overall_mean,
    round(sd, 6) AS overall_stddev FROM series WHERE sd > 0""",
)
def aggregate_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return varying(parameter_stats(fact(spark, sf_dir))).select(
        "machine_id",
        "parameter_name",
        F.round("overall_mean", 6).alias("overall_mean"),
        F.round("overall_stddev", 6).alias("overall_stddev"),
    )


@query("flt_04_flag", f"{WITH} SELECT record_id, machine_id FROM silver WHERE is_anomaly")
def flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).filter("is_anomaly").select("record_id", "machine_id")


@query(
    "flt_04b_flagged_machines",
    f"{WITH} SELECT DISTINCT machine_id FROM silver WHERE is_anomaly",
)
def machines_with_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged_machines(silver(spark, sf_dir))


@query(
    "flt_05_in_list",
    f"{WITH} SELECT record_id FROM silver WHERE dayofweek(event_timestamp) + 1 IN (1, 7)",
)
def in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    weekend_day = calendar.is_weekend(F.col("event_timestamp"))
    return silver(spark, sf_dir).filter(weekend_day).select("record_id")


@query(
    "flt_06_between",
    f"{WITH} SELECT record_id, hour_of_day FROM silver WHERE hour_of_day BETWEEN 6 AND 13",
)
def between(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = keyed_readings(silver(spark, sf_dir))
    return keyed.filter(F.col("hour_of_day").between(6, 13)).select("record_id", "hour_of_day")


@query(
    "flt_07_deviation",
    f"{WITH} SELECT record_id, parameter_name, parameter_value FROM spec WHERE beyond = 1",
)
def deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = flag_out_of_spec(fact(spark, sf_dir))
    far = measures.is_out_of_spec(
        F.col("parameter_value"), F.col("overall_mean"), F.col("overall_stddev")
    )
    return flagged.filter(far).select("record_id", "parameter_name", "parameter_value")


# --- scalar functions ----------------------------------------------------------------------


@query(
    "fn_01_round",
    """SELECT event_id, round(value / 7, 2) AS r2, round(value / 7, 3) AS r3,
    round(value / 7, 4) AS r4, round(value / 7, 6) AS r6 FROM events""",
)
def rounding(spark: SparkSession, sf_dir: str) -> DataFrame:
    digits = [F.round(F.col("value") / 7, d).alias(f"r{d}") for d in (2, 3, 4, 6)]
    return table(spark, sf_dir, "events").select("event_id", *digits)


@query("fn_02_abs", "SELECT event_id, round(abs(value - 50), 6) AS distance FROM events")
def absolute(spark: SparkSession, sf_dir: str) -> DataFrame:
    distance = F.round(F.abs(F.col("value") - 50), 6)
    return table(spark, sf_dir, "events").select("event_id", distance.alias("distance"))


@query(
    "fn_03_arithmetic",
    f"""{WITH} SELECT record_id, value + k AS total, value - k AS gap, value * k AS product,
    value / (k + 1) AS ratio,
    value > k AND k >= 10 AS above FROM silver""",
)
def arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.element_at("telemetry", F.lit(VIBRATION))
    k = F.element_at("telemetry", F.lit(POWER))
    return silver(spark, sf_dir).select(
        "record_id",
        (value + k).alias("total"),
        (value - k).alias("gap"),
        (value * k).alias("product"),
        (value / (k + 1)).alias("ratio"),
        ((value > k) & (k >= 10)).alias("above"),
    )


@query(
    "fn_04_null_handling",
    f"""{WITH} SELECT record_id, nullif(hour_of_day, 0) AS hour_or_null,
    film IS NOT NULL AS has_film FROM silver""",
)
def null_handling(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = keyed_readings(silver(spark, sf_dir))
    return keyed.select(
        "record_id",
        F.nullif("hour_of_day", F.lit(0)).alias("hour_or_null"),
        F.element_at("telemetry", F.lit("film_stress_mpa")).isNotNull().alias("has_film"),
    )


@query(
    "fn_05_conditional",
    f"""{WITH}, pct AS (SELECT machine_id, {rate('count(*) FILTER (is_anomaly)', 'count(*)')} AS p
      FROM silver GROUP BY machine_id)
    SELECT machine_id, p AS flagged_pct,
    CASE WHEN p > 6 THEN 'high' WHEN p > 4 THEN 'medium' ELSE 'low' END AS band FROM pct""",
)
def conditional(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = measures.rate_pct(F.count_if("is_anomaly"), F.count(F.lit(1)))
    rates = silver(spark, sf_dir).groupBy("machine_id").agg(share.alias("pct"))
    return rates.select(
        "machine_id",
        F.col("pct").cast("double").alias("flagged_pct"),
        measures.severity(F.col("pct")).alias("band"),
    )


@query(
    "fn_06_cast",
    f"""{WITH} SELECT record_id, CAST(event_timestamp AS DATE) AS day,
    CAST(strftime(event_timestamp, '%Y%m%d') AS INT) AS day_number FROM silver""",
)
def cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    when = F.col("event_timestamp")
    return silver(spark, sf_dir).select(
        "record_id",
        when.cast("date").alias("day"),
        calendar.date_key(when).alias("day_number"),
    )


@query(
    "fn_07_date_parts",
    """SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INT) AS y,
    CAST(quarter(l_shipdate) AS INT) AS q, CAST(month(l_shipdate) AS INT) AS m,
    CAST(day(l_shipdate) AS INT) AS d, CAST(dayofweek(l_shipdate) + 1 AS INT) AS weekday,
    CAST(weekofyear(l_shipdate) AS INT) AS week FROM lineitem""",
)
def date_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ship_days(spark, sf_dir).selectExpr(
        "l_orderkey",
        "l_linenumber",
        "year AS y",
        "quarter AS q",
        "month AS m",
        "day_of_month AS d",
        "day_of_week AS weekday",
        "week_of_year AS week",
    )


def _ship_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar columns over seven years of days."""
    day = F.to_date("l_shipdate")
    items = table(spark, sf_dir, "lineitem")
    return items.select("l_orderkey", "l_linenumber", *calendar.calendar_columns(day))


@query("fn_08_hour", "SELECT event_id, CAST(hour(ts) AS INT) AS hour_of_day FROM events")
def hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = calendar.hour_of_day(F.col("ts")).alias("hour_of_day")
    return table(spark, sf_dir, "events").select("event_id", hours)


@query(
    "fn_09_date_format",
    """SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y%m%d') AS day_text,
    monthname(l_shipdate) AS month_name, dayname(l_shipdate) AS day_name FROM lineitem""",
)
def date_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ship_days(spark, sf_dir).select(
        "l_orderkey",
        "l_linenumber",
        F.col("date_key").cast("string").alias("day_text"),
        "month_name",
        "day_name",
    )


@query(
    "fn_10_parse_time",
    f"""{WITH} SELECT record_id, CASE WHEN event_type <> 'signup'
    THEN date_trunc('milliseconds', event_timestamp) END AS event_timestamp
    FROM silver WHERE event_type <> 'click'""",
)
def parse_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times that do not parse are NULL."""
    readings = parse_lines(damaged_lines(spark, sf_dir)).filter("record_id IS NOT NULL")
    return readings.select(
        "record_id", F.col("event_timestamp").cast("timestamp_ntz").alias("event_timestamp")
    )


@query(
    "fn_11_processing_time",
    f"{WITH} SELECT machine_id, count(*) AS loaded_after_event FROM silver GROUP BY machine_id",
)
def processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = parse_lines(read_lines(spark, landing(spark, sf_dir)))
    later = F.count_if(F.col("_loaded_at") > F.col("event_timestamp"))
    return readings.groupBy("machine_id").agg(later.alias("loaded_after_event"))


@query(
    "fn_12_from_json",
    f"""{WITH} SELECT event_type = 'click' AS unparsed, count(*) AS lines
    FROM silver GROUP BY ALL""",
)
def from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that do not parse stay, with all fields NULL."""
    readings = parse_lines(damaged_lines(spark, sf_dir))
    unparsed = F.col("record_id").isNull() & F.col("telemetry").isNull()
    return readings.groupBy(unparsed.alias("unparsed")).agg(F.count(F.lit(1)).alias("lines"))


@query(
    "fn_13_explode_map",
    f"{WITH} SELECT parameter_name, count(*) AS rows FROM fact GROUP BY parameter_name",
)
def explode_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact(spark, sf_dir).groupBy("parameter_name").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "fn_14_file_metadata",
    f"""{WITH} SELECT CASE WHEN event_timestamp < TIMESTAMP '2024-01-16' THEN 'batch'
    ELSE 'streaming' END AS delivery, line_id, count(*) AS lines, true AS one_path_per_file
    FROM silver GROUP BY ALL""",
)
def file_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ways to ask for the file of a row give the same path."""
    path = F.col("_metadata.file_path")
    lines = spark.read.option("recursiveFileLookup", "true").text(landing(spark, sf_dir))
    located = lines.select(
        F.regexp_extract(path, "/(batch|streaming)/", 1).alias("delivery"),
        F.regexp_extract(path, "/line_id=([^/]+)/", 1).alias("line_id"),
        F.endswith(F.input_file_name(), F.col("_metadata.file_name")).alias("same_file"),
    )
    return located.groupBy("delivery", "line_id").agg(
        F.count(F.lit(1)).alias("lines"), F.bool_and("same_file").alias("one_path_per_file")
    )
