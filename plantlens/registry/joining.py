"""Joins of the fact with its dimensions and statistics, and aggregates over the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.functions.measures import coefficient_of_variation, rate_pct
from plantlens.operators.aggregates import (
    count_readings,
    merge_moments,
    moments,
    readings_of_fact,
    readings_of_silver,
)
from plantlens.operators.attributes import count_by_attributes
from plantlens.operators.dimensions import (
    LINE_ATTRIBUTES,
    MACHINE_ATTRIBUTES,
    machines,
    production_lines,
)
from plantlens.operators.joins import lookup_join
from plantlens.operators.out_of_spec import (
    SERIES,
    count_out_of_spec,
    flag_out_of_spec,
    parameter_stats,
)
from plantlens.registry.bindings import (
    dimensions,
    fact,
    landing,
    repeated_ids,
    silver,
)
from plantlens.registry.core import query
from plantlens.registry.oracle import WITH, rate
from plantlens.registry.products import with_double_rates
from plantlens.session import materialize
from plantlens.sources.landing import read_json_inferred

ROW = ["record_id", "parameter_name", "parameter_value"]
ROW_SQL = "record_id, parameter_name, parameter_value"


@query(
    "jn_01_fact_line",
    f"""{WITH} SELECT {ROW_SQL}, line.line_name, line.product_type, line.target_bandwidth_ghz
    FROM fact JOIN line ON fact.line_id = line.line_id""",
)
def fact_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = materialize(dimensions(spark, sf_dir).line)
    joined = lookup_join(fact(spark, sf_dir), lines, ["line_id"])
    return joined.select(*ROW, "line_name", "product_type", "target_bandwidth_ghz")


@query(
    "jn_02_fact_machine",
    f"""{WITH} SELECT {ROW_SQL}, machine.machine_type
    FROM fact JOIN machine ON fact.machine_id = machine.machine_id""",
)
def fact_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = dimensions(spark, sf_dir).machine.select("machine_id", "machine_type")
    joined = lookup_join(fact(spark, sf_dir), materialize(dim), ["machine_id"])
    return joined.select(*ROW, "machine_type")


@query(
    "jn_03_fact_stage",
    f"""{WITH} SELECT {ROW_SQL}, stage.stage_sequence, stage.stage_category
    FROM fact JOIN stage ON fact.process_stage = stage.process_stage""",
)
def fact_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = materialize(dimensions(spark, sf_dir).stage)
    joined = lookup_join(fact(spark, sf_dir), stages, ["process_stage"])
    return joined.select(*ROW, "stage_sequence", "stage_category")


@query(
    "jn_03b_fact_stage_too_large_to_broadcast",
    f"""{WITH} SELECT {ROW_SQL}, stage.stage_sequence, stage.stage_category
    FROM fact JOIN stage ON fact.process_stage = stage.process_stage""",
)
def fact_stage_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join as it runs for a lookup beyond the broadcast bound."""
    stages = materialize(dimensions(spark, sf_dir).stage)
    joined = lookup_join(
        fact(spark, sf_dir), stages, ["process_stage"], max_bytes=0, heavy_share=5
    )
    return joined.select(*ROW, "stage_sequence", "stage_category")


@query(
    "jn_04_fact_own_statistics",
    f"""{WITH} SELECT {ROW_SQL}, round(mu, 6) AS overall_mean, round(sd, 6) AS overall_stddev
    FROM spec""",
)
def fact_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = flag_out_of_spec(fact(spark, sf_dir))
    return joined.select(
        *ROW,
        F.round("overall_mean", 6).alias("overall_mean"),
        F.round("overall_stddev", 6).alias("overall_stddev"),
    )


@query(
    "jn_04c_hot_lookup",
    f"""{WITH}, tagged AS (SELECT line_id, unnest(range(0, 40)) AS tag FROM line)
    SELECT line_id, tag, count(*) AS rows, count(*) FILTER (is_anomaly) AS flagged_rows
    FROM fact JOIN tagged USING (line_id) GROUP BY ALL""",
)
def hot_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lookup of long texts, larger than a broadcast, with 40 rows behind each of four hot keys."""
    tags = F.explode(F.sequence(F.lit(0), F.lit(39))).alias("tag")
    text = F.repeat(F.lit("x"), 100_000).alias("text")
    lines = dimensions(spark, sf_dir).line.select("line_id", tags).select("*", text)
    joined = lookup_join(fact(spark, sf_dir), materialize(lines), ["line_id"])
    return joined.groupBy("line_id", F.col("tag").cast("bigint").alias("tag")).agg(
        F.count("text").alias("rows"), F.count_if("is_anomaly").alias("flagged_rows")
    )


@query(
    "jn_05_machine_stage",
    f"""{WITH} SELECT machine_id, machine_type, stage.process_stage, stage_category
    FROM machine JOIN stage ON machine.process_stage = stage.process_stage""",
)
def machine_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    dims = dimensions(spark, sf_dir)
    joined = dims.machine.join(dims.stage, "process_stage")
    return joined.select("machine_id", "machine_type", "process_stage", "stage_category")


@query(
    "jn_06_fact_date",
    f"""{WITH} SELECT day.is_weekend, count(*) AS fact_rows,
    count(*) FILTER (is_anomaly) AS flagged_rows
    FROM fact JOIN day ON fact.date_key = day.date_key GROUP BY ALL""",
)
def fact_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekdays against weekends."""
    days = {"date_key": dimensions(spark, sf_dir).date}
    return count_by_attributes(fact(spark, sf_dir), days, ["is_weekend"], "fact_rows")


# --- aggregates ----------------------------------------------------------------------------


@query(
    "agg_01_distinct_rows",
    f"{WITH} SELECT DISTINCT {', '.join(LINE_ATTRIBUTES)} FROM silver",
)
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return production_lines(silver(spark, sf_dir)).select(*LINE_ATTRIBUTES)


@query(
    "agg_02_group_by_all",
    f"{WITH} SELECT {', '.join(MACHINE_ATTRIBUTES)} FROM silver GROUP BY ALL",
)
def group_by_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return machines(silver(spark, sf_dir))


@query(
    "agg_03_row_count",
    f"""{WITH} SELECT machine_id, parameter_name, count(*) AS reading_count
    FROM fact GROUP BY machine_id, parameter_name""",
)
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parameter_stats(fact(spark, sf_dir)).select(
        *SERIES, F.col("series_rows").alias("reading_count")
    )


@query(
    "agg_04_distinct_readings",
    f"""{WITH} SELECT machine_id, count(DISTINCT record_id) AS total_readings
    FROM fact GROUP BY machine_id""",
)
def distinct_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_readings(readings_of_fact(fact(spark, sf_dir)), ["machine_id"])
    return counts.select("machine_id", "total_readings")


@query(
    "agg_04b_distinct_repeated_ids",
    """WITH r AS (SELECT l_orderkey || '-' || l_linenumber AS id, l_returnflag = 'R' AS flagged,
      'M' || lpad(CAST(l_suppkey % 20 AS VARCHAR), 2, '0') AS machine_id FROM lineitem)
    SELECT machine_id, count(DISTINCT id) AS total_readings,
    count(DISTINCT id) FILTER (flagged) AS anomaly_readings,
    count(*) FILTER (flagged) AS flagged_parameters FROM r GROUP BY machine_id""",
)
def distinct_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that occur more than once in a group, with and without the flag."""
    return count_readings(repeated_ids(spark, sf_dir), ["machine_id"])


@query(
    "agg_05_conditional_distinct",
    f"""{WITH} SELECT line_id, date_key, count(DISTINCT record_id) FILTER (is_anomaly)
    AS anomaly_readings FROM fact GROUP BY line_id, date_key""",
)
def conditional_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_readings(readings_of_silver(silver(spark, sf_dir)), ["line_id", "date_key"])
    return counts.select("line_id", "date_key", "anomaly_readings")


@query(
    "agg_06_conditional_sum",
    f"""{WITH} SELECT line_id, date_key, count(*) FILTER (is_anomaly) AS flagged_rows
    FROM fact GROUP BY line_id, date_key""",
)
def conditional_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_readings(readings_of_fact(fact(spark, sf_dir)), ["line_id", "date_key"])
    return counts.select("line_id", "date_key", F.col("flagged_parameters").alias("flagged_rows"))


@query(
    "agg_07_average",
    f"""{WITH} SELECT machine_id, parameter_name, round(avg(parameter_value), 6) AS mean_6,
    round(avg(parameter_value), 4) AS mean_4 FROM fact GROUP BY machine_id, parameter_name""",
)
def average(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = moments(fact(spark, sf_dir), SERIES)
    return measured.select(
        *SERIES, F.round("mean", 6).alias("mean_6"), F.round("mean", 4).alias("mean_4")
    )


@query(
    "agg_08_min_max",
    f"""{WITH} SELECT machine_id, parameter_name, min(parameter_value) AS low,
    max(parameter_value) AS high FROM fact GROUP BY machine_id, parameter_name""",
)
def extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return moments(fact(spark, sf_dir), SERIES).select(*SERIES, "low", "high")


@query(
    "agg_09_sample_deviation",
    f"""{WITH} SELECT machine_id, parameter_name, date_key, hour_of_day,
    round(stddev_samp(parameter_value), 6) AS sd FROM fact GROUP BY ALL""",
)
def sample_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [*SERIES, "date_key", "hour_of_day"]
    return moments(fact(spark, sf_dir), keys).select(*keys, F.round("sd", 6).alias("sd"))


@query(
    "agg_09b_merged_deviation",
    f"""{WITH} SELECT machine_id, parameter_name, count(*) AS n_rows,
    round(avg(parameter_value), 6) AS mean, round(stddev_samp(parameter_value), 6) AS sd,
    min(parameter_value) AS low, max(parameter_value) AS high
    FROM fact GROUP BY machine_id, parameter_name""",
)
def merged_deviation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly moments merged to those of the whole series."""
    hourly = moments(fact(spark, sf_dir), [*SERIES, "date_key", "hour_of_day"])
    return merge_moments(hourly, SERIES).select(
        *SERIES, "n_rows", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"),
        "low", "high",
    )


@query(
    "agg_10_rate",
    f"""{WITH} SELECT machine_id, {rate('count(*) FILTER (is_anomaly)', 'count(*)')} AS rate_pct
    FROM silver GROUP BY machine_id""",
)
def rate_percent(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = rate_pct(F.count_if("is_anomaly"), F.count(F.lit(1))).alias("rate_pct")
    return with_double_rates(silver(spark, sf_dir).groupBy("machine_id").agg(share))


@query(
    "agg_11_variation",
    f"""{WITH} SELECT machine_id, parameter_name,
    round(CASE WHEN mu <> 0 THEN sd / abs(mu) END, 6) AS stability_index FROM series""",
)
def variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = coefficient_of_variation(F.col("mean"), F.col("sd"))
    measured = moments(fact(spark, sf_dir), SERIES)
    return measured.select(*SERIES, F.round(index, 6).alias("stability_index"))


@query(
    "agg_12_two_levels",
    f"""{WITH} SELECT machine_id, parameter_name, date_key, count(*) AS n_rows,
    CAST(sum(beyond) AS BIGINT) AS out_of_spec, round(any_value(mu), 6) AS param_mean,
    round(any_value(sd), 6) AS param_stddev
    FROM spec GROUP BY machine_id, parameter_name, date_key""",
)
def two_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_out_of_spec(fact(spark, sf_dir), [*SERIES, "date_key"])
    return counted.withColumns(
        {
            "param_mean": F.round("param_mean", 6),
            "param_stddev": F.round("param_stddev", 6),
        }
    )


@query(
    "agg_12b_two_levels_too_large_to_broadcast",
    f"""{WITH} SELECT machine_id, parameter_name, date_key, count(*) AS n_rows,
    CAST(sum(beyond) AS BIGINT) AS out_of_spec
    FROM spec GROUP BY machine_id, parameter_name, date_key""",
)
def two_levels_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The statistics joined as they are beyond the broadcast bound."""
    counted = count_out_of_spec(
        fact(spark, sf_dir), [*SERIES, "date_key"], max_bytes=0, heavy_share=10
    )
    return counted.drop("param_mean", "param_stddev")


@query(
    "agg_13_adhoc_count",
    f"""{WITH} SELECT line_id, machine_id, count(*) AS count FROM silver
    WHERE is_anomaly GROUP BY line_id, machine_id""",
)
def adhoc_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    readings = read_json_inferred(spark, landing(spark, sf_dir))
    return readings.filter("is_anomaly = true").groupBy("line_id", "machine_id").count()


@query(
    "agg_14_joined_attributes",
    f"""{WITH} SELECT machine_type, stage_category, parameter_name, count(*) AS rows,
    count(*) FILTER (is_anomaly) AS flagged_rows
    FROM fact JOIN machine ON fact.machine_id = machine.machine_id
      JOIN stage ON fact.process_stage = stage.process_stage GROUP BY ALL""",
)
def joined_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grouped by attributes of two dimensions."""
    dims = dimensions(spark, sf_dir)
    return count_by_attributes(
        fact(spark, sf_dir),
        {"machine_id": dims.machine.drop("process_stage"), "process_stage": dims.stage},
        ["machine_type", "stage_category", "parameter_name"],
    )
