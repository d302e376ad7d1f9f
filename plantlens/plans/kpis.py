"""The seven KPIs, each a function of the fact (or readings) and the dimensions it needs.

Every KPI reduces the fact to its keys first and joins the dimensions to the short result, see
`operators.aggregates`. The joins carry no hints: both sides are short, and Spark picks the
join from their sizes at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.functions.calendar import shift
from plantlens.functions.measures import coefficient_of_variation, rate_pct
from plantlens.operators.aggregates import (
    count_readings,
    merge_moments,
    moments,
    repeat_moments,
    with_weight,
)
from plantlens.operators.joins import lookup_join
from plantlens.operators.out_of_spec import count_out_of_spec

# The parameters of the vibration and power KPIs.
VIBRATION = "vibration_mm_s_rms"
POWER = "power_consumption_kw"
# The keys of the hourly KPIs of one parameter.
HOURLY = ["line_id", "machine_id", "date_key", "hour_of_day"]


def _anomaly_measures() -> list:
    rate = rate_pct(F.col("anomaly_readings"), F.col("total_readings"))
    return ["total_readings", "anomaly_readings", rate.alias("anomaly_rate_pct")]


def _rounded(digits: int, **names: str) -> list:
    return [F.round(column, digits).alias(name) for name, column in names.items()]


def anomaly_rate(readings: DataFrame, lines: DataFrame, machines: DataFrame) -> DataFrame:
    """Flagged share of readings per line, machine, day and hour.

    Distinct counts do not change when a dimension repeats rows, so its attribute sets suffice.
    """
    counts = count_readings(readings, ["line_id", "machine_id", "date_key", "hour_of_day"])
    return (
        counts.join(lines.select("line_id", "line_name", "product_type").distinct(), "line_id")
        .join(machines.select("machine_id", "machine_type").distinct(), "machine_id")
        .select(
            "line_id",
            "line_name",
            "product_type",
            "machine_id",
            "machine_type",
            "date_key",
            "hour_of_day",
            *_anomaly_measures(),
        )
    )


def _with_line_and_machine(
    measured: DataFrame,
    lines: DataFrame,
    machines: DataFrame,
    line_columns: list[str],
    machine_columns: list[str],
) -> DataFrame:
    """Moments per line, machine, day and hour with the attributes of line and machine."""
    by_line = with_weight(lines, "line_id", *line_columns)
    by_machine = with_weight(machines, "machine_id", *machine_columns).withColumnRenamed(
        "weight", "machine_weight"
    )
    joined = measured.join(by_line, "line_id").join(by_machine, "machine_id")
    return repeat_moments(joined.withColumn("weight", F.col("weight") * F.col("machine_weight")))


def vibration_trend(fact: DataFrame, lines: DataFrame, machines: DataFrame) -> DataFrame:
    """Hourly vibration statistics per machine."""
    rows = fact.filter(F.col("parameter_name") == VIBRATION)
    return vibration_of_moments(moments(rows, HOURLY), lines, machines)


def vibration_of_moments(
    measured: DataFrame, lines: DataFrame, machines: DataFrame
) -> DataFrame:
    joined = _with_line_and_machine(
        measured, lines, machines, ["line_name"], ["machine_type", "process_stage"]
    )
    return joined.select(
        "line_id",
        "line_name",
        "machine_id",
        "machine_type",
        "process_stage",
        "date_key",
        "hour_of_day",
        *_rounded(
            6,
            avg_vibration_mm_s_rms="mean",
            max_vibration_mm_s_rms="high",
            min_vibration_mm_s_rms="low",
            stddev_vibration="sd",
        ),
        F.col("n_rows").alias("reading_count"),
    )


def parameter_stability(fact: DataFrame, machines: DataFrame, stages: DataFrame) -> DataFrame:
    """Hourly coefficient of variation per machine and parameter.

    The stage of the fact row decides the category. A machine may report several stages of one
    category, which are measured apart and then merged.
    """
    measured = moments(
        fact,
        ["line_id", "machine_id", "process_stage", "parameter_name", "date_key", "hour_of_day"],
    )
    return stability_of_moments(measured, machines, stages)


def stability_of_moments(
    measured: DataFrame, machines: DataFrame, stages: DataFrame
) -> DataFrame:
    by_machine = with_weight(machines, "machine_id", "machine_type").withColumnRenamed(
        "weight", "machine_weight"
    )
    by_stage = with_weight(stages, "process_stage", "stage_category")
    joined = measured.join(by_machine, "machine_id").join(by_stage, "process_stage")
    repeated = repeat_moments(
        joined.withColumn("weight", F.col("weight") * F.col("machine_weight"))
    )
    keys = [
        "line_id",
        "machine_id",
        "machine_type",
        "stage_category",
        "parameter_name",
        "date_key",
        "hour_of_day",
    ]
    index = coefficient_of_variation(F.col("mean"), F.col("sd"))
    return merge_moments(repeated, keys).select(
        *keys,
        *_rounded(6, mean_value="mean", stddev_value="sd"),
        F.round(index, 6).alias("stability_index"),
        F.col("n_rows").alias("reading_count"),
    )


def process_stage_anomaly_rate(
    readings: DataFrame, stages: DataFrame, lines: DataFrame
) -> DataFrame:
    """Flagged share of readings per stage category, line and day.

    A reading may occur under several stages of a category and counts once, so the category is
    looked up before readings are counted. `stages` should be stored, its size is measured.
    """
    categories = stages.select("process_stage", "stage_category", "stage_sequence").distinct()
    with_category = lookup_join(readings, categories, ["process_stage"])
    counts = count_readings(
        with_category, ["stage_category", "stage_sequence", "line_id", "date_key"]
    )
    return counts.join(lines.select("line_id", "product_type").distinct(), "line_id").select(
        "stage_category",
        "stage_sequence",
        "line_id",
        "product_type",
        "date_key",
        *_anomaly_measures(),
    )


def power_consumption(fact: DataFrame, lines: DataFrame, machines: DataFrame) -> DataFrame:
    """Hourly power statistics per machine, in kW."""
    rows = fact.filter(F.col("parameter_name") == POWER)
    return power_of_moments(moments(rows, HOURLY), lines, machines)


def power_of_moments(measured: DataFrame, lines: DataFrame, machines: DataFrame) -> DataFrame:
    joined = _with_line_and_machine(
        measured, lines, machines, ["line_name", "product_type"], ["machine_type"]
    )
    return joined.select(
        "line_id",
        "line_name",
        "product_type",
        "machine_id",
        "machine_type",
        "date_key",
        "hour_of_day",
        *_rounded(
            4, avg_power_kw="mean", max_power_kw="high", min_power_kw="low", stddev_power_kw="sd"
        ),
        F.col("n_rows").alias("reading_count"),
    )


def hourly_anomaly_heatmap(readings: DataFrame, lines: DataFrame) -> DataFrame:
    """Flagged readings per line, day and hour, with the shift.

    `anomaly_param_violations` counts every parameter row of a flagged reading, whether or not
    that parameter is at fault; `operators.limits` finds the ones that are.
    """
    counts = count_readings(readings, ["line_id", "date_key", "hour_of_day"])
    by_line = with_weight(lines, "line_id", "line_name", "product_type")
    return counts.join(by_line, "line_id").select(
        "line_id",
        "line_name",
        "product_type",
        "date_key",
        "hour_of_day",
        shift(F.col("hour_of_day")).alias("shift"),
        *_anomaly_measures(),
        (F.col("flagged_parameters") * F.col("weight")).alias("anomaly_param_violations"),
    )


def parameter_out_of_spec(
    fact: DataFrame, machines: DataFrame, stages: DataFrame, stats: DataFrame | None = None
) -> DataFrame:
    """Daily share of values beyond two deviations from the all-time mean of their series.

    The stage is that of the machine dimension, not that of the fact row.
    """
    counted = count_out_of_spec(
        fact, ["line_id", "machine_id", "parameter_name", "date_key"], stats
    )
    staged = with_weight(
        machines.join(stages, "process_stage"), "machine_id", "machine_type", "stage_category"
    )
    joined = counted.join(staged, "machine_id")
    total = F.col("n_rows") * F.col("weight")
    beyond = F.col("out_of_spec") * F.col("weight")
    return joined.select(
        "line_id",
        "machine_type",
        "machine_id",
        "stage_category",
        "parameter_name",
        "date_key",
        *_rounded(6, param_mean="param_mean", param_stddev="param_stddev"),
        total.alias("total_readings"),
        beyond.alias("out_of_spec_count"),
        rate_pct(beyond, total).alias("out_of_spec_rate_pct"),
    )
