"""Checking values against the limits specified per machine and parameter."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.operators.joins import lookup_join, require_unique
from plantlens.schemas import LIMITS_SCHEMA


def read_limits(spark: SparkSession, path: str) -> DataFrame:
    """Limits from JSON lines, one object per machine and parameter; missing limits are NULL."""
    return spark.read.schema(LIMITS_SCHEMA).json(path)


def check_limits(fact: DataFrame, limits: DataFrame, **join_options) -> DataFrame:
    """Every fact row with `violation` and the `side` on which its value lies outside.

    Limits come in four forms: an upper one (as `threshold` or as `threshold_high`), a lower
    one, or both. A value on the limit is inside; one without limits violates nothing. Limits
    listed twice for a machine and parameter are refused: they would count its values twice.
    """
    require_unique(limits, ["machine_id", "parameter_name"])
    bounds = limits.select(
        "machine_id",
        "parameter_name",
        F.coalesce("threshold", "threshold_high").alias("_upper"),
        F.col("threshold_low").alias("_lower"),
    )
    value = F.col("parameter_value")
    side = F.when(value > F.col("_upper"), "high").when(value < F.col("_lower"), "low")
    checked = lookup_join(fact, bounds, ["machine_id", "parameter_name"], "left", **join_options)
    return checked.withColumns({"violation": side.isNotNull(), "side": side}).drop(
        "_upper", "_lower"
    )


def tally_violations(checked: DataFrame) -> DataFrame:
    """Per line: readings, flagged readings, and parameter values outside their limits."""
    per_reading = checked.groupBy("line_id", "record_id").agg(
        F.bool_or("is_anomaly").alias("flagged"),
        F.count_if("violation").alias("violations"),
        F.count(F.lit(1)).alias("parameters"),
    )
    known = F.col("record_id")
    return per_reading.groupBy("line_id").agg(
        F.count(known).alias("readings"),
        F.count(F.when(F.col("flagged"), known)).alias("flagged_readings"),
        F.sum("parameters").alias("parameter_values"),
        F.sum("violations").alias("violating_values"),
    )
