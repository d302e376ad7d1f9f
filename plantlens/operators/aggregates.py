"""Aggregates over the fact that are taken before any dimension is joined.

The fact is reduced to its own keys first, with partial sums on the map side, and only the short
result meets the dimensions. A dimension may hold several rows per key; a join to the raw fact
would then repeat every fact row. The functions here give the same figures from the reduced rows:
`weight` says how many times each of them would have been repeated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plantlens.operators.parse import keyed_readings


def with_weight(dimension: DataFrame, *attributes: str) -> DataFrame:
    """Distinct attribute sets of a dimension, with the number of rows behind each."""
    return dimension.groupBy(*attributes).agg(F.count(F.lit(1)).alias("weight"))


# --- counting readings ---------------------------------------------------------------------


def readings_of_fact(fact: DataFrame) -> DataFrame:
    """Fact rows as the input of `count_readings`."""
    return fact.withColumn("parameters", F.lit(1))


def readings_of_silver(silver: DataFrame) -> DataFrame:
    """The same from readings that were not exploded: one row each, not one per parameter."""
    with_parameters = keyed_readings(silver).filter(F.size("telemetry") > 0)
    return with_parameters.withColumn("parameters", F.size("telemetry")).drop("telemetry")


def count_readings(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct readings, distinct flagged readings and flagged parameter rows per group.

    Rows are first reduced to one per group and reading. That step spreads a large group over
    all tasks, since the reading is part of the shuffle key, and needs no row expansion for the
    two distinct counts. A reading counts as flagged if any of its rows in the group is.
    """
    flagged_parameters = F.when(F.col("is_anomaly"), F.col("parameters")).otherwise(0)
    per_reading = rows.groupBy(*keys, "record_id").agg(
        F.bool_or("is_anomaly").alias("flagged"),
        F.sum(flagged_parameters).alias("flagged_parameters"),
    )
    return per_reading.groupBy(*keys).agg(
        F.count("record_id").alias("total_readings"),
        F.count(F.when(F.col("flagged"), F.col("record_id"))).alias("anomaly_readings"),
        F.sum("flagged_parameters").alias("flagged_parameters"),
    )


# --- moments of a value --------------------------------------------------------------------


def moments(rows: DataFrame, keys: list[str], value: str = "parameter_value") -> DataFrame:
    """Row count, value count, mean, sample deviation, squared deviations and extremes."""
    x = F.col(value)
    measured = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(x).alias("n"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("sd"),
        F.min(x).alias("low"),
        F.max(x).alias("high"),
    )
    squares = F.col("sd") * F.col("sd") * (F.col("n") - 1)
    # A single value deviates by nothing, unless it is NaN or infinite.
    alone = F.col("mean") - F.col("mean")
    return measured.withColumn("m2", F.coalesce(squares, alone, F.lit(0.0)))


def _sample_sd(m2: Column, n: Column) -> Column:
    return F.when(n > 1, F.sqrt(m2 / (n - 1)))


def moments_of_sums(parts: DataFrame) -> DataFrame:
    """The columns of `moments` from counts, mean and squared deviations; no value has no mean."""
    n = F.col("n")
    return parts.withColumns(
        {"mean": F.when(n > 0, F.col("mean")), "sd": _sample_sd(F.col("m2"), n)}
    )


def repeat_moments(parts: DataFrame) -> DataFrame:
    """Moments of rows that occur `weight` times each. A weight of 1 changes nothing."""
    weight = F.col("weight")
    n = F.col("n") * weight
    m2 = F.col("m2") * weight
    return parts.withColumns(
        {
            "n_rows": F.col("n_rows") * weight,
            "n": n,
            "m2": m2,
            "sd": F.when(weight == 1, F.col("sd")).otherwise(_sample_sd(m2, n)),
        }
    )


def merge_moments(parts: DataFrame, keys: list[str]) -> DataFrame:
    """Moments of groups that were measured in parts.

    Squared deviations are moved to the common mean before they are added, which keeps their
    digits when the mean is large. A group with a single part keeps its figures as they are.
    """
    group = Window.partitionBy(*keys)
    n, mean = F.col("n"), F.col("mean")
    shared = parts.withColumn(
        "_mean", F.sum(n * mean).over(group) / F.nullif(F.sum(n).over(group), F.lit(0))
    )
    shift = mean - F.col("_mean")
    moved = F.col("m2") + F.coalesce(n * shift * shift, F.lit(0.0))
    merged = shared.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_parts"),
        F.sum("n_rows").alias("n_rows"),
        F.sum(n).alias("n"),
        F.sum(moved).alias("m2"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.first("_mean").alias("_mean"),
        F.first("mean").alias("_only_mean"),
        F.first("sd").alias("_only_sd"),
    )
    single = F.col("_parts") == 1
    return merged.select(
        *keys,
        "n_rows",
        "n",
        F.when(single, F.col("_only_mean")).otherwise(F.col("_mean")).alias("mean"),
        F.when(single, F.col("_only_sd"))
        .otherwise(_sample_sd(F.col("m2"), F.col("n")))
        .alias("sd"),
        "low",
        "high",
        "m2",
    )
