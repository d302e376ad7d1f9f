"""Values far from the usual level of their own machine and parameter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.functions.measures import out_of_spec_flag
from plantlens.operators.joins import lookup_join
from plantlens.session import materialize

SERIES = ["machine_id", "parameter_name"]


def parameter_stats(fact: DataFrame) -> DataFrame:
    """Mean, sample deviation, rows and values per machine and parameter, over all days."""
    value = F.col("parameter_value")
    return fact.groupBy(*SERIES).agg(
        F.avg(value).alias("overall_mean"),
        F.stddev_samp(value).alias("overall_stddev"),
        F.count(F.lit(1)).alias("series_rows"),
        F.count(value).alias("series_values"),
    )


def varying(stats: DataFrame) -> DataFrame:
    """Mean and deviation of series that vary; a single value or a constant has no limits."""
    return stats.filter("overall_stddev > 0").select(*SERIES, "overall_mean", "overall_stddev")


def flag_out_of_spec(fact: DataFrame, stats: DataFrame | None = None, **join_options) -> DataFrame:
    """Fact rows of varying series, with their statistics and `is_out_of_spec` as 0 or 1.

    The statistics take a pass of their own and are stored, one row per series. The second pass
    joins them to the fact without shuffling it, as long as they fit a broadcast.
    """
    if stats is None:
        stats = materialize(varying(parameter_stats(fact)))
    joined = lookup_join(fact, stats, SERIES, **join_options)
    flag = out_of_spec_flag(
        F.col("parameter_value"), F.col("overall_mean"), F.col("overall_stddev")
    )
    return joined.withColumn("is_out_of_spec", flag)


def count_out_of_spec(
    fact: DataFrame, keys: list[str], stats: DataFrame | None = None, **join_options
) -> DataFrame:
    """Rows and out-of-spec rows per group of `keys`, which include the series."""
    flagged = flag_out_of_spec(fact, stats, **join_options)
    return flagged.groupBy(*keys).agg(
        F.first("overall_mean").alias("param_mean"),
        F.first("overall_stddev").alias("param_stddev"),
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("is_out_of_spec").alias("out_of_spec"),
    )
