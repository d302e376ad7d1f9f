"""Dimensions and statistics kept up to date by parts: what is known, and what has arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.operators.aggregates import merge_moments, moments
from plantlens.operators.dimensions import attribute_sets
from plantlens.operators.out_of_spec import SERIES
from plantlens.operators.parse import fact_rows


def add_attribute_sets(known: DataFrame, arrived: DataFrame) -> DataFrame:
    """Attribute sets of the readings known so far and of those that have arrived."""
    return known.unionByName(attribute_sets(arrived)).distinct()


def add_statistics(known: DataFrame, arrived: DataFrame) -> DataFrame:
    """Statistics per series, with the parameters of readings that have arrived added.

    Both parts are merged by their moments, so that no row counted before is read again. Series
    without news keep their figures digit by digit.
    """
    old = known.select(
        *SERIES,
        F.col("series_rows").alias("n_rows"),
        F.col("series_values").alias("n"),
        F.col("overall_mean").alias("mean"),
        F.col("overall_stddev").alias("sd"),
    )
    squares = F.col("sd") * F.col("sd") * (F.col("n") - 1)
    unknown = F.lit(None).cast("double")
    old = old.withColumns(
        {"m2": F.coalesce(squares, F.lit(0.0)), "low": unknown, "high": unknown}
    )
    new = moments(fact_rows(arrived), SERIES)
    return merge_moments(old.unionByName(new), SERIES).select(
        *SERIES,
        F.col("mean").alias("overall_mean"),
        F.col("sd").alias("overall_stddev"),
        F.col("n_rows").alias("series_rows"),
        F.col("n").alias("series_values"),
    )
