"""Expectations: rows that fail one are counted and kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _failed(predicate: str) -> Column:
    """A row fails when the predicate is false or unknown."""
    return F.count_if(~F.coalesce(F.expr(predicate), F.lit(False)))


def expectation_report(df: DataFrame, expectations: dict[str, str]) -> DataFrame:
    """(expectation, passed, failed) for each predicate, from a single pass over `df`."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[_failed(predicate).alias(name) for name, predicate in expectations.items()],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("expectation"),
                (F.col("rows") - F.col(name)).alias("passed"),
                F.col(name).alias("failed"),
            )
            for name in expectations
        ]
    )
    return counts.select(F.inline(entries))


def observe_expectations(df: DataFrame, name: str, expectations: dict[str, str]) -> DataFrame:
    """Attach the counters to `df`; they are filled in as its rows pass, batch or stream."""
    counters = [_failed(predicate).alias(key) for key, predicate in expectations.items()]
    return df.observe(name, F.count(F.lit(1)).alias("rows"), *counters)


def not_a_number_report(df: DataFrame, column: str) -> DataFrame:
    """NaN passes a NULL check but spoils averages, so it can be counted separately."""
    return expectation_report(df, {f"{column}_is_number": f"NOT isnan({column})"})


def duplicate_keys(dimension: DataFrame, key: str) -> DataFrame:
    """Keys with more than one row. Joins on them multiply rows, counts and sums."""
    return dimension.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
