"""Counting fact rows by attributes of their dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.operators.aggregates import with_weight


def count_by_attributes(
    fact: DataFrame, dimensions: dict[str, DataFrame], by: list[str], count: str = "rows"
) -> DataFrame:
    """Fact rows and flagged rows per group of `by`, columns of the fact or of a dimension.

    `dimensions` are named by the key that joins them. The fact is counted per key first, and only
    the counts meet the dimensions. Rows of a dimension that repeat a key count its rows again, as
    a join would; rows without a partner are left out.
    """
    own = [column for column in by if column in fact.columns]
    keys = list(dict.fromkeys([*dimensions, *own]))
    counted = fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count), F.count_if("is_anomaly").alias("flagged_rows")
    )
    for number, (key, dimension) in enumerate(dimensions.items()):
        taken = [c for c in by if c in dimension.columns and c not in keys]
        weight = f"_weight{number}"
        partner = with_weight(dimension, key, *taken).withColumnRenamed("weight", weight)
        counted = counted.join(partner, key)
        for column in (count, "flagged_rows"):
            counted = counted.withColumn(column, F.col(column) * F.col(weight))
    return counted.groupBy(*by).agg(
        F.sum(count).alias(count), F.sum("flagged_rows").alias("flagged_rows")
    )
