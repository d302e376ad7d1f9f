"""Runs of consecutive flagged readings of a machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def anomaly_bursts(silver: DataFrame, slices: int | None = None) -> DataFrame:
    """(machine_id, burst_start, burst_end, readings) per run of flagged readings.

    Readings of a machine are ordered by event time (none first), then record id, then flag. No task
    sees all readings of a machine: after copies of a reading have been counted, all readings lie in
    one order of machine, time and id, which is cut by sampling into about equal `slices` (as many as
    the session has shuffle partitions). Runs are found inside each slice, and those that touch the
    edge of a slice are joined up afterwards.

    So a machine with many readings in an hour, or many readings without a time, are cut like any
    others, and lines that did not parse, which are all alike, are one reading with many copies.
    """
    order = ["event_timestamp", "record_id", "flagged"]
    counted = (
        silver.select(
            "machine_id",
            "event_timestamp",
            "record_id",
            F.coalesce("is_anomaly", F.lit(False)).alias("flagged"),
        )
        .groupBy("machine_id", *order)
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    wanted = [slices] if slices else []
    ranged = counted.repartitionByRange(*wanted, "machine_id", *order)
    sliced = ranged.withColumn("slice", F.spark_partition_id())

    in_slice = Window.partitionBy("machine_id", "slice").orderBy(*order)
    placed = sliced.withColumns(
        {
            "place": F.row_number().over(in_slice),
            "before": F.lag("flagged").over(in_slice),
            "after": F.lead("flagged").over(in_slice),
        }
    )
    opens, closes = F.col("before").isNull(), F.col("after").isNull()
    begins = F.col("flagged") & ~F.coalesce("before", F.lit(False))
    so_far = in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = placed.withColumn("run", F.count_if(begins).over(so_far))
    # Unflagged rows matter only at the edges: they tell that a run does not go on there.
    runs = (
        numbered.filter(F.col("flagged") | opens | closes)
        .groupBy("machine_id", "slice", "flagged", "run")
        .agg(
            F.min("place").alias("place"),
            F.bool_or(opens).alias("opens"),
            F.bool_or(closes).alias("closes"),
            F.min("event_timestamp").alias("burst_start"),
            F.max("event_timestamp").alias("burst_end"),
            F.sum("copies").alias("readings"),
        )
    )

    # Rows at an edge: at most two per slice and machine. They form one group per machine, all
    # other runs stay in the group of their slice.
    at_edge = F.col("opens") | F.col("closes")
    group = F.when(~at_edge, F.col("slice"))
    grouped = runs.withColumn("part", group)
    along = Window.partitionBy("machine_id", "part").orderBy("slice", "place")
    reaches_edge = F.lag(F.col("flagged") & F.col("closes")).over(along)
    goes_on = F.col("flagged") & F.col("opens") & F.coalesce(reaches_edge, F.lit(False))
    chained = grouped.withColumn("goes_on", goes_on)
    up_to_here = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chained = chained.withColumn("burst", F.count_if(~F.col("goes_on")).over(up_to_here))
    return (
        chained.filter("flagged")
        .groupBy("machine_id", "part", "burst")
        .agg(
            F.min("burst_start").alias("burst_start"),
            F.max("burst_end").alias("burst_end"),
            F.sum("readings").alias("readings"),
        )
        .select("machine_id", "burst_start", "burst_end", "readings")
    )
