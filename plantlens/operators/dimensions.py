"""The four dimensions, each the distinct attribute sets found in the readings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.functions.calendar import calendar_columns
from plantlens.functions.measures import bandwidth
from plantlens.functions.stages import stage_category, stage_sequence
from plantlens.session import materialize

LINE_ATTRIBUTES = (
    "line_id",
    "line_name",
    "product_type",
    "target_frequency_band_ghz_min",
    "target_frequency_band_ghz_max",
)
MACHINE_ATTRIBUTES = ("machine_id", "machine_type", "process_stage", "line_id")


@dataclass(frozen=True)
class Dimensions:
    line: DataFrame
    machine: DataFrame
    date: DataFrame
    stage: DataFrame


def production_lines(readings: DataFrame) -> DataFrame:
    band = bandwidth(
        F.col("target_frequency_band_ghz_max"), F.col("target_frequency_band_ghz_min")
    )
    lines = readings.select(*LINE_ATTRIBUTES).distinct()
    return lines.withColumn("target_bandwidth_ghz", band)


def machines(readings: DataFrame) -> DataFrame:
    return readings.select(*MACHINE_ATTRIBUTES).distinct()


def dates(readings: DataFrame) -> DataFrame:
    """Days with readings; only here are rows without a time left out."""
    day = F.to_date("event_timestamp").alias("day")
    days = readings.filter("event_timestamp IS NOT NULL").select(day).distinct()
    return days.select(*calendar_columns(F.col("day")))


def process_stages(readings: DataFrame) -> DataFrame:
    stage = F.col("process_stage")
    return (
        readings.select(stage)
        .distinct()
        .select(
            stage,
            stage_sequence(stage).alias("stage_sequence"),
            stage_category(stage).alias("stage_category"),
        )
    )


def attribute_sets(silver: DataFrame) -> DataFrame:
    """All attribute combinations per day, from one scan of the readings.

    Every dimension is a distinct over part of these columns, so it comes out the same from
    this short frame as from the readings themselves.
    """
    day = F.to_date("event_timestamp").alias("event_timestamp")
    columns = dict.fromkeys(LINE_ATTRIBUTES + MACHINE_ATTRIBUTES)
    return silver.select(*columns, day).distinct()


def build_dimensions(silver: DataFrame, store: bool = False) -> Dimensions:
    """All four dimensions from the attribute sets, which `store` computes once and keeps."""
    sets = attribute_sets(silver)
    return dimensions_of_sets(materialize(sets) if store else sets)


def dimensions_of_sets(sets: DataFrame) -> Dimensions:
    """All four dimensions from attribute sets."""
    return Dimensions(
        line=production_lines(sets),
        machine=machines(sets),
        date=dates(sets),
        stage=process_stages(sets),
    )
