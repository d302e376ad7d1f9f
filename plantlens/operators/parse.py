"""From raw lines to typed readings, and from readings to fact rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.functions.calendar import date_key, hour_of_day
from plantlens.schemas import READING_SCHEMA


def parse_lines(bronze: DataFrame) -> DataFrame:
    """Silver rows: one per line, also for lines that do not parse (all fields NULL).

    A malformed time gives NULL; with ANSI casts a plain conversion would end the job.
    """
    parsed = bronze.select(
        F.from_json("raw_content", READING_SCHEMA).alias("reading"), "_source_file"
    )
    fields = [
        F.try_to_timestamp("reading.timestamp").alias("event_timestamp")
        if name == "timestamp"
        else F.col(f"reading.{name}").alias(name)
        for name in READING_SCHEMA.names
    ]
    return parsed.select(*fields, "_source_file", F.current_timestamp().alias("_loaded_at"))


READING_KEYS = ("plant_id", "line_id", "machine_id", "process_stage", "is_anomaly")


def fact_rows(silver: DataFrame) -> DataFrame:
    """One row per reading and parameter; readings without parameters give none.

    The date parts are computed per reading, before its parameters are laid out as rows.
    Bookkeeping columns are kept only if the input has them.
    """
    keyed = keyed_readings(silver)
    exploded = keyed.select(
        "*", F.explode("telemetry").alias("parameter_name", "parameter_value")
    )
    return _fact_columns(exploded)


def parameter_rows(silver: DataFrame, parameter: str) -> DataFrame:
    """The fact rows of one parameter, looked up in the map instead of exploding all of it.

    The test is on the key, so a parameter sent with a NULL value still counts as a row.
    """
    with_key = silver.filter(F.map_contains_key("telemetry", parameter))
    looked_up = keyed_readings(with_key).select(
        "*",
        F.lit(parameter).alias("parameter_name"),
        F.element_at("telemetry", F.lit(parameter)).alias("parameter_value"),
    )
    return _fact_columns(looked_up)


def keyed_readings(silver: DataFrame) -> DataFrame:
    """Readings with the keys of the fact, their parameters still in the map."""
    when = F.col("event_timestamp")
    kept = [c for c in ("_source_file",) if c in silver.columns]
    return silver.select(
        "record_id",
        "event_timestamp",
        date_key(when).alias("date_key"),
        hour_of_day(when).alias("hour_of_day"),
        *READING_KEYS,
        "telemetry",
        *kept,
    )


def _fact_columns(rows: DataFrame) -> DataFrame:
    lineage = []
    if "_source_file" in rows.columns:
        lineage = [F.col("_source_file"), F.current_timestamp().alias("_loaded_at")]
    return rows.select(
        "record_id",
        "event_timestamp",
        "date_key",
        "hour_of_day",
        *READING_KEYS,
        "parameter_name",
        "parameter_value",
        *lineage,
    )
