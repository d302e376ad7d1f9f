"""Writing readings as JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plantlens.schemas import READING_SCHEMA

# Event times are written in UTC with milliseconds.
EVENT_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"


def json_lines(silver: DataFrame, *beside: str) -> DataFrame:
    """One JSON object per reading in `value`, beside its `line_id` and other columns."""
    reading = silver.withColumn("timestamp", F.date_format("event_timestamp", EVENT_TIME_FORMAT))
    fields = F.struct(*READING_SCHEMA.names)
    return reading.select("line_id", *beside, F.to_json(fields).alias("value"))


def export_json_lines(silver: DataFrame, path: str) -> None:
    """Append JSON lines below `path`, in one folder per line. Nothing is shuffled."""
    json_lines(silver).write.mode("append").partitionBy("line_id").text(path)
