"""Hourly moments of all parameters, kept as the state of a stream, and the KPIs that read them.

A stream over silver adds each micro-batch to the moments of the groups it meets; late rows change
their own hours only. The groups live in Spark's state store, in the checkpoint of the stream, so a
micro-batch that is done again after a failure is not added twice. A KPI is made from the state of
the last finished micro-batch: it costs one row per line, machine, stage, parameter and hour, and no
reading is looked at again.

KPIs that count distinct readings are not kept this way: telling a repeated reading from a new one
needs all ids seen, which is a state as long as silver. Those stay views over silver.

The number of partitions of the state is fixed when the stream is first started. Choose it so that
a partition holds some millions of groups (about 150 bytes each).
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from plantlens import schemas
from plantlens.operators.aggregates import merge_moments, moments_of_sums
from plantlens.operators.parse import fact_rows
from plantlens.plans import kpis
from plantlens.plans.views import read_dimensions
from plantlens.session import require_utc
from plantlens.sources.tables import stream_table, triggered

STATE = "_hourly_moments"
KEYS = ["line_id", "machine_id", "process_stage", "parameter_name", "date_key", "hour_of_day"]
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # A commit writes what has changed, not the whole store.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def state_path(lake: str) -> str:
    return f"{lake.rstrip('/')}/_checkpoints/{STATE}"


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for a query that is started within; it keeps a copy of them."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def start_hourly(
    spark: SparkSession,
    lake: str,
    every: str | None = None,
    partitions: int | None = None,
    **bounds,
) -> StreamingQuery:
    """Add the readings that have arrived in silver since the last run to the hourly moments."""
    require_utc(spark)
    rows = fact_rows(stream_table(spark, lake, schemas.SILVER, **bounds))
    x = F.col("parameter_value")
    grouped = rows.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.stddev_samp(x).alias("sd"),
        F.min(x).alias("low"),
        F.max(x).alias("high"),
    )
    settings = dict(STATE_SETTINGS)
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    writer = (
        grouped.writeStream.format("noop")
        .outputMode("update")
        .queryName("hourly_moments")
        .option("checkpointLocation", state_path(lake))
    )
    with _settings(spark, settings):
        return triggered(writer, every).start()


def hourly_moments(spark: SparkSession, lake: str) -> DataFrame:
    """Moments per group of `KEYS` as of the last finished micro-batch, in the form of `moments`."""
    with _settings(spark, STATE_SETTINGS):
        state = spark.read.format("statestore").load(state_path(lake))
    sums = state.select(
        *(F.col(f"key.{name}").alias(name) for name in KEYS),
        F.col("value.count").alias("n_rows"),
        F.col("value.n").cast("long").alias("n"),
        F.col("value.avg").alias("mean"),
        F.col("value.m2").alias("m2"),
        F.col("value.min").alias("low"),
        F.col("value.max").alias("high"),
    )
    return moments_of_sums(sums)


def _of_parameter(measured: DataFrame, parameter: str) -> DataFrame:
    """A machine may report several stages within an hour, which are merged."""
    found = measured.filter(F.col("parameter_name") == parameter)
    return merge_moments(found, kpis.HOURLY)


def hourly_kpis(spark: SparkSession, lake: str) -> dict[str, DataFrame]:
    """The KPIs on values, by name, from the hourly moments and the stored dimensions."""
    dims = read_dimensions(spark, lake)
    measured = hourly_moments(spark, lake)
    return {
        "mv_vibration_trend": kpis.vibration_of_moments(
            _of_parameter(measured, kpis.VIBRATION), dims.line, dims.machine
        ),
        "mv_parameter_stability": kpis.stability_of_moments(measured, dims.machine, dims.stage),
        "mv_power_consumption": kpis.power_of_moments(
            _of_parameter(measured, kpis.POWER), dims.line, dims.machine
        ),
    }
