"""The KPIs of a stored lake as DataFrames; `plans.catalog` has them as views in SQL.

Readings are counted from silver, which has one row for each, and values are measured from the
fact. Beside running streams silver may be one micro-batch ahead of the fact; each KPI uses one of
the two, so none of them mixes their states.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from plantlens import schemas
from plantlens.operators.aggregates import readings_of_silver
from plantlens.operators.dimensions import Dimensions
from plantlens.operators.out_of_spec import parameter_stats, varying
from plantlens.plans import kpis
from plantlens.session import materialize
from plantlens.sources.tables import read_table


def read_dimensions(spark: SparkSession, lake: str) -> Dimensions:
    return Dimensions(
        line=read_table(spark, lake, schemas.DIM_LINE),
        machine=read_table(spark, lake, schemas.DIM_MACHINE),
        date=read_table(spark, lake, schemas.DIM_DATE),
        stage=read_table(spark, lake, schemas.DIM_STAGE),
    )


@dataclass(frozen=True)
class Lake:
    """What the KPIs are computed from."""

    silver: DataFrame
    fact: DataFrame
    dims: Dimensions
    stats: DataFrame

    @property
    def readings(self) -> DataFrame:
        return readings_of_silver(self.silver)


# Each view computes from a lake as it is when it is asked for.
VIEWS = {
    "mv_anomaly_rate": lambda lake: kpis.anomaly_rate(
        lake.readings, lake.dims.line, lake.dims.machine
    ),
    "mv_vibration_trend": lambda lake: kpis.vibration_trend(
        lake.fact, lake.dims.line, lake.dims.machine
    ),
    "mv_parameter_stability": lambda lake: kpis.parameter_stability(
        lake.fact, lake.dims.machine, lake.dims.stage
    ),
    "mv_process_stage_anomaly_rate": lambda lake: kpis.process_stage_anomaly_rate(
        lake.readings, lake.dims.stage, lake.dims.line
    ),
    "mv_power_consumption": lambda lake: kpis.power_consumption(
        lake.fact, lake.dims.line, lake.dims.machine
    ),
    "mv_hourly_anomaly_heatmap": lambda lake: kpis.hourly_anomaly_heatmap(
        lake.readings, lake.dims.line
    ),
    "mv_parameter_out_of_spec": lambda lake: kpis.parameter_out_of_spec(
        lake.fact, lake.dims.machine, lake.dims.stage, lake.stats
    ),
}


def read_lake(spark: SparkSession, lake: str, fresh_statistics: bool = False) -> Lake:
    """The newest committed state of all tables. `fresh_statistics` measures the fact right away."""
    fact = read_table(spark, lake, schemas.FACT)
    stored = read_table(spark, lake, schemas.STATS)
    stats = materialize(parameter_stats(fact)) if fresh_statistics else stored
    return Lake(
        silver=read_table(spark, lake, schemas.SILVER),
        fact=fact,
        dims=read_dimensions(spark, lake),
        stats=varying(stats),
    )


def kpi(spark: SparkSession, lake: str, name: str, fresh_statistics: bool = False) -> DataFrame:
    """One KPI of a lake as it is now."""
    return VIEWS[name](read_lake(spark, lake, fresh_statistics))
