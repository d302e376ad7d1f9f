"""Which parameters of which machines need attention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plantlens.functions.measures import rate_pct, severity
from plantlens.operators.out_of_spec import SERIES, count_out_of_spec

# A parameter is a finding above this percentage of out-of-spec rows.
WATCH_PCT = 3


def parameter_profile(fact: DataFrame, **options) -> DataFrame:
    """Mean, deviation and out-of-spec percentage per machine and parameter over all days.

    Counted from the fact again, not averaged from daily rates.
    """
    counted = count_out_of_spec(fact, SERIES, **options)
    return counted.select(
        *SERIES,
        F.round("param_mean", 6).alias("mean"),
        F.round("param_stddev", 6).alias("stddev"),
        F.col("n_rows").alias("total_readings"),
        F.col("out_of_spec").alias("out_of_spec_count"),
        rate_pct(F.col("out_of_spec"), F.col("n_rows")).alias("oos_pct"),
    )


def flagged_machines(silver: DataFrame) -> DataFrame:
    """Machines with at least one flagged reading."""
    return silver.filter("is_anomaly").select("machine_id").distinct()


def watch_list(
    profile: DataFrame,
    min_pct: float = WATCH_PCT,
    top: int | None = None,
    only_machines: DataFrame | None = None,
) -> DataFrame:
    """Findings above `min_pct`, ranked per machine from the worst, with their severity.

    The profile has one row per parameter of a machine, so a ranking sorts the parameter set of a
    machine, not its readings.

    `top` keeps that many per machine. `only_machines` restricts the list, for instance to
    `flagged_machines`, since ordinary noise alone takes about 4.5 % of values out of spec.
    """
    found = profile.filter(F.col("oos_pct") > min_pct)
    if only_machines is not None:
        found = found.join(only_machines, "machine_id", "left_semi")
    worst_first = Window.partitionBy("machine_id").orderBy(F.desc("oos_pct"), "parameter_name")
    ranked = found.withColumn("rank", F.row_number().over(worst_first))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.withColumn("severity", severity(F.col("oos_pct")))
