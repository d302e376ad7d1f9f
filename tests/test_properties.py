"""What must hold for any readings, on generated ones."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from plantlens.operators.aggregates import readings_of_fact, readings_of_silver
from plantlens.operators.bursts import anomaly_bursts
from plantlens.operators.dimensions import build_dimensions
from plantlens.operators.findings import parameter_profile
from plantlens.operators.parse import fact_rows
from plantlens.plans import kpis
from pyspark.sql import functions as F

START = datetime(2026, 3, 4)
DDL = (
    "record_id STRING, event_timestamp TIMESTAMP, plant_id STRING, line_id STRING, line_name STRING, "
    "product_type STRING, target_frequency_band_ghz_min DOUBLE, target_frequency_band_ghz_max DOUBLE, "
    "machine_id STRING, machine_type STRING, process_stage STRING, is_anomaly BOOLEAN, "
    "telemetry MAP<STRING, DOUBLE>"
)
NAMES = [kpis.VIBRATION, kpis.POWER, "other"]
VALUES = st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False))


@st.composite
def readings(draw):
    rows = []
    for i in range(draw(st.integers(1, 25))):
        machine = draw(st.integers(0, 2))
        when = draw(st.one_of(st.none(), st.integers(0, 3 * 86400)))
        rows.append(
            (
                f"r{i}",
                None if when is None else START + timedelta(seconds=when),
                "P1",
                f"L{machine % 2}",
                f"Line {machine % 2}",
                "A",
                1.0,
                2.0,
                f"M{machine}",
                "T",
                "etching",
                draw(st.one_of(st.none(), st.booleans())),
                draw(st.dictionaries(st.sampled_from(NAMES), VALUES)),
            )
        )
    return rows


FEW = settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


@FEW
@given(readings())
def test_kpis_hold_together(spark, rows):
    silver = spark.createDataFrame(rows, DDL)
    fact = fact_rows(silver)
    dims = build_dimensions(silver)
    measured = [r for r in rows if r[-1]]

    assert fact.count() == sum(len(r[-1]) for r in rows)

    by_map = kpis.hourly_anomaly_heatmap(readings_of_silver(silver), dims.line).collect()
    by_fact = kpis.hourly_anomaly_heatmap(readings_of_fact(fact), dims.line).collect()
    assert sorted(map(str, by_map)) == sorted(map(str, by_fact))
    assert sum(r["total_readings"] for r in by_map) == len(measured)
    assert sum(r["anomaly_readings"] for r in by_map) == sum(bool(r[-2]) for r in measured)
    assert sum(r["anomaly_param_violations"] for r in by_map) == sum(
        len(r[-1]) for r in measured if r[-2]
    )
    for r in by_map:
        assert r["anomaly_readings"] <= r["total_readings"]
        assert 0 <= r["anomaly_rate_pct"] <= 100

    profile = parameter_profile(fact).collect()
    daily = kpis.parameter_out_of_spec(fact, dims.machine, dims.stage).collect()
    assert sum(r["total_readings"] for r in profile) == sum(r["total_readings"] for r in daily)
    assert sum(r["out_of_spec_count"] for r in profile) == sum(
        r["out_of_spec_count"] for r in daily
    )


@FEW
@given(readings(), st.integers(1, 6))
def test_bursts_cover_the_flagged_readings(spark, rows, slices):
    silver = spark.createDataFrame(rows, DDL)
    bursts = anomaly_bursts(silver, slices)
    assert (bursts.agg(F.sum("readings")).first()[0] or 0) == sum(bool(r[-2]) for r in rows)
    one_slice = anomaly_bursts(silver, 1)
    assert sorted(map(str, bursts.collect())) == sorted(map(str, one_slice.collect()))


def test_nothing_at_all(spark):
    silver = spark.createDataFrame([], DDL)
    dims = build_dimensions(silver)
    fact = fact_rows(silver)
    assert kpis.anomaly_rate(readings_of_fact(fact), dims.line, dims.machine).count() == 0
    assert kpis.parameter_out_of_spec(fact, dims.machine, dims.stage).count() == 0
    assert anomaly_bursts(silver).count() == 0


@pytest.mark.parametrize("copies", [1, 2, 5])
def test_copies_change_no_distinct_count(spark, copies):
    rows = [
        (f"r{i % 10}", START, "P1", "L0", "Line", "A", 1.0, 2.0, "M0", "T", "etching", i % 3 == 0, {"p": 1.0})
        for i in range(10)
    ] * copies
    silver = spark.createDataFrame(rows, DDL)
    row = kpis.hourly_anomaly_heatmap(
        readings_of_silver(silver), build_dimensions(silver).line
    ).first()
    assert (row["total_readings"], row["anomaly_readings"]) == (10, 4)
    assert row["anomaly_param_violations"] == 4 * copies
