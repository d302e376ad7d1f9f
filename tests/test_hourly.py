"""KPIs of the hourly state against those of the whole fact."""

import json

import pytest
from compare import canonical, spark_rows
from planted import PLANTED

from plantlens import schemas
from plantlens.operators.aggregates import moments
from plantlens.plans.views import kpi
from plantlens.sources.tables import read_table
from plantlens.streaming.chain import finish, ingest, start_bronze, start_silver
from plantlens.streaming.hourly import KEYS, STATE_SETTINGS, hourly_kpis, hourly_moments, start_hourly

VALUES = [3.0, 1e9 + 1, 1e9 + 2, None, -4.5, 0.0, 7.25]


def reading(i, value, hour, stage="etching", machine="M1", name="vibration_mm_s_rms"):
    return json.dumps(
        {
            "record_id": f"r{i}",
            "timestamp": f"2024-03-04T{hour:02d}:10:00Z",
            "plant_id": "P",
            "line_id": "L1",
            "line_name": "Line",
            "product_type": "T",
            "machine_id": machine,
            "machine_type": "press",
            "process_stage": stage,
            "is_anomaly": False,
            "telemetry": {name: value, "power_consumption_kw": i * 0.5},
        }
    )


def batches():
    first = [reading(i, v, 5) for i, v in enumerate(VALUES)] + list(PLANTED[:4])
    late = [reading(20 + i, v, 4 + i % 2, "forming") for i, v in enumerate(VALUES)]
    more = [reading(40 + i, None, 9, machine="M2") for i in range(3)] + list(PLANTED[4:])
    return [first, late, more, []]


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    landing, lake = tmp_path_factory.mktemp("landing"), str(tmp_path_factory.mktemp("lake"))
    for number, lines in enumerate(batches()):
        if lines:
            (landing / f"{number}.jsonl").write_text("\n".join(lines) + "\n")
        ingest(spark, str(landing), lake)
        finish(start_hourly(spark, lake, partitions=3))
    return lake


@pytest.mark.parametrize(
    "name", ["mv_vibration_trend", "mv_parameter_stability", "mv_power_consumption"]
)
def test_kpi_equals_full_computation(spark, lake, name):
    found, full = spark_rows(hourly_kpis(spark, lake)[name]), spark_rows(kpi(spark, lake, name))
    assert found == full and found[1]


def test_moments_equal_those_of_the_fact(spark, lake):
    fact = moments(read_table(spark, lake, schemas.FACT), KEYS)
    columns = [*KEYS, "n_rows", "n", "mean", "sd", "low", "high"]
    found = spark_rows(hourly_moments(spark, lake).select(*columns))
    assert found == spark_rows(fact.select(*columns))


def test_an_empty_run_changes_nothing_and_settings_are_restored(spark, lake):
    before = spark_rows(hourly_moments(spark, lake))
    finish(start_hourly(spark, lake, partitions=5))
    assert spark_rows(hourly_moments(spark, lake)) == before
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
    provider = next(iter(STATE_SETTINGS))
    assert "RocksDB" not in spark.conf.get(provider)


def groups(spark, lake):
    rows = [tuple(canonical(v) for v in row) for row in hourly_moments(spark, lake).collect()]
    return {row[: len(KEYS)]: row for row in rows}


def test_late_rows_change_their_hours_only(spark, lake, tmp_path):
    (tmp_path / "late.jsonl").write_text(reading(90, 2.0, 9, machine="M2") + "\n")
    before = groups(spark, lake)
    landing = str(tmp_path)
    finish(start_bronze(spark, landing, lake))
    finish(start_silver(spark, lake))
    query = start_hourly(spark, lake)
    finish(query)
    updated = sum(p.stateOperators[0].numRowsUpdated for p in query.recentProgress)
    after = groups(spark, lake)
    changed = {key for key in after if after[key] != before.get(key)}
    assert changed == {
        ("L1", "M2", "etching", name, "20240304", "9")
        for name in ("vibration_mm_s_rms", "power_consumption_kw")
    }
    assert updated == len(changed)
