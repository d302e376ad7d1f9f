"""What the plans must look like to hold on large data."""

import pytest

from plantlens import schemas
from plantlens.operators.aggregates import readings_of_fact
from plantlens.operators.parse import parse_lines
from plantlens.plans import kpis
from plantlens.plans.views import read_dimensions
from plantlens.registry.bindings import landing
from plantlens.sources.landing import read_lines
from plantlens.sources.tables import read_table
from plantlens.streaming.chain import run


@pytest.fixture(scope="module")
def lake(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("lake"))
    run(spark, landing(spark, sf_dir), path)
    return path


@pytest.fixture(scope="module")
def fact(spark, lake):
    return read_table(spark, lake, schemas.FACT)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(text):
    return [line for line in text.splitlines() if "Scan parquet" in line]


def fact_scans(text):
    return [line for line in scans(text) if "gold_fact_telemetry" in line]


def test_parameter_filter_reaches_the_scan(spark, fact, lake):
    dims = read_dimensions(spark, lake)
    (scan,) = fact_scans(plan(kpis.vibration_trend(fact, dims.line, dims.machine)))
    assert "EqualTo(parameter_name,vibration_mm_s_rms)" in scan
    read = scan[scan.index("ReadSchema") :]
    assert "record_id" not in read and "_source_file" not in read


def test_day_filter_reaches_the_scan(fact):
    (scan,) = fact_scans(plan(fact.filter("date_key = 20240105")))
    assert "EqualTo(date_key,20240105)" in scan


def test_line_filter_prunes_silver(spark, lake):
    readings = read_table(spark, lake, schemas.SILVER).filter("line_id = 'PL-02'")
    (scan,) = scans(plan(readings))
    assert "PartitionFilters: [isnotnull(line_id" in scan


def test_counting_readings_needs_no_expand(spark, fact, lake):
    dims = read_dimensions(spark, lake)
    text = plan(kpis.anomaly_rate(readings_of_fact(fact), dims.line, dims.machine))
    assert "Expand" not in text and len(fact_scans(text)) == 1
    # The reading is part of the first shuffle key, which spreads a hot machine over all tasks.
    assert "hashpartitioning(line_id" in text and "record_id" in text


def test_fact_is_aggregated_before_it_is_shuffled(spark, fact, lake):
    dims = read_dimensions(spark, lake)
    for df in (
        kpis.power_consumption(fact, dims.line, dims.machine),
        kpis.parameter_stability(fact, dims.machine, dims.stage),
        kpis.parameter_out_of_spec(fact, dims.machine, dims.stage),
    ):
        lines = plan(df).splitlines()
        place = next(i for i, line in enumerate(lines) if "gold_fact_telemetry" in line)
        above = next(line for line in reversed(lines[:place]) if "Exchange" in line or "Agg" in line)
        assert "HashAggregate" in above
        assert "CartesianProduct" not in "".join(lines)
        assert "BroadcastNestedLoopJoin" not in "".join(lines)


def test_json_is_parsed_once_per_line(spark, sf_dir):
    text = plan(parse_lines(read_lines(spark, landing(spark, sf_dir))))
    assert text.count("from_json") == 1
