"""Lines with planted faults through bronze, silver, fact and dimensions."""

import math
from datetime import date, datetime

import pytest
from planted import PLANTED

from plantlens import schemas
from plantlens.functions import calendar, measures, stages
from plantlens.operators.dimensions import build_dimensions
from plantlens.operators.parse import fact_rows, parameter_rows, parse_lines
from plantlens.operators.quality import (
    duplicate_keys,
    expectation_report,
    not_a_number_report,
)
from plantlens.sources.landing import read_lines
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def landed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    (folder / "batch_000.jsonl").write_text("\n".join(PLANTED[:4]) + "\n")
    (folder / "streaming").mkdir()
    (folder / "streaming" / "burst.jsonl").write_text("\n".join(PLANTED[4:]) + "\n")
    return folder


@pytest.fixture(scope="module")
def silver(spark, landed):
    return parse_lines(read_lines(spark, str(landed))).cache()


def failures(df, expectations):
    return {r["expectation"]: r["failed"] for r in expectation_report(df, expectations).collect()}


def test_bronze_keeps_every_line(spark, landed):
    bronze = read_lines(spark, str(landed))
    assert bronze.schema.names == schemas.BRONZE_SCHEMA.names
    rows = bronze.collect()
    assert sorted(r["raw_content"] for r in rows) == sorted(PLANTED)
    assert {r["_source_file"].rsplit("/", 1)[1] for r in rows} == {"batch_000.jsonl", "burst.jsonl"}
    assert all(r["_source_file"].startswith("file:") for r in rows)
    sizes = {r["_source_file_size"] for r in rows}
    assert sizes == {f.stat().st_size for f in landed.rglob("*.jsonl")}


def test_glob_leaves_other_files_out(spark, landed, tmp_path):
    (tmp_path / "a.jsonl").write_text(PLANTED[0] + "\n")
    (tmp_path / "plant.json").write_text('{\n "snapshot": true\n}\n')
    assert read_lines(spark, str(tmp_path)).count() == 4
    assert read_lines(spark, str(tmp_path), path_glob="*.jsonl").count() == 1


def test_silver_keeps_every_line(silver):
    assert silver.schema.names == schemas.SILVER_SCHEMA.names
    assert silver.count() == 9
    assert failures(silver, schemas.SILVER.expectations) == {
        "valid_record_id": 2,
        "valid_timestamp": 3,
        "valid_machine_id": 3,
    }


def test_one_bad_value_loses_the_map(silver):
    row = silver.filter("record_id = 'r7'").first()
    assert row["telemetry"] is None and row["machine_id"] == "M1"


def test_times_keep_milliseconds(silver):
    row = silver.filter("record_id = 'r1'").select(
        F.col("event_timestamp").cast("string").alias("t")
    )
    assert row.first()["t"] == "2026-03-04 00:00:00.123"


def test_fact_rows(silver):
    fact = fact_rows(silver)
    assert fact.schema.names == schemas.FACT_SCHEMA.names
    assert fact.schema["date_key"].dataType == schemas.INT
    assert fact.schema["hour_of_day"].dataType == schemas.INT
    counts = {r["record_id"]: r["count"] for r in fact.groupBy("record_id").count().collect()}
    assert counts == {"r1": 3, "r2": 3, "r5": 1, "r6": 1, "r9": 2}
    assert failures(fact, schemas.FACT.expectations) == {
        "valid_record": 0,
        "valid_param_name": 0,
        "valid_param_value": 1,
    }
    number = not_a_number_report(fact, "parameter_value").first()
    assert (number["passed"], number["failed"]) == (9, 1)
    r2 = fact.filter("record_id = 'r2'").first()
    assert (r2["date_key"], r2["hour_of_day"]) == (20260307, 23)
    r5 = fact.filter("record_id = 'r5'").first()
    assert r5["date_key"] is None and r5["hour_of_day"] is None


@pytest.mark.parametrize("parameter", ["vibration_mm_s_rms", "rf_power_w", "x", "y", "none"])
def test_parameter_rows_equal_the_filtered_fact(silver, parameter):
    def rows(df):
        return sorted(map(str, df.drop("_loaded_at").collect()))

    exploded = fact_rows(silver).filter(F.col("parameter_name") == parameter)
    assert rows(parameter_rows(silver, parameter)) == rows(exploded)


def test_dimensions(silver):
    dims = build_dimensions(silver)
    assert dims.line.schema.names == schemas.LINE_SCHEMA.names
    assert dims.machine.schema.names == schemas.MACHINE_SCHEMA.names
    assert dims.date.schema.names == schemas.DATE_SCHEMA.names
    assert dims.stage.schema.names == schemas.STAGE_SCHEMA.names
    days = {r["full_date"]: r for r in dims.date.collect()}
    assert set(days) == {date(2026, 3, 4), date(2026, 3, 7)}
    wednesday, saturday = days[date(2026, 3, 4)], days[date(2026, 3, 7)]
    assert wednesday["day_of_week"] == 4 and wednesday["day_name"] == "Wednesday"
    assert not wednesday["is_weekend"] and wednesday["date_key"] == 20260304
    assert saturday["is_weekend"] and saturday["month_name"] == "March"
    assert saturday["week_of_year"] == 10 and saturday["quarter"] == 1
    found = {tuple(r) for r in dims.stage.collect()}
    assert found == {("etching", 3, "Etching"), (None, 99, "Other")}
    # The full and the short readings of a line differ in attributes: two rows for one key.
    assert duplicate_keys(dims.line, "line_id").collect()[0]["rows"] == 2


def test_stored_dimensions_equal_computed_ones(silver):
    lazy, stored = build_dimensions(silver), build_dimensions(silver, store=True)
    for name in ("line", "machine", "date", "stage"):
        a, b = getattr(lazy, name).collect(), getattr(stored, name).collect()
        assert sorted(map(str, a)) == sorted(map(str, b))


def test_stage_table(spark):
    rows = [(s,) for s in stages.STAGES] + [("unheard_of",), (None,)]
    frame = spark.createDataFrame(rows, "s STRING").select(
        "s", stages.stage_sequence(F.col("s")), stages.stage_category(F.col("s"))
    )
    for stage, sequence, category in frame.collect():
        assert (sequence, category) == stages.STAGES.get(stage, (99, "Other"))
    assert len(stages.STAGES) == 20
    assert len({category for _, category in stages.STAGES.values()}) == 10


def test_shift_hours(spark):
    shifts = spark.range(24).select(calendar.shift(F.col("id"))).collect()
    expected = ["Night"] * 6 + ["Day"] * 8 + ["Swing"] * 8 + ["Night"] * 2
    assert [r[0] for r in shifts] == expected


def test_measures(spark):
    frame = spark.createDataFrame(
        [(1, 3, 12.0, 10.0, 1.0), (0, 0, 12.1, 10.0, 1.0), (201, 20000, None, 0.0, 0.0)],
        "a BIGINT, b BIGINT, x DOUBLE, mu DOUBLE, sd DOUBLE",
    )
    a, b, x, mu, sd = (F.col(c) for c in "a b x mu sd".split())
    rows = frame.select(
        measures.rate_pct(a, b).alias("rate"),
        measures.out_of_spec_flag(x, mu, sd).alias("beyond"),
        measures.coefficient_of_variation(mu, sd).alias("cv"),
    )
    assert rows.schema["rate"].dataType.simpleString() == "decimal(27,2)"
    assert [str(r["rate"]) for r in rows.collect()] == ["33.33", "None", "1.01"]
    assert [r["beyond"] for r in rows.collect()] == [0, 1, 0]
    assert [r["cv"] for r in rows.collect()] == [0.1, 0.1, None]
    bands = spark.createDataFrame([(6.0,), (6.01,), (4.0,), (4.01,)], "p DOUBLE")
    found = [r[0] for r in bands.select(measures.severity(F.col("p"))).collect()]
    assert found == ["medium", "high", "low", "medium"]


def test_not_a_number_spoils_the_mean(silver):
    value = fact_rows(silver).filter("parameter_name = 'y'").agg(F.avg("parameter_value")).first()
    assert math.isnan(value[0])


def test_date_key_by_arithmetic_equals_the_format(spark):
    days = [(datetime(1970, 1, 1),), (datetime(2024, 2, 29, 23, 59),), (datetime(999, 12, 31),)]
    frame = spark.createDataFrame(days, "t TIMESTAMP_NTZ")
    pair = frame.select(
        calendar.date_key(F.col("t")), F.date_format("t", "yyyyMMdd").cast("int")
    ).collect()
    assert all(a == b for a, b in pair)
