"""The streaming chain against the batch functions."""

import pytest
from compare import spark_rows
from planted import PLANTED

from plantlens import schemas
from plantlens.operators.dimensions import build_dimensions
from plantlens.operators.parse import fact_rows, parse_lines
from plantlens.plans.catalog import COMMENTS, open_lake
from plantlens.plans.views import VIEWS, kpi
from plantlens.registry.bindings import first_delivery, second_delivery, silver
from plantlens.sources.export import export_json_lines
from plantlens.sources.landing import read_lines
from plantlens.sources.tables import read_table
from plantlens.streaming.chain import (
    finish,
    follow,
    ingest,
    run,
    start_bronze,
    stored_expectations,
)

CLOCK = ["_loaded_at", "_ingested_at"]


def without_clock(df):
    if "telemetry" in df.columns:
        df = df.withColumn("telemetry", df["telemetry"].cast("string"))
    return spark_rows(df.drop(*CLOCK))


@pytest.fixture(scope="module")
def planted_lake(spark, tmp_path_factory):
    landing, lake = tmp_path_factory.mktemp("landing"), str(tmp_path_factory.mktemp("lake"))
    (landing / "a.jsonl").write_text("\n".join(PLANTED[:4]) + "\n")
    first = run(spark, str(landing), lake)
    (landing / "streaming").mkdir()
    (landing / "streaming" / "b.jsonl").write_text("\n".join(PLANTED[4:]) + "\n")
    second = run(spark, str(landing), lake)
    third = run(spark, str(landing), lake)
    return str(landing), lake, [first, second, third]


def test_planted_lines_in_two_increments(spark, planted_lake):
    landing, lake, _ = planted_lake
    bronze = read_lines(spark, landing)
    assert without_clock(read_table(spark, lake, schemas.BRONZE)) == without_clock(bronze)
    readings = parse_lines(bronze)
    stored = read_table(spark, lake, schemas.SILVER)
    assert stored.count() == 9
    assert without_clock(stored) == without_clock(readings)
    fact = read_table(spark, lake, schemas.FACT)
    assert fact.count() == 10
    assert without_clock(fact) == without_clock(fact_rows(readings))


def test_observed_failures(spark, planted_lake):
    _, lake, (first, second, third) = planted_lake
    silver_name, fact_name = schemas.SILVER.name, schemas.FACT.name
    assert first[silver_name] == {
        "rows": 4,
        "valid_record_id": 2,
        "valid_timestamp": 2,
        "valid_machine_id": 2,
    }
    total = {k: first[silver_name][k] + second[silver_name][k] for k in first[silver_name]}
    stored = stored_expectations(spark, lake, schemas.SILVER).collect()
    assert {r["expectation"]: r["failed"] for r in stored} == {
        k: v for k, v in total.items() if k != "rows"
    }
    assert total["rows"] == 9
    assert second[fact_name]["valid_param_value"] == 1
    assert third[silver_name].get("rows", 0) == 0 and third[fact_name].get("rows", 0) == 0


def test_dimension_tables(spark, planted_lake):
    _, lake, _ = planted_lake
    dims = build_dimensions(read_table(spark, lake, schemas.SILVER))
    for spec, df in [
        (schemas.DIM_LINE, dims.line),
        (schemas.DIM_MACHINE, dims.machine),
        (schemas.DIM_DATE, dims.date),
        (schemas.DIM_STAGE, dims.stage),
    ]:
        stored = read_table(spark, lake, spec)
        assert stored.schema == spec.schema
        assert spark_rows(stored) == spark_rows(df)


def test_views_equal_fresh_kpis(spark, planted_lake):
    _, lake, _ = planted_lake
    for name in VIEWS:
        assert spark_rows(spark.table(name)) == spark_rows(kpi(spark, lake, name)), name
    assert set(COMMENTS) == set(VIEWS)


def test_names_stand_for_the_newest_increment(spark, tmp_path):
    landing, lake = tmp_path / "landing", str(tmp_path / "lake")
    landing.mkdir()
    name = "mv_parameter_out_of_spec"
    (landing / "a.jsonl").write_text("\n".join(PLANTED[:2]) + "\n")
    run(spark, str(landing), lake)
    assert spark.table(name).agg({"total_readings": "sum"}).first()[0] == 6
    (landing / "b.jsonl").write_text(PLANTED[4] + "\n")
    run(spark, str(landing), lake)
    # The machine has two attribute sets now, which both count its seven rows.
    assert spark.table(name).agg({"total_readings": "sum"}).first()[0] == 14
    fresh = kpi(spark, lake, name, fresh_statistics=True)
    assert spark_rows(spark.table(name)) == spark_rows(fresh)


def test_tables_by_name(spark, planted_lake):
    open_lake(spark, planted_lake[1])
    for spec in schemas.TABLES:
        assert spark.table(spec.name).columns == spec.schema.names
    counts = spark.sql("SELECT count(*) AS n FROM gold_fact_telemetry WHERE record_id = 'r1'")
    assert counts.first()["n"] == 3


def test_partition_values_keep_their_type(spark, tmp_path):
    """Line ids that look like numbers stay text, and a missing one stays missing."""
    landing = tmp_path / "landing"
    landing.mkdir()
    lines = ['{"record_id":"a","line_id":"007"}', '{"record_id":"b"}']
    (landing / "x.jsonl").write_text("\n".join(lines) + "\n")
    ingest(spark, str(landing), str(tmp_path / "lake"))
    stored = read_table(spark, str(tmp_path / "lake"), schemas.SILVER)
    assert {(r["record_id"], r["line_id"]) for r in stored.collect()} == {("a", "007"), ("b", None)}


def test_binding_in_small_batches(spark, sf_dir, tmp_path):
    """Two deliveries, each in several micro-batches, equal one batch parse."""
    landing, lake = str(tmp_path / "landing"), str(tmp_path / "lake")
    readings = silver(spark, sf_dir)
    rows = 0
    for part in (first_delivery(readings), second_delivery(readings)):
        export_json_lines(part, landing)
        counts = ingest(spark, landing, lake, max_files=2)
        rows += counts[schemas.FACT.name]["rows"]
    fact = read_table(spark, lake, schemas.FACT)
    assert fact.count() == rows
    whole = fact_rows(parse_lines(read_lines(spark, landing)))
    assert without_clock(fact) == without_clock(whole)


def test_backlog_is_cut_by_bytes(spark, tmp_path):
    landing, lake = tmp_path / "landing", str(tmp_path / "lake")
    landing.mkdir()
    for i in range(4):
        (landing / f"{i}.jsonl").write_text(PLANTED[0] + "\n")
    query = start_bronze(spark, str(landing), lake, max_bytes=1)
    finish(query)
    batches = {p.batchId for p in query.recentProgress if p.numInputRows}
    assert len(batches) == 4
    assert read_table(spark, lake, schemas.BRONZE).count() == 4
    with pytest.raises(ValueError):
        start_bronze(spark, str(landing), lake, max_files=1, max_bytes=1)


def test_files_that_arrive_while_following(spark, tmp_path):
    landing, lake = tmp_path / "landing", str(tmp_path / "lake")
    landing.mkdir()
    (landing / "a.jsonl").write_text(PLANTED[0] + "\n")
    queries = follow(spark, str(landing), lake, every="100 milliseconds")
    try:
        (landing / "b.jsonl").write_text(PLANTED[1] + "\n")
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
    assert read_table(spark, lake, schemas.FACT).count() == 6
    assert ingest(spark, str(landing), lake)[schemas.FACT.name].get("rows", 0) == 0


def test_steps_may_lag(spark, tmp_path):
    """Bronze may be several runs ahead; silver and fact take all of it later."""
    landing, lake = tmp_path / "landing", str(tmp_path / "lake")
    landing.mkdir()
    for i in range(2):
        (landing / f"{i}.jsonl").write_text(PLANTED[i] + "\n")
        finish(start_bronze(spark, str(landing), lake))
    counts = ingest(spark, str(landing), lake)
    assert counts[schemas.SILVER.name]["rows"] == 2
    assert read_table(spark, lake, schemas.FACT).count() == 6


def test_run_after_a_crash_doubles_nothing(spark, tmp_path):
    """Files written, but the micro-batch not yet marked as done: it is repeated harmlessly."""
    landing, lake = tmp_path / "landing", tmp_path / "lake"
    landing.mkdir()
    (landing / "a.jsonl").write_text(PLANTED[0] + "\n")
    ingest(spark, str(landing), str(lake))
    for spec in (schemas.BRONZE, schemas.SILVER, schemas.FACT):
        commits = lake / "_checkpoints" / spec.name / "commits"
        for name in ("0", ".0.crc"):
            (commits / name).unlink(missing_ok=True)
    (landing / "b.jsonl").write_text(PLANTED[1] + "\n")
    ingest(spark, str(landing), str(lake))
    for spec, rows in ((schemas.BRONZE, 2), (schemas.SILVER, 2), (schemas.FACT, 6)):
        assert read_table(spark, str(lake), spec).count() == rows
