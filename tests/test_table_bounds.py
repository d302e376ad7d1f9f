"""Micro-batches behind a table: as many as wrote it, however many files they hold."""

import json

from compare import spark_rows

from plantlens import schemas
from plantlens.operators.parse import fact_rows, parse_lines
from plantlens.registry.bindings import damaged_lines
from plantlens.sources.files import count_files, names_in
from plantlens.sources.landing import read_lines
from plantlens.sources.tables import TableBounds, read_table
from plantlens.streaming.chain import finish, ingest, start_bronze, start_silver
from plantlens.streaming.sql_chain import ingest_sql

STEPS = ("bronze_raw_telemetry", "silver_telemetry", "_short_tables", "gold_fact_telemetry")


def land(folder, number, lines=("L1", "L2", "L3", "L4", None)):
    """A file with a reading of each line, so that silver makes a file for each."""
    folder.mkdir(exist_ok=True)
    readings = [
        {"record_id": f"{number}-{line}", "line_id": line, "machine_id": "M1", "telemetry": {"a": 1.0}}
        for line in lines
    ]
    (folder / f"{number}.jsonl").write_text("".join(json.dumps(r) + "\n" for r in readings))


def micro_batches(spark, lake):
    return [len(names_in(spark, f"{lake}/_checkpoints/{step}/commits")) for step in STEPS]


def files(spark, lake, spec):
    path = f"{lake}/{spec.name}"
    return count_files(spark, path) - count_files(spark, f"{path}/_spark_metadata")


def test_steps_have_as_many_micro_batches(spark, tmp_path):
    for form in (ingest, ingest_sql):
        landing, lake = tmp_path / f"landing_{form.__name__}", str(tmp_path / form.__name__)
        for number in range(4):
            land(landing, number)
        counts = form(spark, str(landing), lake, max_files=2)
        assert files(spark, lake, schemas.SILVER) > 2 * files(spark, lake, schemas.BRONZE)
        assert micro_batches(spark, lake) == [2, 2, 2, 2]
        for number in range(4, 7):
            land(landing, number)
        more = form(spark, str(landing), lake, max_files=1)
        assert micro_batches(spark, lake) == [5, 5, 5, 5]
        assert counts[schemas.FACT.name]["rows"] + more[schemas.FACT.name]["rows"] == 35
        stored = read_table(spark, lake, schemas.FACT).drop("_loaded_at")
        whole = fact_rows(parse_lines(read_lines(spark, str(landing)))).drop("_loaded_at")
        assert spark_rows(stored) == spark_rows(whole)


def test_small_increments_do_not_bind_a_backlog(spark, tmp_path):
    """Files are counted as this run has written them; what came before wrote one at a time."""
    landing, lake = tmp_path / "landing", str(tmp_path / "lake")
    for number in range(3):
        land(landing, number, ["L1"])
        ingest(spark, str(landing), lake, max_files=4)
    assert micro_batches(spark, lake) == [3, 3, 3, 3]
    for number in range(3, 11):
        land(landing, number)
    ingest(spark, str(landing), lake, max_files=4)
    assert micro_batches(spark, lake) == [5, 5, 5, 5]
    assert read_table(spark, lake, schemas.FACT).count() == 43


def test_steps_behind_take_the_mean(spark, tmp_path):
    """Two steps of an earlier run, the others failed: bounded by what all micro-batches wrote."""
    landing, lake = tmp_path / "landing", str(tmp_path / "lake")
    for number in range(4):
        land(landing, number)
    finish(start_bronze(spark, str(landing), lake, max_files=2))
    finish(start_silver(spark, lake))
    assert micro_batches(spark, lake)[:2] == [2, 1]
    ingest(spark, str(landing), lake, max_files=2)
    assert micro_batches(spark, lake) == [2, 1, 1, 1]
    assert read_table(spark, lake, schemas.FACT).count() == 20


def test_bounds_of_a_step(spark, tmp_path):
    landing, lake = tmp_path / "landing", str(tmp_path / "lake")
    specs = (schemas.BRONZE, schemas.SILVER)
    assert TableBounds(spark, lake, specs, max_files=3).of(schemas.SILVER) == {"max_files": 3}
    assert TableBounds(spark, lake, specs, max_bytes=5).of(schemas.SILVER) == {"max_bytes": 5}
    assert TableBounds(spark, lake, specs).of(schemas.SILVER) == {}
    land(landing, 0)
    ingest(spark, str(landing), lake)
    assert TableBounds(spark, lake, specs, max_files=3).of(schemas.SILVER) == {"max_files": 5}
    assert TableBounds(spark, lake, specs, max_files=9).of(schemas.SILVER) == {"max_files": 9}


def test_damaged_lines_are_made_once(spark, tmp_path):
    """Ids that repeat or are missing: every line meets all event types of its id."""
    rows = [(4, "error"), (4, "click"), (None, "view"), (5, "error"), (6, "view")]
    events = spark.createDataFrame(rows, "event_id BIGINT, event_type STRING").selectExpr(
        "event_id", "timestamp_ntz'2024-01-02 03:04:05' AS ts", "7L AS user_id", "event_type",
        "1.5D AS value", "'{\"k\": 2}' AS props",
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    lines = damaged_lines(spark, str(tmp_path), errors=True)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("StructsToJsonEvaluator") == 1
    found = sorted(r["raw_content"] for r in lines.collect())
    cut = [line for line in found if len(line) == 40]
    assert len(found) == 6 and len(cut) == 2
    assert sum('"vibration_mm_s_rms":"NaN"' in line for line in found) == 2
    assert sum('"vibration_mm_s_rms":null' in line for line in found) == 1
    assert sum('"record_id"' not in line for line in found) == 1
