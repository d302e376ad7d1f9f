"""A lake that is kept open: late files, replaced tables, compaction, logs, names."""

import os
import time

import pyarrow.parquet as pq
import pytest
from compare import spark_rows
from planted import PLANTED
from pyspark.sql import functions as F

from plantlens import schemas
from plantlens.operators.dimensions import build_dimensions
from plantlens.operators.out_of_spec import parameter_stats
from plantlens.plans.catalog import VIEW_SQL, database_of
from plantlens.plans.views import VIEWS, kpi, read_dimensions
from plantlens.registry.bindings import first_delivery, landing, second_delivery, silver
from plantlens.sources.export import export_json_lines
from plantlens.sources.compaction import copies_folder, copy_paths
from plantlens.sources.short_tables import batches_written, read_short_table, write_short_tables
from plantlens.sources.tables import read_table, table_path
from plantlens.streaming.chain import (
    compact,
    finish,
    follow,
    ingest,
    logged_expectations,
    rebuild_short_tables,
    run,
    start_bronze,
    start_short_tables,
    stored_expectations,
)


def land(folder, name, *lines, modified=None):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
    if modified is not None:
        os.utime(folder / name, (modified, modified))


def test_files_are_taken_whatever_their_time(spark, tmp_path):
    lake, folder = str(tmp_path / "lake"), tmp_path / "landing"
    now = time.time()
    for number, modified in enumerate([now, 0, now + 11 * 365 * 86400, now, -86400 * 365, now]):
        land(folder, f"{number}.jsonl", PLANTED[0], modified=modified)
        finish(start_bronze(spark, str(folder), lake))
        assert read_table(spark, lake, schemas.BRONZE).count() == number + 1


def test_done_files_can_be_archived(spark, tmp_path):
    lake, folder, archive = str(tmp_path / "lake"), tmp_path / "landing", tmp_path / "archive"
    for number in range(3):
        land(folder, f"{number}.jsonl", PLANTED[0])
        finish(start_bronze(spark, str(folder), lake, archive=str(archive)))
    assert read_table(spark, lake, schemas.BRONZE).count() == 3
    assert len(list(folder.glob("*.jsonl"))) < 3


def test_a_reader_survives_a_refresh(spark, tmp_path):
    lake = str(tmp_path)
    rows = [spark.createDataFrame([(s, 1, "x")], schemas.STAGE_SCHEMA) for s in "abcd"]
    assert read_short_table(spark, lake, schemas.DIM_STAGE).count() == 0
    write_short_tables(spark, lake, 0, [(schemas.DIM_STAGE, rows[0])])
    reader = read_table(spark, lake, schemas.DIM_STAGE)
    write_short_tables(spark, lake, 1, [(schemas.DIM_STAGE, rows[1])])
    assert reader.first()["process_stage"] == "a"
    assert read_table(spark, lake, schemas.DIM_STAGE).first()["process_stage"] == "b"
    write_short_tables(spark, lake, 2, [(schemas.DIM_STAGE, rows[2])])
    assert batches_written(spark, lake) == [1, 2]


def test_a_failed_refresh_leaves_the_last_one(spark, tmp_path):
    lake = str(tmp_path)
    good = spark.createDataFrame([("a", 1, "x")], schemas.STAGE_SCHEMA)
    write_short_tables(spark, lake, 0, [(schemas.DIM_STAGE, good)])
    bad = good.selectExpr("process_stage", "raise_error('stop') AS stage_sequence", "stage_category")
    with pytest.raises(Exception, match="stop"):
        write_short_tables(spark, lake, 1, [(schemas.DIM_STAGE, bad)])
    assert spark_rows(read_table(spark, lake, schemas.DIM_STAGE)) == spark_rows(good)


@pytest.fixture(scope="module")
def two_runs(spark, sf_dir, tmp_path_factory):
    folder, lake = tmp_path_factory.mktemp("landing"), str(tmp_path_factory.mktemp("lake"))
    readings = silver(spark, sf_dir)
    export_json_lines(first_delivery(readings), f"{folder}/batch")
    run(spark, str(folder), lake)
    export_json_lines(second_delivery(readings), f"{folder}/streaming")
    land(folder / "streaming", "planted.jsonl", *PLANTED)
    run(spark, str(folder), lake)
    return lake


def test_increments_equal_a_recompute(spark, two_runs):
    """NULL attributes and NULL, NaN and single values are among the planted lines."""
    dims = build_dimensions(read_table(spark, two_runs, schemas.SILVER))
    kept = read_dimensions(spark, two_runs)
    for name in ("line", "machine", "date", "stage"):
        assert spark_rows(getattr(kept, name)) == spark_rows(getattr(dims, name))
    fresh = parameter_stats(read_table(spark, two_runs, schemas.FACT))
    stored = read_table(spark, two_runs, schemas.STATS)
    assert [r[:2] for r in spark_rows(stored)[1]] == [r[:2] for r in spark_rows(fresh)[1]]
    expected = {tuple(r[:2]): r for r in fresh.collect()}
    for row in stored.collect():
        other = expected[tuple(row[:2])]
        assert row[4:] == other[4:]
        for a, b in zip(row[2:4], other[2:4], strict=True):
            assert a == b or (a != a and b != b) or a == pytest.approx(b, rel=1e-9)


def test_a_second_run_reads_its_increment_only(spark, tmp_path):
    lake, folder = str(tmp_path / "lake"), tmp_path / "landing"
    land(folder, "a.jsonl", *PLANTED[:7])
    run(spark, str(folder), lake)
    land(folder, "b.jsonl", PLANTED[0])
    finish(start_bronze(spark, str(folder), lake))
    from plantlens.streaming.chain import start_silver

    finish(start_silver(spark, lake))
    query = start_short_tables(spark, lake)
    finish(query)
    # The batch is read for the attribute sets and for the statistics.
    assert 1 <= sum(p.numInputRows for p in query.recentProgress) <= 2


def test_a_repeated_batch_is_not_added_twice(spark, tmp_path):
    lake, folder = tmp_path / "lake", tmp_path / "landing"
    land(folder, "a.jsonl", PLANTED[0])
    run(spark, str(folder), str(lake))
    before = spark_rows(read_table(spark, str(lake), schemas.STATS))
    for name in ("0", ".0.crc"):
        (lake / "_checkpoints" / "_short_tables" / "commits" / name).unlink(missing_ok=True)
    run(spark, str(folder), str(lake))
    assert spark_rows(read_table(spark, str(lake), schemas.STATS)) == before


def test_rebuilt_tables_equal_the_increments(spark, two_runs):
    kept = {name: spark_rows(kpi(spark, two_runs, name)) for name in VIEWS}
    rebuild_short_tables(spark, two_runs)
    for name in VIEWS:
        assert spark_rows(kpi(spark, two_runs, name)) == kept[name], name


def test_names_follow_the_streams(spark, tmp_path):
    """A fresh lake opens, and a new machine is in the KPIs without a call."""
    lake, folder = str(tmp_path / "lake"), tmp_path / "landing"
    land(folder, "a.jsonl", PLANTED[0])
    queries = follow(spark, str(folder), lake, every="200 milliseconds")
    try:
        assert spark.table("mv_anomaly_rate").count() == 1
        land(folder, "b.jsonl", PLANTED[1].replace("M1", "M2"))
        deadline = time.time() + 60
        while spark.table("mv_anomaly_rate").count() < 2 and time.time() < deadline:
            time.sleep(0.5)
        assert {r["machine_id"] for r in spark.table("mv_anomaly_rate").collect()} == {"M1", "M2"}
        assert spark.table("gold_dim_machine").count() == 2
        expected = 0
        while time.time() < deadline and expected != 2:
            log = {r["expectation"]: r for r in logged_expectations(spark, lake).collect()}
            expected = log["valid_record_id"]["rows"]
            time.sleep(0.5)
        assert expected == 2
    finally:
        for query in queries:
            query.stop()


def test_expectation_log(spark, tmp_path):
    lake, folder = str(tmp_path / "lake"), tmp_path / "landing"
    for number, line in enumerate(PLANTED):
        land(folder, f"{number}.jsonl", line)
    ingest(spark, str(folder), lake, max_files=2)
    log = {r["expectation"]: (r["rows"], r["failed"]) for r in logged_expectations(spark, lake).collect()}
    for spec in (schemas.SILVER, schemas.FACT):
        for row in stored_expectations(spark, lake, spec).collect():
            assert log[row["expectation"]] == (row["passed"] + row["failed"], row["failed"])
    assert log["valid_record_id"][1] == 2 and log["valid_param_value"][1] == 1
    batches = read_table(spark, lake, schemas.EXPECTATION_LOG).select("table_name", "batch_id")
    assert batches.distinct().count() > 2


def files_behind(df):
    """Where the rows of a frame come from."""
    names = df.select(F.input_file_name().alias("f")).distinct().collect()
    return {"copy" if "/_compacted/" in r["f"] else "table" for r in names}, len(names)


def test_compaction_beside_the_streams(spark, sf_dir, tmp_path):
    folder, lake = tmp_path / "landing", str(tmp_path / "lake")
    readings = silver(spark, sf_dir)
    export_json_lines(first_delivery(readings), f"{folder}/batch")
    ingest(spark, str(folder), lake, max_files=1)
    before = spark_rows(read_table(spark, lake, schemas.FACT))
    assert files_behind(read_table(spark, lake, schemas.FACT))[1] > 1
    copied = compact(spark, lake)
    assert copied[schemas.FACT.name] == len(before[1])
    compacted = read_table(spark, lake, schemas.FACT)
    assert files_behind(compacted) == ({"copy"}, 1) and spark_rows(compacted) == before
    partitioned = read_table(spark, lake, schemas.SILVER).filter("line_id = 'PL-02'")
    assert partitioned.count() == first_delivery(readings).filter("line_id = 'PL-02'").count()
    assert compact(spark, lake, (schemas.FACT,)) == {schemas.FACT.name: 0}
    export_json_lines(second_delivery(readings), f"{folder}/streaming")
    counts = ingest(spark, str(folder), lake)
    added = counts[schemas.FACT.name]["rows"]
    both = read_table(spark, lake, schemas.FACT)
    assert both.count() == len(before[1]) + added and files_behind(both)[0] == {"copy", "table"}
    whole = spark_rows(both)
    assert compact(spark, lake, (schemas.FACT,)) == {schemas.FACT.name: added}
    assert files_behind(read_table(spark, lake, schemas.FACT)) == ({"copy"}, 2)
    assert spark_rows(read_table(spark, lake, schemas.FACT)) == whole
    assert spark_rows(compacted) == before


def test_days_behind_the_bound_are_not_opened(spark, tmp_path):
    """Rows of an earlier day that a copy holds: their files are pruned by the day of loading."""
    lake = str(tmp_path / "lake")
    rows = spark.sql(
        "SELECT concat('r', id) AS raw_content, 'f' AS _source_file, TIMESTAMP '2024-01-01' AS "
        "_source_file_timestamp, 1L AS _source_file_size, "
        "timestamp_seconds(1704067200 + id * 40000) AS _ingested_at FROM range(9)"
    )
    from plantlens.sources.tables import overwrite_table

    overwrite_table(rows.where("_ingested_at < '2024-01-03 12:00:00'"), lake, schemas.BRONZE)
    n = compact(spark, lake, (schemas.BRONZE,))[schemas.BRONZE.name]
    overwrite_table(rows, lake, schemas.BRONZE)
    found = read_table(spark, lake, schemas.BRONZE)
    assert 0 < n < 9 and sorted(r["raw_content"] for r in found.collect()) == [f"r{i}" for i in range(9)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "_loaded_on" in plan.split("PartitionFilters", 1)[1]


def test_a_failed_compaction_is_not_read(spark, tmp_path):
    lake, folder = str(tmp_path / "lake"), tmp_path / "landing"
    land(folder, "a.jsonl", *PLANTED)
    run(spark, str(folder), lake)
    whole = spark_rows(read_table(spark, lake, schemas.FACT))
    compact(spark, lake, (schemas.FACT,))
    (path,) = copy_paths(spark, lake, schemas.FACT).values()
    os.unlink(f"{path}/_SUCCESS")
    assert spark_rows(read_table(spark, lake, schemas.FACT)) == whole
    assert compact(spark, lake, (schemas.FACT,))[schemas.FACT.name] == len(whole[1])
    assert len(os.listdir(copies_folder(lake, schemas.FACT))) == 1
    assert spark_rows(read_table(spark, lake, schemas.FACT)) == whole


def test_views_are_computed_when_read(spark, sf_dir, tmp_path):
    """A session that reads all along and never opens the lake, through increments and a compaction."""
    folder, lake = tmp_path / "landing", str(tmp_path / "lake")
    readings = silver(spark, sf_dir)
    export_json_lines(first_delivery(readings), f"{folder}/batch")
    run(spark, str(folder), lake)
    reader, db = spark.newSession(), database_of(lake)
    reader.conf.set("spark.sql.session.timeZone", "UTC")

    def compare():
        for name in VIEW_SQL:
            rows = spark_rows(reader.table(f"{db}.{name}"))
            assert rows == spark_rows(kpi(spark, lake, name)) and rows[1], name

    compare()
    export_json_lines(second_delivery(readings), f"{folder}/streaming")
    land(folder / "streaming", "planted.jsonl", *PLANTED)
    ingest(spark, str(folder), lake)
    compare()
    compact(spark, lake)
    compare()
    shown = reader.sql(f"DESCRIBE TABLE EXTENDED {db}.mv_anomaly_rate").where("col_name = 'Comment'")
    assert shown.first()["data_type"].startswith("Flagged share")
    shown = reader.sql(f"DESCRIBE TABLE EXTENDED {db}.gold_dim_machine").where("col_name = 'Comment'")
    assert shown.first()["data_type"] == schemas.DIM_MACHINE.comment


def test_compacted_fact_skips_row_groups_of_other_parameters(spark, sf_dir, tmp_path):
    lake = str(tmp_path / "lake")
    spark.conf.set("parquet.block.size", 64 << 10)
    try:
        ingest(spark, landing(spark, sf_dir), lake)
        compact(spark, lake, (schemas.FACT,))
    finally:
        spark.conf.unset("parquet.block.size")

    def groups(files):
        wanted = total = 0
        for file in files:
            meta = pq.ParquetFile(file.removeprefix("file:")).metadata
            column = [c for c in range(meta.num_columns) if meta.schema.column(c).name == "parameter_name"][0]
            for group in range(meta.num_row_groups):
                stats = meta.row_group(group).column(column).statistics
                total += 1
                wanted += stats.min <= "vibration_mm_s_rms" <= stats.max
        return wanted, total

    raw = spark.read.schema(schemas.FACT.stored_schema).parquet(table_path(lake, schemas.FACT)).inputFiles()
    wanted, total = groups(raw)
    assert wanted == total
    copies = copy_paths(spark, lake, schemas.FACT)
    wanted, total = groups(spark.read.parquet(*copies.values()).inputFiles())
    assert total > 2 and wanted < total
