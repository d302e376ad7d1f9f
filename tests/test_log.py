"""The expectation log of queries that go on: bounded files, nothing lost or counted twice."""

from datetime import datetime, timedelta, timezone

from compare import spark_rows

from plantlens import schemas
from plantlens.sources.files import names_in
from plantlens.sources.tables import read_table, table_path
from plantlens.streaming.log import (
    append_arrivals,
    append_to_log,
    log_entries,
    logged_expectations,
    merge_log,
    read_log,
    waiting_path,
)

START = datetime(2024, 3, 4, 22, 50, tzinfo=timezone.utc)


def entries(batch, failed):
    time = (START + timedelta(minutes=batch)).strftime("%Y-%m-%dT%H:%M:%S.000Z")
    return log_entries("silver_telemetry", "run", batch, time, {"rows": 10, "valid": failed})


def parquet_files(spark, path):
    return [n for n in names_in(spark, path) if n.endswith(".parquet")]


def test_files_are_merged_by_hours(spark, tmp_path):
    lake = str(tmp_path)
    for batch in range(0, 200, 10):
        append_arrivals(spark, lake, entries(batch, batch), START + timedelta(minutes=batch))
        found = logged_expectations(spark, lake).collect()
        assert [(r.rows, r.failed) for r in found] == [(batch + 10, sum(range(0, batch + 1, 10)))]
    # 22:50 to 02:00: the hours 22, 23 and 00 are merged, 01 and 02 wait.
    assert len(parquet_files(spark, table_path(lake, schemas.EXPECTATION_LOG))) == 3
    assert sorted(names_in(spark, waiting_path(lake))) == ["2024-03-05T01", "2024-03-05T02"]


def test_a_failed_merge_counts_nothing_twice(spark, tmp_path):
    lake = str(tmp_path)
    append_arrivals(spark, lake, entries(0, 3), START)
    append_arrivals(spark, lake, entries(1, 4), START)
    before = spark_rows(logged_expectations(spark, lake))
    waiting = f"{waiting_path(lake)}/2024-03-04T22"
    # The first of the two steps of a merge, then the whole of it.
    spark.read.parquet(waiting).write.mode("append").parquet(
        table_path(lake, schemas.EXPECTATION_LOG)
    )
    assert read_log(spark, lake).count() == 4
    assert spark_rows(logged_expectations(spark, lake)) == before
    merge_log(spark, lake)
    assert names_in(spark, waiting_path(lake)) == []
    assert spark_rows(logged_expectations(spark, lake)) == before


def test_runs_and_followed_batches_add_up(spark, tmp_path):
    lake = str(tmp_path)
    append_to_log(spark, lake, entries(0, 1) + entries(1, 2))
    append_arrivals(spark, lake, entries(2, 5), START)
    append_arrivals(spark, lake, [], START)
    assert read_table(spark, lake, schemas.EXPECTATION_LOG).count() == 2
    (row,) = logged_expectations(spark, lake).collect()
    assert (row.rows, row.failed) == (30, 8)
    merge_log(spark, lake)
    assert read_table(spark, lake, schemas.EXPECTATION_LOG).count() == 3
