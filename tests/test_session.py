"""The shared folder, and what holds for all queries."""

from pathlib import Path
from types import SimpleNamespace

import __spark_entry__ as entry_point
import pytest

from plantlens.session import materialize, scratch, shared_dir, use_utc
from plantlens.streaming.chain import ingest

# Queries that write and read tables of their own are left out; their parts are in the others.
PLANNED = [n for n in entry_point.queries() if n.split("_")[0] in ("dp", "ra", "jn", "agg")]


def test_folder_is_below_the_checkpoint_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert first.startswith(base) and first != second


def test_a_scope_removes_what_was_made_within(spark):
    kept = shared_dir(spark, "kept")
    with scratch(spark, "outer") as outer:
        with pytest.raises(ZeroDivisionError), scratch(spark, "inner") as inner:
            spark.range(5).write.parquet(shared_dir(spark, "x"))
            assert Path(inner).parent == Path(outer) and list(Path(inner).iterdir())
            raise ZeroDivisionError
        assert not Path(inner).exists()
        made = shared_dir(spark, "x")
        spark.range(5).write.parquet(made)
        spark.read.parquet(made).write.parquet(kept)
    assert not Path(outer).exists()
    assert spark.read.parquet(kept).count() == 5
    assert Path(shared_dir(spark, "x")).parent == Path(kept).parent


def test_a_cluster_must_name_its_folder():
    session = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: None),
        sparkContext=SimpleNamespace(master="spark://host:7077"),
    )
    with pytest.raises(RuntimeError):
        shared_dir(session, "x")


def test_other_time_zones_are_refused(spark, tmp_path):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError):
            ingest(spark, str(tmp_path), str(tmp_path / "lake"))
    finally:
        use_utc(spark)


def test_stored_frames_forget_their_lineage(spark):
    stored = materialize(spark.range(10).selectExpr("sum(id) AS total"))
    text = stored._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in text and "LogicalRDD" in text
    assert stored.first()["total"] == 45


@pytest.mark.parametrize("name", PLANNED)
def test_plans_stay_on_the_jvm_and_join_on_keys(spark, sf_dir, name):
    df = entry_point.queries()[name](spark, sf_dir)
    text = df._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas"):
        assert operator not in text
