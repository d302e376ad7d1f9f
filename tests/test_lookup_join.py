"""The checked join gives the same rows by broadcast and by shuffle."""

import pytest
from compare import spark_rows
from pyspark.sql import functions as F

from plantlens.operators.joins import (
    fits_broadcast,
    lookup_join,
    payload_bytes,
    require_unique,
)


@pytest.fixture(scope="module")
def rows(spark):
    # Key 0 holds a third of the rows; every tenth row has no key.
    key = F.when(F.col("id") % 10 == 0, None).when(F.col("id") % 3 == 0, 0).otherwise(
        F.col("id") % 40
    )
    return spark.range(3000).select("id", key.cast("int").alias("a"), F.lit("x").alias("b"))


@pytest.fixture(scope="module")
def lookup(spark):
    # Some keys are missing, one is repeated, one is NULL.
    values = [(k, "x", f"v{k}") for k in range(0, 40, 2)] + [(0, "x", "again"), (None, "x", "none")]
    return spark.createDataFrame(values, "a INT, b STRING, v STRING")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("heavy_share", [1, 5, 512])
def test_shuffled_equals_plain(spark, rows, lookup, how, heavy_share):
    joined = lookup_join(rows, lookup, ["a", "b"], how, max_bytes=0, heavy_share=heavy_share)
    assert spark_rows(joined) == spark_rows(rows.join(lookup, ["a", "b"], how))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_broadcast_equals_plain(rows, lookup, how):
    joined = lookup_join(rows, lookup, ["a", "b"], how)
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().toString()
    assert spark_rows(joined) == spark_rows(rows.join(lookup, ["a", "b"], how))


def test_size_is_measured(spark, lookup):
    assert payload_bytes(lookup.filter("false")) == 0
    assert payload_bytes(lookup) > lookup.count() * 48
    wide = spark.range(20000).select(F.col("id"), F.repeat(F.lit("x"), 1000).alias("text"))
    assert not fits_broadcast(wide)
    nested = spark.createDataFrame([(["part"] * 100,)], "parts ARRAY<STRING>")
    assert payload_bytes(nested) > 400


def test_other_join_types_are_refused(rows, lookup):
    with pytest.raises(ValueError):
        lookup_join(rows, lookup, ["a"], "full")


@pytest.mark.parametrize("how", ["inner", "left"])
def test_hot_lookup_beyond_the_bound(spark, how):
    """Many long lookup rows behind a hot key: salted, and never broadcast."""
    rows = spark.range(4000).select("id", (F.col("id") % 7 * (F.col("id") % 2)).alias("a"))
    lookup = spark.range(60).select(
        (F.col("id") % 3).alias("a"), F.repeat(F.col("id").cast("string"), 200_000).alias("v")
    )
    joined = lookup_join(rows, lookup, ["a"], how)
    plain = rows.join(lookup.hint("merge"), "a", how)
    shown = [F.count("*"), F.sum("id"), F.sum(F.length("v")), F.sum(F.crc32(F.col("v").cast("binary")))]
    assert joined.agg(*shown).collect() == plain.agg(*shown).collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 1 and "_part" in plan


def test_rows_are_read_twice(spark, tmp_path, lookup):
    path = str(tmp_path / "rows")
    spark.range(3000).selectExpr("id", "cast(id % 5 as int) AS a", "'x' AS b").write.parquet(path)
    joined = lookup_join(spark.read.parquet(path), lookup, ["a", "b"], "left", max_bytes=0)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    # The other time is the count of the keys, which is done and kept.
    assert len([line for line in plan.splitlines() if "Scan parquet" in line]) == 1


def test_maps_among_the_rows(spark, lookup):
    rows = spark.range(50).selectExpr("map('k', id) AS m", "cast(0 as int) AS a", "'x' AS b")
    joined = lookup_join(rows, lookup, ["a", "b"], max_bytes=0, heavy_share=4)
    assert joined.count() == 100


def test_repeated_keys_are_refused(lookup):
    require_unique(lookup.filter("v <> 'again'"), ["a", "b"])
    with pytest.raises(ValueError, match="more than once"):
        require_unique(lookup, ["a", "b"])
