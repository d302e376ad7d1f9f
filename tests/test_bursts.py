"""Bursts against a walk over the sorted readings."""

import random
from datetime import datetime, timedelta
from itertools import groupby

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from plantlens.operators.bursts import anomaly_bursts

DDL = "machine_id STRING, event_timestamp TIMESTAMP_NTZ, record_id STRING, is_anomaly BOOLEAN"
START = datetime(2026, 3, 4)


def walked(readings):
    found = []
    order = sorted(readings, key=lambda r: (r[0], r[1], r[2], bool(r[3])))
    for machine, rows in groupby(order, key=lambda r: r[0]):
        for flagged, run in groupby(rows, key=lambda r: bool(r[3])):
            run = list(run)
            if flagged:
                found.append((machine, run[0][1], run[-1][1], len(run)))
    return sorted(found)


def bursts(spark, readings, slices):
    df = spark.createDataFrame(readings, DDL).repartition(5)
    return sorted(tuple(r) for r in anomaly_bursts(df, slices).collect())


def random_readings(seed, count, flag_share):
    rng = random.Random(seed)
    readings = []
    for i in range(count):
        machine = "M0" if rng.random() < 0.4 else f"M{rng.randint(1, 6)}"
        # Few distinct times, so that ties are broken by the record id.
        when = START + timedelta(seconds=rng.randint(0, count // 4))
        readings.append((machine, when, f"r{i:05d}", rng.random() < flag_share))
    return readings


@pytest.mark.parametrize("slices", [1, 4, 50])
@pytest.mark.parametrize("flag_share", [0.1, 0.6, 0.97])
def test_random_readings(spark, slices, flag_share):
    """One machine holds over a third of all readings."""
    readings = random_readings(slices, 600, flag_share)
    assert bursts(spark, readings, slices) == walked(readings)


def test_times_before_1970_and_none(spark):
    times = [None, datetime(1969, 12, 31, 23, 59, 58), datetime(1970, 1, 1), datetime(1970, 1, 1, 1)]
    readings = [("M1", t, f"r{i}", True) for i, t in enumerate(times)]
    assert bursts(spark, readings, 1) == [("M1", times[1], times[3], 4)]


def test_no_slice_is_large(spark):
    """Half of the lines did not parse, a machine has a third of the rest in one hour, many undated."""
    readings = [(None, None, None, None)] * 6000
    readings += [("M0", START + timedelta(seconds=i % 3600), f"r{i}", i % 7 == 0) for i in range(2000)]
    readings += [("M1", None, f"u{i}", i % 3 == 0) for i in range(2000)]
    readings += [(f"M{2 + i % 5}", START + timedelta(minutes=i), f"s{i}", i % 2 == 0) for i in range(2000)]
    df = spark.createDataFrame(readings, DDL).repartition(8)
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = sorted(map(str, anomaly_bursts(df, 64).collect()))
        plan = anomaly_bursts(df, 64)
        # The rows of each slice, as the query itself cuts them.
        copied = df.groupBy("machine_id", "event_timestamp", "record_id", "is_anomaly").count()
        cut = copied.repartitionByRange(64, "machine_id", "event_timestamp", "record_id", "is_anomaly")
        largest = cut.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
    assert "rangepartitioning" in plan._jdf.queryExecution().executedPlan().toString()
    assert largest <= 3 * 6001 / 64
    expected = [Row(machine_id=m, burst_start=a, burst_end=b, readings=n) for m, a, b, n in walked_with_none(readings)]
    assert found == sorted(map(str, expected))


def walked_with_none(readings):
    """As `walked`, with missing values first."""
    found = []
    order = sorted(readings, key=lambda r: (r[0] or "", r[1] or datetime.min, r[2] or "", bool(r[3])))
    for machine, rows in groupby(order, key=lambda r: r[0]):
        for flagged, run in groupby(rows, key=lambda r: bool(r[3])):
            run = list(run)
            if flagged:
                times = [r[1] for r in run if r[1]]
                found.append((machine, min(times, default=None), max(times, default=None), len(run)))
    return found


def test_one_burst_over_all_slices(spark):
    readings = [("M1", START + timedelta(seconds=i), f"r{i}", True) for i in range(300)]
    expected = [("M1", readings[0][1], readings[-1][1], 300)]
    assert bursts(spark, readings, 30) == expected


def test_copies_and_unknown_flags(spark):
    """Copies of a reading count, a missing flag is no flag, and no time sorts first."""
    second = timedelta(seconds=1)
    readings = [("M1", START, "a", True)] * 50
    readings += [("M1", START + second, "b", None), ("M1", START + 2 * second, "c", True)]
    expected = [("M1", START, START, 50), ("M1", START + 2 * second, START + 2 * second, 1)]
    assert bursts(spark, readings, 4) == expected


def test_no_flags(spark):
    readings = [("M1", START + timedelta(seconds=i), f"r{i}", False) for i in range(20)]
    assert bursts(spark, readings, 4) == []
