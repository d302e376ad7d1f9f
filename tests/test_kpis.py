"""KPIs against plain joins of the raw fact, also where dimensions repeat their keys."""

import random
from statistics import mean, stdev

import pytest
from compare import spark_rows

from plantlens.operators.aggregates import merge_moments, moments, readings_of_fact
from plantlens.operators.dimensions import Dimensions
from plantlens.plans import kpis
from plantlens.schemas import LINE_SCHEMA, MACHINE_SCHEMA, STAGE_SCHEMA

FACT_DDL = (
    "record_id STRING, date_key INT, hour_of_day INT, line_id STRING, machine_id STRING, "
    "process_stage STRING, is_anomaly BOOLEAN, parameter_name STRING, parameter_value DOUBLE"
)
PARAMETERS = [kpis.VIBRATION, kpis.POWER, "always_zero", "large_mean"]


def fact_values(seed=7, readings=400):
    """Readings with repeated and missing ids, keys and values, and stages that vary."""
    rng = random.Random(seed)
    for i in range(readings):
        # A third of all readings come from one machine.
        machine = "M1" if rng.random() < 0.34 else f"M{rng.randint(1, 5)}"
        record = rng.choice([f"r{i}", f"r{i}", f"r{i % 50}", None])
        line = rng.choice(["PL-01", "PL-01", "PL-02", "PL-09", None])
        stage = rng.choice(["etching", "electrode_etching", "forming", "unknown", None])
        key = (record, 20260300 + rng.randint(1, 3), rng.randint(0, 23), line, machine, stage)
        flag = rng.choice([True, False, False, None])
        for name in rng.sample(PARAMETERS, rng.randint(1, 4)):
            value = rng.choice([rng.gauss(5, 2), rng.gauss(5, 2), None])
            if name == "always_zero":
                value = 0.0
            if name == "large_mean" and value is not None:
                value += 1e7
            yield (*key, flag, name, value)


@pytest.fixture(scope="module")
def fact(spark):
    df = spark.createDataFrame(list(fact_values()), FACT_DDL).repartition(7).cache()
    df.createOrReplaceTempView("f")
    return df


@pytest.fixture(scope="module", params=["unique keys", "repeated keys"])
def dims(spark, request):
    lines = [("PL-01", "One", "A", 1.0, 2.0, 1.0), ("PL-02", "Two", "B", 2.0, 3.0, 1.0)]
    machines = [(f"M{i}", f"T{i % 2}", "etching", "PL-01") for i in range(1, 5)]
    stages = [
        ("etching", 3, "Etching"),
        ("electrode_etching", 3, "Etching"),
        ("forming", 1, "Forming"),
        (None, 99, "Other"),
    ]
    if request.param == "repeated keys":
        lines += [("PL-01", "One", "A", 1.0, 2.5, 1.5), ("PL-02", "Two again", "B", 2.0, 3.0, 1.0)]
        machines += [("M1", "T1", "etching", "PL-02"), ("M1", "T1", "forming", "PL-01")]
        machines += [("M2", "T9", "etching", "PL-01"), ("M3", "T1", "electrode_etching", "PL-01")]
        stages += [("forming", 2, "Forming"), ("etching", 3, "Other name")]
    frames = Dimensions(
        line=spark.createDataFrame(lines, LINE_SCHEMA),
        machine=spark.createDataFrame(machines, MACHINE_SCHEMA),
        date=None,
        stage=spark.createDataFrame(stages, STAGE_SCHEMA),
    )
    frames.line.createOrReplaceTempView("pl")
    frames.machine.createOrReplaceTempView("m")
    frames.stage.createOrReplaceTempView("ps")
    return frames


COUNTS = """count(DISTINCT record_id) AS total_readings,
  count(DISTINCT if(is_anomaly, record_id, NULL)) AS anomaly_readings,
  round(count(DISTINCT if(is_anomaly, record_id, NULL)) * 100.0
    / nullif(count(DISTINCT record_id), 0), 2) AS anomaly_rate_pct"""


def check(spark, df, sql):
    columns, rows = spark_rows(df)
    expected_columns, expected = spark_rows(spark.sql(sql))
    assert columns == expected_columns
    assert rows == expected and rows


def test_anomaly_rate(spark, fact, dims):
    check(
        spark,
        kpis.anomaly_rate(readings_of_fact(fact), dims.line, dims.machine),
        f"""SELECT f.line_id, line_name, product_type, f.machine_id, machine_type, date_key,
        hour_of_day, {COUNTS} FROM f JOIN pl ON f.line_id = pl.line_id
        JOIN m ON f.machine_id = m.machine_id GROUP BY ALL""",
    )


def test_vibration_trend(spark, fact, dims):
    check(
        spark,
        kpis.vibration_trend(fact, dims.line, dims.machine),
        """SELECT f.line_id, line_name, f.machine_id, machine_type, m.process_stage, date_key,
        hour_of_day, round(avg(parameter_value), 6) AS avg_vibration_mm_s_rms,
        round(max(parameter_value), 6) AS max_vibration_mm_s_rms,
        round(min(parameter_value), 6) AS min_vibration_mm_s_rms,
        round(stddev(parameter_value), 6) AS stddev_vibration, count(*) AS reading_count
        FROM f JOIN pl ON f.line_id = pl.line_id JOIN m ON f.machine_id = m.machine_id
        WHERE parameter_name = 'vibration_mm_s_rms' GROUP BY ALL""",
    )


def test_parameter_stability(spark, fact, dims):
    check(
        spark,
        kpis.parameter_stability(fact, dims.machine, dims.stage),
        """SELECT f.line_id, f.machine_id, machine_type, stage_category, parameter_name, date_key,
        hour_of_day, round(avg(parameter_value), 6) AS mean_value,
        round(stddev(parameter_value), 6) AS stddev_value,
        round(if(abs(avg(parameter_value)) > 0,
          stddev(parameter_value) / abs(avg(parameter_value)), NULL), 6) AS stability_index,
        count(*) AS reading_count FROM f JOIN m ON f.machine_id = m.machine_id
        JOIN ps ON f.process_stage = ps.process_stage GROUP BY ALL""",
    )


def test_process_stage_anomaly_rate(spark, fact, dims):
    check(
        spark,
        kpis.process_stage_anomaly_rate(readings_of_fact(fact), dims.stage, dims.line),
        f"""SELECT stage_category, stage_sequence, f.line_id, product_type, date_key, {COUNTS}
        FROM f JOIN ps ON f.process_stage = ps.process_stage JOIN pl ON f.line_id = pl.line_id
        GROUP BY ALL""",
    )


def test_power_consumption(spark, fact, dims):
    check(
        spark,
        kpis.power_consumption(fact, dims.line, dims.machine),
        """SELECT f.line_id, line_name, product_type, f.machine_id, machine_type, date_key,
        hour_of_day, round(avg(parameter_value), 4) AS avg_power_kw,
        round(max(parameter_value), 4) AS max_power_kw,
        round(min(parameter_value), 4) AS min_power_kw,
        round(stddev(parameter_value), 4) AS stddev_power_kw, count(*) AS reading_count
        FROM f JOIN pl ON f.line_id = pl.line_id JOIN m ON f.machine_id = m.machine_id
        WHERE parameter_name = 'power_consumption_kw' GROUP BY ALL""",
    )


def test_heatmap(spark, fact, dims):
    check(
        spark,
        kpis.hourly_anomaly_heatmap(readings_of_fact(fact), dims.line),
        f"""SELECT f.line_id, line_name, product_type, date_key, hour_of_day,
        CASE WHEN hour_of_day < 6 OR hour_of_day > 21 THEN 'Night' WHEN hour_of_day < 14 THEN 'Day'
          ELSE 'Swing' END AS shift, {COUNTS},
        sum(if(is_anomaly, 1, 0)) AS anomaly_param_violations
        FROM f JOIN pl ON f.line_id = pl.line_id GROUP BY ALL""",
    )


@pytest.mark.parametrize("max_bytes", [None, 0])
def test_out_of_spec(spark, fact, dims, max_bytes, monkeypatch):
    if max_bytes is not None:
        monkeypatch.setattr(
            "plantlens.operators.out_of_spec.lookup_join",
            lambda rows, lookup, keys: kpis.lookup_join(
                rows, lookup, keys, max_bytes=max_bytes, heavy_share=3
            ),
        )
    check(
        spark,
        kpis.parameter_out_of_spec(fact, dims.machine, dims.stage),
        """WITH s AS (SELECT machine_id, parameter_name, avg(parameter_value) AS mu,
          stddev(parameter_value) AS sd FROM f GROUP BY ALL),
        x AS (SELECT f.*, mu, sd, if(abs(parameter_value - mu) > 2 * sd, 1, 0) AS beyond
          FROM f JOIN s USING (machine_id, parameter_name) WHERE sd > 0)
        SELECT x.line_id, machine_type, x.machine_id, stage_category, parameter_name, date_key,
        round(avg(mu), 6) AS param_mean, round(avg(sd), 6) AS param_stddev,
        count(*) AS total_readings, sum(beyond) AS out_of_spec_count,
        round(sum(beyond) * 100.0 / count(*), 2) AS out_of_spec_rate_pct
        FROM x JOIN m ON x.machine_id = m.machine_id
        JOIN ps ON m.process_stage = ps.process_stage GROUP BY ALL""",
    )


def test_out_of_spec_by_window(spark, fact, dims):
    """Window form over the raw fact: same counts."""
    columns, rows = spark_rows(
        kpis.count_out_of_spec(fact, ["machine_id", "parameter_name"]).drop(
            "param_mean", "param_stddev"
        )
    )
    expected = spark.sql(
        """WITH w AS (SELECT *, avg(parameter_value) OVER s AS mu, stddev(parameter_value) OVER s AS sd
          FROM f WINDOW s AS (PARTITION BY machine_id, parameter_name))
        SELECT machine_id, parameter_name, count(*) AS n_rows,
        sum(if(abs(parameter_value - mu) > 2 * sd, 1, 0)) AS out_of_spec
        FROM w WHERE sd > 0 GROUP BY ALL"""
    )
    assert (columns, rows) == spark_rows(expected)


def test_merged_moments_keep_digits(spark):
    """Merged in parts, as exact as rational arithmetic over the raw values."""
    values = [(g, p, 1e9 + x) for g in "ab" for p in range(5) for x in range(p + 1)]
    values += [("c", 0, 1.5), ("d", 0, None), ("d", 1, None)]
    frame = spark.createDataFrame(values, "g STRING, p INT, parameter_value DOUBLE")
    merged = merge_moments(moments(frame, ["g", "p"]), ["g"])
    rows = {r["g"]: r for r in merged.collect()}
    for group in "abcd":
        known = [x for g, _, x in values if g == group and x is not None]
        row = rows[group]
        assert row["n_rows"] == sum(g == group for g, _, _ in values)
        assert row["n"] == len(known)
        assert row["low"] == (min(known) if known else None)
        assert row["high"] == (max(known) if known else None)
        assert row["mean"] == (pytest.approx(mean(known), rel=1e-12) if known else None)
        assert row["sd"] == (pytest.approx(stdev(known), rel=1e-9) if len(known) > 1 else None)
