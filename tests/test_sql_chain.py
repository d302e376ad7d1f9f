"""The chain in SQL against the chain in DataFrames, and the SQL functions against the columns."""

import pytest
from compare import spark_rows
from planted import PLANTED

from plantlens import schemas
from plantlens.functions import calendar, measures, stages
from plantlens.functions.sql import FUNCTIONS, create_functions
from plantlens.plans.catalog import database_of, open_lake
from plantlens.sources.tables import read_table
from plantlens.streaming.chain import ingest, logged_expectations
from plantlens.streaming.sql_chain import (
    BRONZE_SQL,
    FACT_SQL,
    SILVER_SQL,
    append_sql,
    arrivals_view,
    ingest_sql,
    landed_view,
)
from pyspark.sql import functions as F

CLOCK = ["_loaded_at", "_ingested_at"]


def stable(df):
    if "telemetry" in df.columns:
        df = df.withColumn("telemetry", df["telemetry"].cast("string"))
    return spark_rows(df.drop(*CLOCK))


@pytest.fixture(scope="module")
def lakes(spark, tmp_path_factory):
    """The planted lines in two increments: by DataFrames, in SQL, and by both in turn."""
    landing = tmp_path_factory.mktemp("landing")
    paths = [str(tmp_path_factory.mktemp(name)) for name in ("frames", "sql", "mixed")]
    counts = []
    for number, lines in enumerate([PLANTED[:4], PLANTED[4:]]):
        (landing / "in").mkdir(exist_ok=True)
        (landing / "in" / f"{number}.jsonl").write_text("\n".join(lines) + "\n")
        steps = [ingest, ingest_sql, (ingest_sql, ingest)[number]]
        counts.append([f(spark, str(landing), p) for f, p in zip(steps, paths, strict=True)])
    return paths, counts


@pytest.mark.parametrize("spec", schemas.TABLES, ids=lambda s: s.name)
def test_tables_are_equal(spark, lakes, spec):
    frames, *others = lakes[0]
    expected = stable(read_table(spark, frames, spec))
    assert expected[1]
    for lake in others:
        table = read_table(spark, lake, spec)
        assert table.schema == spec.schema
        assert stable(table) == expected


def test_counters_are_equal(spark, lakes):
    paths, counts = lakes
    for frames, sql, mixed in counts:
        assert frames == sql == mixed
    logs = [spark_rows(logged_expectations(spark, lake)) for lake in paths]
    assert logs[0] == logs[1] == logs[2] and logs[0][1]


def test_steps_of_ones_own(spark, tmp_path):
    landing, lake = tmp_path / "landing", str(tmp_path / "lake")
    landing.mkdir()
    (landing / "a.jsonl").write_text("\n".join(PLANTED) + "\n")
    ingest_sql(
        spark, str(landing), lake, fact_sql=f"{FACT_SQL} WHERE parameter_value IS NOT NULL"
    )
    fact = read_table(spark, lake, schemas.FACT)
    assert fact.count() and not fact.where("parameter_value IS NULL").count()


def test_refuses_what_does_not_fit(spark, tmp_path):
    landing, lake = tmp_path / "landing", str(tmp_path / "lake")
    landing.mkdir()
    (landing / "a.jsonl").write_text(PLANTED[0] + "\n")
    landed_view(spark, str(landing))
    with pytest.raises(ValueError, match="gives"):
        append_sql(spark, lake, schemas.BRONZE, "SELECT value FROM landed_lines")
    other_type = BRONZE_SQL.replace("_metadata.file_size AS", "string(_metadata.file_size) AS")
    with pytest.raises(ValueError, match="other types"):
        append_sql(spark, lake, schemas.BRONZE, other_type)
    with pytest.raises(ValueError, match="no streaming view"):
        append_sql(spark, lake, schemas.BRONZE, "SELECT 1 AS raw_content")


HOSTILE = [
    ("2024-03-02 05:59:59", "etching", 7, 3, 2.5, -1.0, 0.5),
    ("2024-03-03 06:00:00", "no such stage", 0, 0, 3.0, 3.0, 0.0),
    ("2024-03-04 14:00:00", None, 1, 3, None, 0.0, 1.0),
    ("2024-03-04 22:00:00", "final_test", None, 8, float("nan"), 2.0, None),
    (None, "plating", 2, 3, 6.0, 4.0, 1.0),
]


def test_functions_equal_the_columns(spark):
    create_functions(spark)
    rows = spark.createDataFrame(
        HOSTILE, "t string, stage string, a long, b long, x double, mu double, sd double"
    ).withColumn("t", F.col("t").cast("timestamp"))
    t, x, mu, sd = (F.col(name) for name in ("t", "x", "mu", "sd"))
    by_column = {
        "date_key_of(t)": calendar.date_key(t),
        "shift_of(hour(t))": calendar.shift(calendar.hour_of_day(t)),
        "is_weekend_day(to_date(t))": calendar.is_weekend(F.to_date(t)),
        "stage_sequence_of(stage)": stages.stage_sequence(F.col("stage")),
        "stage_category_of(stage)": stages.stage_category(F.col("stage")),
        "bandwidth_of(x, mu)": measures.bandwidth(x, mu),
        "rate_pct_of(a, b)": measures.rate_pct(F.col("a"), F.col("b")),
        "out_of_spec_flag_of(x, mu, sd)": measures.out_of_spec_flag(x, mu, sd),
        "variation_of(mu, sd)": measures.coefficient_of_variation(mu, sd),
        "severity_of(x)": measures.severity(x),
    }
    assert {call.split("(")[0] for call in by_column} == set(FUNCTIONS)
    for call, column in by_column.items():
        found, wanted = rows.selectExpr(f"{call} AS v"), rows.select(column.alias("v"))
        assert spark_rows(found) == spark_rows(wanted), call


def test_functions_are_inlined(spark):
    create_functions(spark)
    found = spark.range(24).selectExpr("shift_of(int(id)) AS s", "stage_sequence_of(string(id))")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CASE WHEN" in plan and "shift_of(" not in plan and "Python" not in plan


def test_functions_of_an_open_lake(spark, lakes):
    lake = lakes[0][1]
    open_lake(spark, lake)
    open_lake(spark, lake)
    db = database_of(lake)
    other = spark.newSession()
    assert other.sql(f"SELECT {db}.shift_of(15) AS s").first().s == "Swing"
    assert spark.sql("SELECT shift_of(7) AS s").first().s == "Day"
    told = [r[0] for r in spark.sql(f"DESCRIBE FUNCTION EXTENDED {db}.shift_of").collect()]
    assert any("Working shift" in line for line in told)


def test_arrivals_can_be_read_in_sql(spark, lakes):
    rows = arrivals_view(spark, lakes[0][1], schemas.BRONZE)
    assert rows.isStreaming
    assert spark.sql(SILVER_SQL).isStreaming
