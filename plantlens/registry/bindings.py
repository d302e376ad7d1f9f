"""Telemetry made from the driver tables.

`events` plays the readings: the user decides the machine (20 of them, five per line), the event
type "error" is the flag, and the sensor map is filled from `value` and `props`. One parameter is
always zero, and one exists on every fifth machine only.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.operators.dimensions import Dimensions, build_dimensions
from plantlens.operators.parse import fact_rows
from plantlens.schemas import KNOWLEDGE_SCHEMA, LIMITS_SCHEMA
from plantlens.session import shared_dir
from plantlens.sources.export import export_json_lines, json_lines

# The stage of each machine, by machine number.
MACHINE_STAGES = [
    "thin_film_deposition",
    "patterning",
    "etching",
    "frequency_tuning",
    "final_test",
    "piezoelectric_film_deposition",
    "idt_patterning",
    "electrode_etching",
    "singulation",
    "wafer_level_test",
    "forming",
    "sintering",
    "cavity_machining",
    "plating",
    "tuning_and_test",
    "sacrificial_layer_deposition",
    "electrode_and_piezo_deposition",
    "via_and_release_etch",
    "packaging",
    "final_test_and_characterization",
]
# Readings from this day on are landed in a subfolder, as a second delivery.
SECOND_DELIVERY = "2024-01-16"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _machine_name(number: Column) -> Column:
    return F.concat(F.lit("M"), F.lpad(number.cast("string"), 2, "0"))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    number = F.pmod("user_id", F.lit(20)).cast("int")
    numbered = events.select(
        "*",
        number.alias("machine_no"),
        F.floor(number / 5 + 1).cast("int").alias("line_no"),
        F.get_json_object("props", "$.k").cast("double").alias("k"),
    )
    machine, line = F.col("machine_no"), F.col("line_no")
    parameters = {
        "vibration_mm_s_rms": F.col("value"),
        "power_consumption_kw": F.col("k"),
        "hermetic_leak_rate_atm_cc_per_s": F.lit(0.0),
        "film_stress_mpa": F.when(machine % 5 == 0, F.col("value") + F.col("k")),
    }
    entries = chain.from_iterable((F.lit(name), value) for name, value in parameters.items())
    stages = F.array(*[F.lit(stage) for stage in MACHINE_STAGES])
    return numbered.select(
        F.col("event_id").cast("string").alias("record_id"),
        F.col("ts").alias("event_timestamp"),
        F.lit("P1").alias("plant_id"),
        F.concat(F.lit("PL-0"), line.cast("string")).alias("line_id"),
        F.concat(F.lit("Line "), line.cast("string")).alias("line_name"),
        F.concat(F.lit("Product "), line.cast("string")).alias("product_type"),
        line.cast("double").alias("target_frequency_band_ghz_min"),
        (line + 0.25).cast("double").alias("target_frequency_band_ghz_max"),
        _machine_name(machine).alias("machine_id"),
        F.concat(F.lit("Type "), (machine % 5).cast("string")).alias("machine_type"),
        F.element_at(stages, machine + 1).alias("process_stage"),
        (F.col("event_type") == "error").alias("is_anomaly"),
        F.map_filter(F.create_map(*entries), lambda name, value: value.isNotNull()).alias(
            "telemetry"
        ),
    )


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_rows(silver(spark, sf_dir))


def dimensions(spark: SparkSession, sf_dir: str) -> Dimensions:
    return build_dimensions(silver(spark, sf_dir))


def repeated_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`lineitem` as readings whose ids repeat, one machine per supplier group of 20."""
    items = table(spark, sf_dir, "lineitem")
    return items.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("record_id"),
        _machine_name(F.pmod("l_suppkey", F.lit(20))).alias("machine_id"),
        (F.col("l_returnflag") == "R").alias("is_anomaly"),
        F.lit(1).alias("parameters"),
    )


# --- landed files --------------------------------------------------------------------------

_landings: dict[tuple[str, str], str] = {}


def first_delivery(readings: DataFrame) -> DataFrame:
    return readings.filter(F.col("event_timestamp") < F.lit(SECOND_DELIVERY).cast("timestamp_ntz"))


def second_delivery(readings: DataFrame) -> DataFrame:
    return readings.filter(F.col("event_timestamp") >= F.lit(SECOND_DELIVERY).cast("timestamp_ntz"))


def landing(spark: SparkSession, sf_dir: str) -> str:
    """All readings as JSON lines: the first delivery at the root, the second in `streaming/`.

    Written once per application and folder of tables; queries only read it.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landings:
        path = shared_dir(spark, "landing")
        readings = silver(spark, sf_dir)
        export_json_lines(first_delivery(readings), f"{path}/batch")
        export_json_lines(second_delivery(readings), f"{path}/streaming")
        _landings[key] = path
    return _landings[key]


def damaged_lines(spark: SparkSession, sf_dir: str, errors: bool = False) -> DataFrame:
    """Raw lines of which whole event types are damaged, one kind of damage each.

    "click": cut off, so nothing parses. "signup": a time that is none. "purchase": no machine.
    "view": a parameter sent as null. "error": as it should be, but with `errors`, no record id if
    it is odd, and a parameter sent as "NaN" if it is divisible by four.
    """
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("record_id"), "event_type"
    )
    line = F.col("value")
    # Four kinds of ids by their remainder; without `errors` the damage below meets none.
    kind = F.when(F.lit(errors) & (F.col("event_type") == "error"), F.col("record_id") % 4)
    damaged = (
        F.when(F.col("event_type") == "click", F.substring(line, 1, 40))
        .when(
            F.col("event_type") == "signup",
            F.regexp_replace(line, '"timestamp":"[^"]*"', '"timestamp":"not a time"'),
        )
        .when(
            F.col("event_type") == "purchase",
            F.regexp_replace(line, '"machine_id":"[^"]*",', ""),
        )
        .when(
            F.col("event_type") == "view",
            F.regexp_replace(line, '"vibration_mm_s_rms":[^,}]*', '"vibration_mm_s_rms":null'),
        )
        .when(
            kind.isin(1, 3),
            F.regexp_replace(line, '"record_id":"[^"]*",', ""),
        )
        .when(
            kind == 0,
            F.regexp_replace(line, '"vibration_mm_s_rms":[^,}]*', '"vibration_mm_s_rms":"NaN"'),
        )
        .otherwise(line)
    )
    # Joined by the id of the reading before its line is written: looked up in the line, the id would
    # have every line made twice, once to test whether it has one.
    readings = silver(spark, sf_dir).join(events, "record_id")
    return json_lines(readings, "record_id", "event_type").select(
        damaged.alias("raw_content"), F.lit("damaged").alias("_source_file")
    )


# --- parameters of the maintenance queries -------------------------------------------------


def limits(spark: SparkSession) -> DataFrame:
    """Limits in all four forms, for every machine."""
    forms = [
        ("vibration_mm_s_rms", 50.0, 10.0, 150.0, None, None),
        ("power_consumption_kw", 50.0, 10.0, None, 5.0, 95.0),
        ("film_stress_mpa", 100.0, 10.0, None, 20.0, None),
        ("hermetic_leak_rate_atm_cc_per_s", 0.0, 0.0, None, None, 0.5),
    ]
    rows = [(f"M{number:02d}", *form) for number in range(20) for form in forms]
    return spark.createDataFrame(rows, LIMITS_SCHEMA)


# Machine, location, parameter, its display name, limit text, cause, parts, steps.
KNOWLEDGE = [
    (
        "M00",
        "Bay 1",
        "vibration_mm_s_rms",
        "Vibration",
        "< 150",
        "Worn bearing",
        ["Bearing (P/N: BRG-01)", "Grease"],
        ["Stop the spindle", "Replace the bearing"],
    ),
    (
        "M00",
        "Bay 1",
        "film_stress_mpa",
        "Film Stress",
        "> 20",
        "Drifting pressure",
        ["Gauge (P/N: GAU-7)"],
        ["Calibrate the gauge"],
    ),
    (
        "M05",
        "Bay 2",
        "vibration_mm_s_rms",
        "Vibration",
        "< 150",
        "Loose mount",
        ["Mount bolt (P/N: BLT-M8)", "Washer (P/N: WSH-8)"],
        ["Tighten the bolts", "Check the level", "Run a test"],
    ),
    ("M07", "Bay 3", "vibration_mm_s_rms", "Vibration", "< 150", "Unbalanced rotor", [], []),
]


def knowledge(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KNOWLEDGE, KNOWLEDGE_SCHEMA)


