"""Schemas of the stored tables, with the comment, properties and partitioning of each."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

STRING, BOOLEAN, DOUBLE = T.StringType(), T.BooleanType(), T.DoubleType()
INT, BIGINT = T.IntegerType(), T.LongType()
DATE, TIMESTAMP = T.DateType(), T.TimestampType()
PARAMETERS = T.MapType(STRING, DOUBLE)
STRINGS = T.ArrayType(STRING)


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


READING_SCHEMA = _struct(
    record_id=STRING,
    timestamp=STRING,
    plant_id=STRING,
    line_id=STRING,
    line_name=STRING,
    product_type=STRING,
    target_frequency_band_ghz_min=DOUBLE,
    target_frequency_band_ghz_max=DOUBLE,
    machine_id=STRING,
    machine_type=STRING,
    process_stage=STRING,
    is_anomaly=BOOLEAN,
    telemetry=PARAMETERS,
)

BRONZE_SCHEMA = _struct(
    raw_content=STRING,
    _source_file=STRING,
    _source_file_timestamp=TIMESTAMP,
    _source_file_size=BIGINT,
    _ingested_at=TIMESTAMP,
)

SILVER_SCHEMA = _struct(
    record_id=STRING,
    event_timestamp=TIMESTAMP,
    plant_id=STRING,
    line_id=STRING,
    line_name=STRING,
    product_type=STRING,
    target_frequency_band_ghz_min=DOUBLE,
    target_frequency_band_ghz_max=DOUBLE,
    machine_id=STRING,
    machine_type=STRING,
    process_stage=STRING,
    is_anomaly=BOOLEAN,
    telemetry=PARAMETERS,
    _source_file=STRING,
    _loaded_at=TIMESTAMP,
)

FACT_SCHEMA = _struct(
    record_id=STRING,
    event_timestamp=TIMESTAMP,
    date_key=INT,
    hour_of_day=INT,
    plant_id=STRING,
    line_id=STRING,
    machine_id=STRING,
    process_stage=STRING,
    is_anomaly=BOOLEAN,
    parameter_name=STRING,
    parameter_value=DOUBLE,
    _source_file=STRING,
    _loaded_at=TIMESTAMP,
)

LINE_SCHEMA = _struct(
    line_id=STRING,
    line_name=STRING,
    product_type=STRING,
    target_frequency_band_ghz_min=DOUBLE,
    target_frequency_band_ghz_max=DOUBLE,
    target_bandwidth_ghz=DOUBLE,
)

MACHINE_SCHEMA = _struct(
    machine_id=STRING,
    machine_type=STRING,
    process_stage=STRING,
    line_id=STRING,
)

DATE_SCHEMA = _struct(
    date_key=INT,
    full_date=DATE,
    year=INT,
    quarter=INT,
    month=INT,
    month_name=STRING,
    day_of_month=INT,
    day_of_week=INT,
    day_name=STRING,
    week_of_year=INT,
    is_weekend=BOOLEAN,
)

STAGE_SCHEMA = _struct(
    process_stage=STRING,
    stage_sequence=INT,
    stage_category=STRING,
)

STATS_SCHEMA = _struct(
    machine_id=STRING,
    parameter_name=STRING,
    overall_mean=DOUBLE,
    overall_stddev=DOUBLE,
    series_rows=BIGINT,
    # Rows with a value; with mean and deviation it is what merging needs.
    series_values=BIGINT,
)

# What the dimensions are made of: attribute combinations per day, its date in event_timestamp.
SETS_SCHEMA = _struct(
    line_id=STRING,
    line_name=STRING,
    product_type=STRING,
    target_frequency_band_ghz_min=DOUBLE,
    target_frequency_band_ghz_max=DOUBLE,
    machine_id=STRING,
    machine_type=STRING,
    process_stage=STRING,
    event_timestamp=DATE,
)

EXPECTATION_LOG_SCHEMA = _struct(
    table_name=STRING,
    run_id=STRING,
    batch_id=BIGINT,
    batch_time=TIMESTAMP,
    rows=BIGINT,
    expectation=STRING,
    failed=BIGINT,
)

LIMITS_SCHEMA = _struct(
    machine_id=STRING,
    parameter_name=STRING,
    mean=DOUBLE,
    std=DOUBLE,
    threshold=DOUBLE,
    threshold_low=DOUBLE,
    threshold_high=DOUBLE,
)

KNOWLEDGE_SCHEMA = _struct(
    machine_id=STRING,
    location=STRING,
    param_key=STRING,
    name=STRING,
    threshold=STRING,
    root_cause=STRING,
    parts=STRINGS,
    remediation=STRINGS,
)


LOAD_DAY = "_loaded_on"


@dataclass(frozen=True)
class TableSpec:
    """What is known about a stored table besides its rows."""

    name: str
    schema: T.StructType
    comment: str
    properties: dict[str, str]
    partition_by: tuple[str, ...] = ()
    expectations: dict[str, str] = field(default_factory=dict)
    # The column with the time of loading, in streamed tables.
    loaded: str = ""

    @property
    def stored_schema(self) -> T.StructType:
        """The columns as they are stored: streamed tables are laid out by day of loading first."""
        day = [T.StructField(LOAD_DAY, DATE)] if self.loaded else []
        return T.StructType([*self.schema.fields, *day])

    @property
    def stored_partitions(self) -> tuple[str, ...]:
        return (LOAD_DAY, *self.partition_by) if self.loaded else self.partition_by


BRONZE = TableSpec(
    "bronze_raw_telemetry",
    BRONZE_SCHEMA,
    "Landed lines, unparsed, with the file each one came from",
    {"quality": "bronze", "compaction": "by size"},
    loaded="_ingested_at",
)
SILVER = TableSpec(
    "silver_telemetry",
    SILVER_SCHEMA,
    "Typed readings; rows that fail an expectation are counted and kept",
    {"quality": "silver", "compaction": "by size"},
    ("line_id",),
    {
        "valid_record_id": "record_id IS NOT NULL",
        "valid_timestamp": "event_timestamp IS NOT NULL",
        "valid_machine_id": "machine_id IS NOT NULL",
    },
    "_loaded_at",
)
FACT = TableSpec(
    "gold_fact_telemetry",
    FACT_SCHEMA,
    "One row per reading and sensor parameter",
    {"quality": "gold", "compaction": "by parameter_name, machine_id, event_timestamp"},
    # Not by day: that costs a sort and many small files, and no KPI asks for single days.
    (),
    {
        "valid_record": "record_id IS NOT NULL",
        "valid_param_name": "parameter_name IS NOT NULL",
        "valid_param_value": "parameter_value IS NOT NULL",
    },
    "_loaded_at",
)
DIM_LINE = TableSpec(
    "gold_dim_production_line",
    LINE_SCHEMA,
    "Production lines with product and target band",
    {"quality": "gold"},
)
DIM_MACHINE = TableSpec(
    "gold_dim_machine",
    MACHINE_SCHEMA,
    "Machines with type, stage and line",
    {"quality": "gold"},
)
DIM_DATE = TableSpec(
    "gold_dim_date",
    DATE_SCHEMA,
    "Calendar days on which readings were taken",
    {"quality": "gold"},
)
DIM_STAGE = TableSpec(
    "gold_dim_process_stage",
    STAGE_SCHEMA,
    "Process stages with their order and category",
    {"quality": "gold"},
)

STATS = TableSpec(
    "gold_parameter_stats",
    STATS_SCHEMA,
    "Mean and deviation per machine and parameter over the whole fact",
    {"quality": "gold"},
)

SETS = TableSpec(
    "gold_attribute_sets",
    SETS_SCHEMA,
    "Attribute combinations per day, of which the dimensions are distinct parts",
    {"quality": "gold"},
)
EXPECTATION_LOG = TableSpec(
    "expectation_log",
    EXPECTATION_LOG_SCHEMA,
    "Rows and failed rows per expectation and micro-batch",
    {"quality": "log"},
)

# Short tables that are replaced together.
SHORT = (DIM_LINE, DIM_MACHINE, DIM_DATE, DIM_STAGE, STATS, SETS)
STREAMED = (BRONZE, SILVER, FACT)
TABLES = (*STREAMED, DIM_LINE, DIM_MACHINE, DIM_DATE, DIM_STAGE, STATS)
