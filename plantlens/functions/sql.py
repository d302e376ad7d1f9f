"""The functions of this package for SQL users, as SQL functions that the optimizer inlines.

Their bodies are made from the same tables and limits as the column functions. In the catalog of a
lake they belong to its database; a session that opens the lake has them by their short names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from plantlens.functions.measures import HIGH_PCT, MEDIUM_PCT, SIGMA_LIMIT
from plantlens.functions.stages import STAGES, UNKNOWN_STAGE


@dataclass(frozen=True)
class SqlFunction:
    parameters: str
    returns: str
    body: str
    comment: str


def text(value: str) -> str:
    """A SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _stage_entry(position: int) -> str:
    entries = ", ".join(f"{text(k)}, {_literal(v[position])}" for k, v in STAGES.items())
    return f"coalesce(element_at(map({entries}), stage), {_literal(UNKNOWN_STAGE[position])})"


def _literal(value: int | str) -> str:
    return text(value) if isinstance(value, str) else str(value)


FUNCTIONS = {
    "date_key_of": SqlFunction(
        "moment TIMESTAMP",
        "INT",
        "year(moment) * 10000 + month(moment) * 100 + dayofmonth(moment)",
        "Day as a number such as 20260304",
    ),
    "shift_of": SqlFunction(
        "hour_of_day INT",
        "STRING",
        "CASE WHEN hour_of_day BETWEEN 6 AND 13 THEN 'Day' "
        "WHEN hour_of_day BETWEEN 14 AND 21 THEN 'Swing' ELSE 'Night' END",
        "Working shift of an hour; no hour is night",
    ),
    "is_weekend_day": SqlFunction(
        "day DATE",
        "BOOLEAN",
        "coalesce(dayofweek(day) IN (1, 7), false)",
        "Whether a day is Saturday or Sunday",
    ),
    "stage_sequence_of": SqlFunction(
        "stage STRING", "INT", _stage_entry(0), "Position of a process stage in the flow"
    ),
    "stage_category_of": SqlFunction(
        "stage STRING", "STRING", _stage_entry(1), "Category of a process stage"
    ),
    "bandwidth_of": SqlFunction(
        "upper_ghz DOUBLE, lower_ghz DOUBLE",
        "DOUBLE",
        "round(upper_ghz - lower_ghz, 3)",
        "Width of a frequency band",
    ),
    "rate_pct_of": SqlFunction(
        "part BIGINT, whole BIGINT",
        "DECIMAL(38, 2)",
        "round(part * 100.0 / nullif(whole, 0), 2)",
        "Part in percent of the whole; NULL if there is none",
    ),
    "out_of_spec_flag_of": SqlFunction(
        "value DOUBLE, series_mean DOUBLE, series_stddev DOUBLE",
        "INT",
        f"int(coalesce(abs(value - series_mean) > {SIGMA_LIMIT} * series_stddev, false))",
        "1 if a value lies strictly beyond the limit of its series",
    ),
    "variation_of": SqlFunction(
        "series_mean DOUBLE, series_stddev DOUBLE",
        "DOUBLE",
        "CASE WHEN abs(series_mean) > 0 THEN series_stddev / abs(series_mean) END",
        "Spread relative to the size of the mean; NULL if that is 0",
    ),
    "severity_of": SqlFunction(
        "pct DOUBLE",
        "STRING",
        f"CASE WHEN pct > {HIGH_PCT} THEN 'high' WHEN pct > {MEDIUM_PCT} THEN 'medium' "
        "ELSE 'low' END",
        "Severity of an out-of-spec percentage",
    ),
}


def create_functions(spark: SparkSession, database: str | None = None) -> list[str]:
    """Make the functions known to this session or, with a database, to all of its catalog.

    Functions of a database that are there already are replaced.
    """
    for name, made in FUNCTIONS.items():
        scope, place = ("", f"{database}.{name}") if database else ("TEMPORARY ", name)
        spark.sql(
            f"CREATE OR REPLACE {scope}FUNCTION {place}({made.parameters}) "
            f"RETURNS {made.returns} COMMENT {text(made.comment)} RETURN {made.body}"
        )
    return list(FUNCTIONS)
