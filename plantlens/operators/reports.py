"""Maintenance knowledge for findings, and one report per machine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plantlens.operators.joins import lookup_join, require_unique
from plantlens.schemas import KNOWLEDGE_SCHEMA

# How a part names its number.
PART_NUMBER = r"\(P/N: ([^)]+)\)"
# Headings of a report, in their order.
TITLE = "MAINTENANCE & REMEDIATION REPORT"
FOUND = " parameters with anomalies detected"
SUMMARY = "ANOMALY SUMMARY"
CAUSE = "Root Cause Analysis"
PARTS = "Parts Required"
STEPS = "Remediation Steps"


def read_knowledge(spark: SparkSession, path: str) -> DataFrame:
    """Knowledge from JSON lines, one object per machine and parameter."""
    return spark.read.schema(KNOWLEDGE_SCHEMA).json(path)


def explain_findings(findings: DataFrame, knowledge: DataFrame, **join_options) -> DataFrame:
    """Findings with cause, threshold text, parts and steps; unknown parameters stay without.

    Knowledge listed twice for a machine and parameter is refused, as it would repeat findings.
    """
    require_unique(knowledge, ["machine_id", "param_key"])
    known = knowledge.withColumnRenamed("param_key", "parameter_name")
    return lookup_join(findings, known, ["machine_id", "parameter_name"], "left", **join_options)


def parts_list(explained: DataFrame) -> DataFrame:
    """One row per part of a finding, with the part number taken out of its text."""
    number = F.regexp_extract("part", PART_NUMBER, 1)
    return explained.select(
        "machine_id", "parameter_name", F.explode("parts").alias("part")
    ).select(
        "machine_id",
        "parameter_name",
        F.trim(F.regexp_replace("part", PART_NUMBER, "")).alias("part_name"),
        F.nullif(number, F.lit("")).alias("part_number"),
    )


def remediation_steps(explained: DataFrame) -> DataFrame:
    """One row per step of a finding, numbered from 1."""
    return explained.select(
        "machine_id", "parameter_name", F.posexplode("remediation").alias("position", "step")
    ).select("machine_id", "parameter_name", (F.col("position") + 1).alias("step_no"), "step")


def _joined(separator: str, *parts: Column) -> Column:
    """Parts that are not NULL, with `separator` between them."""
    return F.concat_ws(separator, *parts)


def _summary_row(finding: Column) -> Column:
    return _joined(
        " | ",
        finding["name"],
        finding["mean"].cast("string"),
        finding["stddev"].cast("string"),
        F.concat(finding["oos_pct"].cast("string"), F.lit("%")),
        finding["severity"],
        finding["threshold"],
    )


def _bullets(items: Column, line) -> Column:
    """The items of an array as lines, or NULL when there are none."""
    return F.when(F.size(items) > 0, F.array_join(F.transform(items, line), "\n"))


def _section(finding: Column) -> Column:
    """A finding's heading, cause, parts and steps; a part without content is left out."""
    heading = F.concat(
        finding["rank"].cast("string"),
        F.lit(". "),
        finding["name"],
        F.lit(" ("),
        finding["parameter_name"],
        F.lit(")"),
    )
    parts = _bullets(finding["parts"], lambda part: F.concat(F.lit("  "), part))
    steps = _bullets(
        finding["remediation"],
        lambda step, i: F.concat(F.lit("  "), (i + 1).cast("string"), F.lit(". "), step),
    )
    return _joined(
        "\n",
        heading,
        F.concat(F.lit(CAUSE + "\n"), finding["root_cause"]),
        F.concat(F.lit(PARTS + "\n"), parts),
        F.concat(F.lit(STEPS + "\n"), steps),
    )


def _one_row_each(dimension: DataFrame, key: str) -> DataFrame:
    """One row per key; attributes with several values list them."""
    attributes = [column for column in dimension.columns if column != key]
    return dimension.groupBy(key).agg(
        *(F.array_join(F.sort_array(F.collect_set(c)), " / ").alias(c) for c in attributes)
    )


def assemble_reports(
    explained: DataFrame, machines: DataFrame, lines: DataFrame, report_date: Column | None = None
) -> DataFrame:
    """One row per machine with findings: header fields, ordered findings and the text body.

    The findings of a machine are at most one per parameter, so the list is as short as the
    machine's parameter set, or as the `top` of the watch list. `machines` and `lines` are the
    dimensions. An attribute that has changed over time shows all its values, in order, so that a
    machine has one report however its dimension drifts. The report date is left out unless given.
    """
    finding = F.struct(
        "rank",
        "parameter_name",
        F.coalesce("name", "parameter_name").alias("name"),
        "mean",
        "stddev",
        "oos_pct",
        "severity",
        "threshold",
        "root_cause",
        "parts",
        "remediation",
    )
    per_machine = explained.groupBy("machine_id").agg(
        F.max("location").alias("location"),
        F.sort_array(F.collect_list(finding)).alias("findings"),
    )
    placed = machines.join(lines.select("line_id", "line_name", "product_type"), "line_id")
    headed = per_machine.join(_one_row_each(placed, "machine_id"), "machine_id")
    findings = F.col("findings")
    count = F.size(findings)
    stage = F.initcap(F.replace(F.col("process_stage"), F.lit("_"), F.lit(" ")))
    report_day = (F.lit(None) if report_date is None else report_date).cast("string")

    def field(label: str, value: Column) -> Column:
        return F.concat(F.lit(label + ": "), value)

    body = _joined(
        "\n",
        F.lit(TITLE),
        field("Machine ID", F.col("machine_id")),
        field("Location", F.col("location")),
        field("Machine Type", F.col("machine_type")),
        field("Line", F.concat(F.col("line_id"), F.lit(" ("), F.col("product_type"), F.lit(")"))),
        field("Process Stage", stage),
        field("Report Date", report_day),
        field("Parameters", F.concat(count.cast("string"), F.lit(FOUND))),
        F.lit(SUMMARY),
        F.array_join(F.transform(findings, _summary_row), "\n"),
        F.array_join(F.transform(findings, _section), "\n"),
    )
    return headed.select(
        "machine_id",
        "machine_type",
        "line_id",
        "line_name",
        "product_type",
        "process_stage",
        "location",
        count.alias("finding_count"),
        "findings",
        body.alias("body"),
    )
