"""Collecting queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from plantlens.session import use_utc

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a function of (spark, folder of tables) under `name`."""

    def register(run: Run) -> Run:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(use_utc(spark), sf_dir)

        QUERIES[name] = Query(in_utc, sql)
        return run

    return register
