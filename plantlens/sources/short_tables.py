"""Short tables of a lake that are replaced together: dimensions, statistics, attribute sets.

Each replacement is a folder of its own, `_short/<batch>-<attempt>/<table>`, written once by plain
Spark jobs and never changed. The last job writes `_complete`; its success marker tells readers that
all tables are there. Catalog tables are pointed to the new folder by their location. Queries planned
on the folder before can finish, as it is kept; a failed write leaves a folder that nobody reads.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plantlens.schemas import TableSpec
from plantlens.sources.files import delete_folder, exists, names_in

Tables = list[tuple[TableSpec, DataFrame]]
KEPT = 2
COMPLETE = "_complete"


def _folder(lake: str) -> str:
    return f"{lake.rstrip('/')}/_short"


def _attempts(spark: SparkSession, lake: str) -> list[tuple[int, int]]:
    """(batch, attempt) of all folders, complete or not. A few, as old ones are deleted."""
    names = [n.split("-") for n in names_in(spark, _folder(lake))]
    return sorted((int(batch), int(attempt)) for batch, attempt in names)


def _path(lake: str, written: tuple[int, int]) -> str:
    return f"{_folder(lake)}/{written[0]}-{written[1]}"


def _complete(spark: SparkSession, lake: str) -> list[tuple[int, int]]:
    return [
        w for w in _attempts(spark, lake) if exists(spark, f"{_path(lake, w)}/{COMPLETE}/_SUCCESS")
    ]


def batches_written(spark: SparkSession, lake: str) -> list[int]:
    """Batches after which the short tables were replaced and are still kept, in order."""
    return sorted({batch for batch, _ in _complete(spark, lake)})


def short_table_path(
    spark: SparkSession, lake: str, spec: TableSpec, batch: int | None = None
) -> str | None:
    """Where a table lies now, or lay after `batch`; None before the first write."""
    written = [w for w in _complete(spark, lake) if batch is None or w[0] == batch]
    return f"{_path(lake, written[-1])}/{spec.name}" if written else None


def read_short_table(
    spark: SparkSession, lake: str, spec: TableSpec, batch: int | None = None
) -> DataFrame:
    path = short_table_path(spark, lake, spec, batch)
    if path is None:
        return spark.createDataFrame([], spec.schema)
    return spark.read.schema(spec.schema).parquet(path)


def write_all(path: str, tables: Tables) -> None:
    for spec, df in tables:
        df.select(*spec.schema.names).write.parquet(f"{path}/{spec.name}")


def write_short_tables(
    spark: SparkSession,
    lake: str,
    batch: int,
    tables: Tables,
    derived: Callable[[DataFrame], Tables] | None = None,
) -> None:
    """Write the state after `batch` to a new folder and delete those no longer kept.

    `derived` gives further tables from the last of the first ones, read from where it was written,
    so that it is computed once and nothing else is kept of it.
    """
    attempts = [attempt for number, attempt in _attempts(spark, lake) if number == batch]
    written = (batch, max(attempts, default=-1) + 1)
    path = _path(lake, written)
    write_all(path, tables)
    if derived:
        last = tables[-1][0]
        more = derived(spark.read.schema(last.schema).parquet(f"{path}/{last.name}"))
        write_all(path, more)
        tables = [*tables, *more]
    names = [(spec.name,) for spec, _ in tables]
    spark.createDataFrame(names, "table string").coalesce(1).write.parquet(f"{path}/{COMPLETE}")
    kept = _complete(spark, lake)[-KEPT:]
    for old in _attempts(spark, lake):
        if old < written and old not in kept:
            delete_folder(spark, _path(lake, old))
