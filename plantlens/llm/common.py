"""Helpers shared by the operators: stored frames, joins with hot keys, maps over texts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plantlens.session import shared_dir

ROWS_AT_ONCE = 512
HEAVY_SHARE = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write `df` to the shared folder and read it back: computed once, no lineage left.

    Within `session.scratch` it lies in the folder of the scope and is removed with it. `path`, taken
    from `shared_dir` outside, lets it stay.
    """
    path = path or shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_bytes(df: DataFrame) -> int:
    """Spark's size of a stored frame, from its files."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def without(df: DataFrame, names: list[str]) -> DataFrame:
    """`df` without columns whose names an operator is about to add."""
    taken = {name.lower() for name in names}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in taken))


def fresh(name: str, *frames: DataFrame) -> str:
    """`name`, made longer until none of the frames has a column of that name."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def join_hot(
    rows: DataFrame, lookup: DataFrame, key: list[str], count: str, spread: Column, how: str
) -> DataFrame:
    """Join `lookup` to `rows` on `key`, with the rows of frequent keys spread over many tasks.

    `lookup` is stored, has one row per key and says in `count` how many rows carry it. A key with
    over a 512th of all of them is heavy, so there are fewer than 512, which are broadcast. Heavy
    keys get as many salts as they have such shares: the row takes one by `spread`, the lookup is
    repeated for each. Null keys match nothing. `how` is inner or left.
    """
    total = lookup.agg(F.sum(count)).first()[0] or 0
    limit = max(1000, total // HEAVY_SHARE)
    salt, salts = fresh("_salt", rows, lookup), fresh("_salts", rows, lookup)
    shares_of_key = F.ceil(F.col(count) / F.lit(limit)).cast("int").alias(salts)
    heavy = lookup.where(F.col(count) > limit).select(*key, shares_of_key)
    salted = rows.join(F.broadcast(heavy), key, "left").withColumn(
        salt, F.coalesce(F.pmod(F.xxhash64(spread), F.col(salts)).cast("int"), F.lit(0))
    )
    shares = F.when(
        F.col(count) > limit, F.sequence(F.lit(0), F.ceil(F.col(count) / F.lit(limit)).cast("int") - 1)
    ).otherwise(F.array(F.lit(0)))
    repeated = lookup.withColumn(salt, F.explode(shares)).drop(count)
    return salted.drop(salts).join(repeated, [*key, salt], how).drop(salt)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, ROWS_AT_ONCE):
        yield batch.slice(start, ROWS_AT_ONCE)


def map_texts(
    df: DataFrame,
    column: str,
    fields: list[T.StructField],
    compute: Callable[[list[bytes]], list],
    keep: bool = True,
    cast: str | None = "binary",
) -> DataFrame:
    """Add `fields`, computed from the UTF-8 bytes of a text column, a few hundred rows at a time.

    `compute` gets the texts (null as empty) and returns one array or list per field. A field
    named like `column` replaces it; `keep` false drops the text. Without `cast` a column of another
    type is given as it is.
    """
    names = [field.name for field in fields]
    base = without(df, names if keep else [*names, column])
    given = F.col(f"`{column}`").cast(cast) if cast else F.col(f"`{column}`")
    source = df.select(
        *(F.col(f"`{c}`") for c in base.columns), given.alias(fresh("_bytes", df))
    )
    schema = T.StructType([*base.schema.fields, *fields])
    arrow = to_arrow_schema(schema)
    added = [arrow.field(name).type for name in names]
    n_kept = len(base.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                texts = [t or b"" for t in part.column(n_kept).to_pylist()]
                columns = [
                    c if isinstance(c, pa.Array) else pa.array(c, kind)
                    for c, kind in zip(compute(texts), added, strict=True)
                ]
                kept = [part.column(i) for i in range(n_kept)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, *columns], names=[*part.schema.names[:n_kept], *names]
                )

    return source.mapInArrow(run, schema)
