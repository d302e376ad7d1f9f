"""Joining many rows to a lookup whose size is checked first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantlens.session import materialize

# A lookup is broadcast up to this many bytes of column text plus overhead per value.
BROADCAST_BYTES = 10 * 1024 * 1024
VALUE_OVERHEAD = 16
# A key with more than this share of the rows is spread over several tasks.
HEAVY_SHARE = 512


def payload_bytes(df: DataFrame) -> int:
    """Size of a frame, measured on its values in one small job."""
    size = F.lit(0)
    for column in df.columns:
        text = F.octet_length(F.col(f"`{column}`").cast("string"))
        size = size + F.coalesce(text, F.lit(0)) + VALUE_OVERHEAD
    return df.agg(F.sum(size.cast("long")).alias("bytes")).first()["bytes"] or 0


def fits_broadcast(lookup: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    return payload_bytes(lookup) <= max_bytes


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
    heavy_share: int = HEAVY_SHARE,
) -> DataFrame:
    """Join `rows` to `lookup` on equal `keys`; `how` is "inner" or "left".

    `lookup` should be stored (a table, a checkpoint or a literal frame): its size is measured
    before the join. A lookup within `max_bytes` is broadcast, and `rows` are not shuffled.

    Beyond that the join shuffles both sides, whatever Spark takes the lookup's size to be. Keys
    are counted once. One with over a `heavy_share`-th of the rows, of which there are fewer than
    `heavy_share`, is cut into as many parts as it has such shares: a row takes its part by a
    hash of itself, the lookup is repeated for each part. Rows with a NULL key match nothing and
    are spread over all parts. `rows` are read twice in all.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type: {how}")
    if fits_broadcast(lookup, max_bytes):
        return rows.join(F.broadcast(lookup), keys, how)

    has_key = " AND ".join(f"`{key}` IS NOT NULL" for key in keys)
    heavy = F.broadcast(heavy_keys(rows.filter(has_key), keys, heavy_share))
    hashed = [f.name for f in rows.schema if not _holds_map(f.dataType)]
    # Copies of a row in different input partitions differ by the partition.
    draw = F.xxhash64(F.spark_partition_id(), *(F.col(f"`{name}`") for name in hashed))
    parts = F.when(F.expr(has_key), F.coalesce("_parts", F.lit(1))).otherwise(heavy_share)
    dealt = rows.join(heavy, keys, "left").withColumn("_part", F.pmod(draw, parts).cast("int"))
    every_part = F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))
    repeated = lookup.join(heavy, keys, "left").withColumn("_part", every_part).drop("_parts")
    joined = dealt.drop("_parts").join(repeated.hint("merge"), [*keys, "_part"], how)
    return joined.drop("_part")


def heavy_keys(rows: DataFrame, keys: list[str], share: int) -> DataFrame:
    """Keys with over a `share`-th of the rows, and into how many `_parts` they are cut."""
    counted = materialize(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")))
    total = counted.agg(F.sum("_rows")).first()[0] or 0
    limit = F.lit(max(1, total // share))
    found = counted.filter(F.col("_rows") > limit)
    return found.select(*keys, F.ceil(F.col("_rows") / limit).cast("int").alias("_parts"))


def _holds_map(kind: T.DataType) -> bool:
    """Whether values have a map in them, which cannot be hashed."""
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    return isinstance(kind, T.MapType)


def require_unique(lookup: DataFrame, keys: list[str]) -> None:
    """Refuse a lookup in which a key occurs twice: it would multiply the rows that it joins."""
    repeated = lookup.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    found = repeated.limit(3).collect()
    if found:
        listed = ", ".join(str(tuple(row[key] for key in keys)) for row in found)
        raise ValueError(f"keys listed more than once: {listed}")
