"""Session settings and the shared folder used for checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Date keys and hours of `Z` timestamps follow the session time zone, so it is pinned.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Tables are looked up anew by each query, so that what streams have appended is seen.
    "spark.sql.filesourceTableRelationCacheSize": "0",
}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings above. `settings` use `_` for `.` in option names."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the time zone of a session that was built elsewhere."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def require_utc(spark: SparkSession) -> None:
    """Refuse to write or read day and hour columns under another time zone."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError(f"the session time zone is {zone}, not UTC; see session.use_utc")


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder under `spark.checkpoint.dir`, the folder all executors can reach.

    Only a local session without that setting falls back to a temporary folder.
    """
    scope = _scope.get()
    if scope:
        return f"{scope}/{label}-{uuid.uuid4().hex}"
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix=f"run-{label}-")
    raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")


_scope: ContextVar[str | None] = ContextVar("scope", default=None)


@contextmanager
def scratch(spark: SparkSession, label: str) -> Iterator[str]:
    """Folders of `shared_dir` made within lie in one folder, which is removed at the end.

    What is to last must be written elsewhere before: a path taken from `shared_dir` outside. Scopes
    may be nested; a scope that ends by an error is removed as well.
    """
    folder = shared_dir(spark, label)
    token = _scope.set(folder)
    try:
        yield folder
    finally:
        _scope.reset(token)
        place = spark._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame) -> DataFrame:
    """Compute `df` once and keep it in the reliable checkpoint folder."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark, "checkpoints"))
    return df.checkpoint(eager=True)
