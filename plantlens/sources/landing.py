"""Reading landed files: unparsed lines with their file, or JSON with inferred columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The file source skips, without a word, files whose modification time lies further than this
# before the newest one it has seen. A hundred thousand years reach from any time that a file
# system can hold to before 1970, so that no file is ever skipped for its time.
REMEMBER_FILES_FOR = "36500000d"
# A micro-batch takes about this much unless told otherwise.
BATCH_BYTES = 1 << 40


def bronze_columns() -> list[Column]:
    """Rename the text column and add the file it came from and the processing time."""
    return [
        F.col("value").alias("raw_content"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_modification_time").alias("_source_file_timestamp"),
        F.col("_metadata.file_size").alias("_source_file_size"),
        F.current_timestamp().alias("_ingested_at"),
    ]


def _scan_options(path_glob: str | None) -> dict[str, str]:
    options = {"recursiveFileLookup": "true"}
    if path_glob:
        options["pathGlobFilter"] = path_glob
    return options


def read_lines(spark: SparkSession, path: str, path_glob: str | None = None) -> DataFrame:
    """Every line of every file below `path`, as the bronze columns."""
    return spark.read.options(**_scan_options(path_glob)).text(path).select(*bronze_columns())


def bounded(reader, max_files: int | None, max_bytes: int | None):
    """Bound a micro-batch by files or by bytes, so that a large backlog becomes several.

    A failed micro-batch is done again as a whole, which is cheap only if it is not all of it.
    """
    if max_files and max_bytes:
        raise ValueError("bound a micro-batch by files or by bytes, not both")
    if max_files:
        return reader.option("maxFilesPerTrigger", max_files)
    return reader.option("maxBytesPerTrigger", max_bytes or BATCH_BYTES)


def stream_lines(
    spark: SparkSession,
    path: str,
    path_glob: str | None = None,
    max_files: int | None = None,
    max_bytes: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """As `read_lines`, taking each file once: those already there first, then new ones.

    A file counts by its path, whatever its modification time. The paths seen stay in the memory
    of the driver, some 200 bytes each. With `archive`, a folder outside `path`, files are moved
    there once they are done, so that listings stay short.
    """
    reader = spark.readStream.options(**_scan_options(path_glob), maxFileAge=REMEMBER_FILES_FOR)
    if archive:
        reader = reader.options(cleanSource="archive", sourceArchiveDir=archive)
    return bounded(reader, max_files, max_bytes).text(path).select(*bronze_columns())


def read_json_inferred(spark: SparkSession, path: str, path_glob: str | None = None) -> DataFrame:
    """JSON lines with inferred columns, for a first look.

    Inference reads the data once more, and the sensor map comes out as a struct with one field
    per parameter. Use `parse_lines` for the typed form.
    """
    return spark.read.options(**_scan_options(path_glob)).json(path)
