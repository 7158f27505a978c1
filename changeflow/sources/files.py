"""Parquet folders as batch or streaming input."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INGESTED_AT = "_ingested_at"
SOURCE_FILE = "_source_file"


def with_lineage(df: DataFrame) -> DataFrame:
    """Add when a row was read (one value per micro-batch) and from which file."""
    return df.withColumn(INGESTED_AT, F.current_timestamp()).withColumn(
        SOURCE_FILE, F.col("_metadata.file_path")
    )


def read_files(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All parquet files below ``path``, at any depth."""
    reader = spark.read.option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    path_glob: str | None = None,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """A stream of the parquet files below ``path``, each read once, however old it is.

    The file source forgets files older than ``maxFileAge`` (a week by default) and would
    then skip a late file that kept its old time stamp; the wide value keeps it.
    """
    reader = (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", "36500d")
    )
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.parquet(path)


def stream_names(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A stream of the names of the files below ``path``, a row of ``path`` each. None is opened."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true")
        .option("maxFileAge", "36500d")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select("path")


def read_named(spark: SparkSession, files: Sequence[str], schema: T.StructType | None = None) -> DataFrame:
    """Parquet files by their exact names. Without a schema, the union of their columns."""
    reader = spark.read.schema(schema) if schema is not None else spark.read.option("mergeSchema", "true")
    return reader.parquet(*[re.sub(r"([\\{}\[\]*?])", r"\\\1", name) for name in files])


def ingest_files(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """The incremental source: :func:`stream_files` with the two lineage columns."""
    return with_lineage(stream_files(spark, path, schema, **options))
