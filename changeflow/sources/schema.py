"""Schemas that are inferred once, kept in the shared store, and only ever gain columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from changeflow.sources.paths import NumberedFiles
from changeflow.sources.rescue import CANNOT_MERGE


def widen(known: T.StructType, seen: T.StructType) -> T.StructType:
    """``known`` followed by the columns only ``seen`` has, everything nullable.

    A column that changed its type is an error: reading it under either type would lose
    values without a word.
    """
    types = {field.name: field.dataType for field in known}
    for field in seen:
        if types.get(field.name, field.dataType) != field.dataType:
            raise ValueError(
                f"column {field.name} was {types[field.name].simpleString()}"
                f" and now arrives as {field.dataType.simpleString()}"
            )
    fields = [*known, *(field for field in seen if field.name not in types)]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields])


def with_new_columns(known: T.StructType, seen: T.StructType) -> T.StructType:
    """``known`` followed by the columns only ``seen`` has; one that changed its type keeps its own."""
    names = set(known.names)
    return widen(known, T.StructType([f for f in seen if f.name not in names]))


def infer_schema(spark: SparkSession, path: str, path_glob: str | None = None) -> T.StructType:
    """The union of the schemas of all files below ``path``. Reads footers only, as a Spark job."""
    reader = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    return reader.parquet(path).schema


def stored_schema(spark: SparkSession, location: str) -> T.StructType:
    """The schema as last tracked; no columns if there is none yet."""
    stored = NumberedFiles(spark, location).latest()[1]
    return T.StructType.fromJson(stored) if stored else T.StructType([])


def starting_schema(spark: SparkSession, path: str, location: str) -> T.StructType:
    """The stored schema or, for a start, that of all files; reads no footers once it is stored.

    Where the files of the start disagree on a type, that of one file is the start, and the
    others are held against it when their batch comes."""
    stored = stored_schema(spark, location)
    if stored:
        return stored
    try:
        return tracked_schema(spark, path, location)
    except Exception as error:  # the bridge to the JVM does not translate this one
        if CANNOT_MERGE not in str(error):
            raise
    first = spark.read.option("recursiveFileLookup", "true").parquet(path).schema
    return grow_schema(spark, location, [first])


def grow_schema(spark: SparkSession, location: str, seen: Sequence[T.StructType]) -> T.StructType:
    """The stored schema with the columns that are new in those seen, which is stored if there are any."""
    log = NumberedFiles(spark, location)
    known = stored_schema(spark, location)
    current = known
    for schema in seen:
        current = with_new_columns(current, schema)
    if current != known:
        log.put(log.latest()[0] + 1, current.jsonValue())
    return current


def tracked_schema(
    spark: SparkSession, path: str, location: str, path_glob: str | None = None
) -> T.StructType:
    """The stored schema plus any new columns in the files; stores the result if it grew."""
    known = stored_schema(spark, location)
    try:
        seen = infer_schema(spark, path, path_glob)
    except AnalysisException as error:
        # Files may have been moved away after they were read.
        if not known or error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return known
    current = widen(known, seen)
    if current != known:
        log = NumberedFiles(spark, location)
        log.put(log.latest()[0] + 1, current.jsonValue())
    return current
