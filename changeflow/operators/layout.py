"""File layout: rows that are read together lie together, so min/max statistics skip files
and row groups."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.sources.paths import replace_folder


def cluster_within(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sort inside each task, without a shuffle: for large appends that arrive roughly in order."""
    return df.sortWithinPartitions(*columns) if columns else df


def _hashable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(_hashable(field.dataType) for field in data_type)
    if isinstance(data_type, T.ArrayType):
        return _hashable(data_type.elementType)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def cluster_globally(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """Range-distribute and sort, one shuffle; into ``files`` parts, or as many as adaptive
    execution finds right for their size.

    A hash of the row ends the range key, so one value with a third of all rows is spread
    over many tasks instead of filling one. It depends on the row alone, so a task that
    is run again after a lost executor sends every row to the same place.
    """
    if not columns:
        return df
    hashed = [field.name for field in df.schema if _hashable(field.dataType)]
    parts = () if files is None else (files,)
    return df.repartitionByRange(*parts, *columns, F.xxhash64(*hashed)).sortWithinPartitions(*columns)


# Cells of the curve a column is cut into, a power of two, and rows the cuts are found from. They only
# decide what lies where.
CELLS = 64
SAMPLE = 20_000


def _cuts(df: DataFrame, columns: Sequence[str]) -> list[list]:
    """For each column, values that cut it into at most ``CELLS`` parts of about equal numbers of
    rows, by at most ``SAMPLE`` rows of the least hash; one pass over the columns."""
    number = F.xxhash64(F.monotonically_increasing_id())
    sample = df.select(*columns).withColumn("_hash", number).orderBy("_hash").limit(SAMPLE).collect()
    found = []
    for i in range(len(columns)):
        values = sorted(row[i] for row in sample if row[i] is not None)
        cuts: list = []
        for at in sorted({len(values) * k // CELLS for k in range(1, CELLS)}):
            if values and (not cuts or values[at] > cuts[-1]):
                cuts.append(values[at])
        found.append(cuts)
    return found


def _cell(value: Column, cuts: list, kind: T.DataType, first: int = 0) -> Column:
    """How many cuts are not above a value, by halving; a NULL is before all."""
    if not cuts:
        return F.lit(first)
    middle = len(cuts) // 2
    above = value >= F.lit(cuts[middle]).cast(kind)
    return F.when(above, _cell(value, cuts[middle + 1 :], kind, first + middle + 1)).otherwise(_cell(value, cuts[:middle], kind, first))


def curve(df: DataFrame, columns: Sequence[str], like: DataFrame | None = None) -> Column:
    """The place of a row on a space-filling curve over the quantiles of several columns, which are
    found in ``like`` if it is given and else in the rows themselves.

    The bits of the columns' cells are interleaved, so rows that are near each other on the curve are
    near in every column, and not only in the first.
    """
    bits = CELLS.bit_length() - 1
    cuts = _cuts(df if like is None else like, columns)
    cells = [_cell(F.col(c), own, df.schema[c].dataType) for c, own in zip(columns, cuts, strict=True)]
    place = F.lit(0)
    for bit in range(bits - 1, -1, -1):
        for cell in cells:
            place = place * 2 + F.shiftright(cell, bit).bitwiseAND(1)
    return place


def cluster_by_curve(
    df: DataFrame, columns: Sequence[str], files: int | None = None, like: DataFrame | None = None
) -> DataFrame:
    """As :func:`cluster_globally`, but so that a filter on any one of the columns skips files.

    Costs a pass over the columns before, for their quantiles: of ``like``, if rows that are cheaper to
    read have about the same. One column is simply sorted.
    """
    if len(columns) < 2:
        return cluster_globally(df, columns, files)
    place = "_place"
    while place in df.columns:
        place = f"_{place}"
    laid = df.withColumn(place, curve(df, columns, like).cast("long"))
    return cluster_globally(laid, [place, *columns], files).drop(place)


def file_skips(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows of a DataFrame that was read from files and, for each of the columns, the share of
    files whose range of it leaves the row's value out: what a filter on that value skips. A report on
    a layout, for some hundreds of files."""
    bounds = rows.groupBy("_metadata.file_name").agg(
        *[f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("low", F.min), ("high", F.max))]
    )
    found, files = rows, bounds.collect()  # a row for each file, as a reader's plan has them
    for i, c in enumerate(columns):
        kind = rows.schema[c].dataType
        ends = [(F.lit(f[f"low{i}"]).cast(kind), F.lit(f[f"high{i}"]).cast(kind)) for f in files if f[f"low{i}"] is not None]
        out = [(F.col(c).isNull() | (F.col(c) < low) | (F.col(c) > high)).cast("int") for low, high in ends]
        found = found.withColumn(f"skipped_by_{c}", sum(out, F.lit(0)) / F.lit(max(1, len(ends))))
    return found


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str] = (), files: int | None = None, by_curve: bool = False
) -> None:
    """Replace the folder by the rows, clustered: the sink of a fully recomputed table.

    The rows are written beside the folder and take its place when they are complete, so a
    job that fails leaves the old ones.
    """
    draft = f"{path.rstrip('/')}-draft-{uuid.uuid4().hex}"
    (cluster_by_curve if by_curve else cluster_globally)(df, columns, files).write.parquet(draft)
    replace_folder(df.sparkSession, draft, path)


def key_ranges(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per file of a DataFrame that was read from files: ``file``, and whether its range
    of ``columns`` lies ``apart`` from those of all files before it."""
    key = F.struct(*columns)
    bounds = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    before = F.max("high").over(Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    return bounds.select("file", F.coalesce(before < F.col("low"), F.lit(True)).alias("apart"))
