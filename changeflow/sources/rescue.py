"""Values that do not fit the type their column has been tracked with.

The tracked type stays. A file that delivers a column as another type is read as it is, each value
is cast, and what the cast would change or lose is kept as JSON in a column of its own beside a NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.sources.files import read_named

RESCUED = "_rescued_data"
CANNOT_MERGE = "CANNOT_MERGE_SCHEMAS"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _merged_schema(spark: SparkSession, files: Sequence[str]) -> T.StructType | None:
    """The union of the files' schemas by their footers; nothing if they disagree on a type."""
    try:
        return read_named(spark, files).schema
    except Exception as error:  # the bridge to the JVM does not translate this one
        if CANNOT_MERGE not in str(error):
            raise
        return None


def schema_groups(spark: SparkSession, files: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """The files in groups that agree on the type of every column, with the union of their schemas.

    Footers are read by Spark jobs. Files that agree cost one; those that do not are halved until
    they do, in the order of their names, in which those of one delivery lie together.
    """
    found: list[tuple[T.StructType, list[str]]] = []
    left = [sorted(files)] if files else []
    while left:
        part = left.pop()
        schema = _merged_schema(spark, part)
        if schema is None:
            left += [part[len(part) // 2 :], part[: len(part) // 2]]
            continue
        for i, (known, own) in enumerate(found):
            types = {f.name: f.dataType for f in known}
            if all(types.get(f.name, f.dataType) == f.dataType for f in schema):
                more = [f for f in schema if f.name not in types]
                found[i] = (T.StructType([*known, *more]), own + part)
                break
        else:
            found.append((schema, part))
    return found


def _castable(spark: SparkSession, source: T.DataType, target: T.DataType) -> bool:
    try:
        spark.range(0).select(F.lit(None).cast(source).try_cast(target)).schema  # noqa: B018 - analysed here
    except AnalysisException:
        return False
    return True


def _as(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """The value in another type, or NULL if it would not be the same value. A text fits if it can
    be read as the type at all, anything else if casting it back gives it again."""
    cast = value.try_cast(target)
    if isinstance(source, T.StringType):
        return cast
    return F.when(cast.try_cast(source).eqNullSafe(value), cast)


def fit(df: DataFrame, known: T.StructType) -> DataFrame:
    """The columns of ``df`` in their tracked types, those it lacks as NULL, and ``_rescued_data``.

    ``_rescued_data`` is a JSON object of the values that did not fit, by column, NULL if all did. A
    column of that name in ``df`` is kept where all fit, and goes into the object where not.
    """
    spark, types = df.sparkSession, {f.name: f.dataType for f in df.schema}
    columns, misfits = [], []
    for field in known:
        value = F.col(_quoted(field.name))
        if field.name == RESCUED:
            continue
        if field.name not in types:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif types[field.name] == field.dataType:
            columns.append(value)
        else:
            source = types[field.name]
            cast = F.lit(None).cast(field.dataType)
            if _castable(spark, source, field.dataType):
                cast = _as(value, source, field.dataType)
            columns.append(cast.alias(field.name))
            misfits.append(F.when(cast.isNull(), value).alias(field.name))
    own = F.col(RESCUED).cast("string") if RESCUED in types else F.lit(None).cast("string")
    rescued = own
    if misfits:
        # NULLs are left out of the object, so one without any value that is lost is {}.
        lost = F.to_json(F.struct(*misfits)) != "{}"
        with_own = [own.alias(RESCUED)] if RESCUED in types else []
        rescued = F.when(lost, F.to_json(F.struct(*misfits, *with_own))).otherwise(own)
    return df.select(*columns, rescued.alias(RESCUED))
