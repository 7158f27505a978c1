"""The latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Where a row came from says nothing about which of two changes is the later one.
LINEAGE = ("_ingested_at", "_source_file")

# Marks a stored change that deletes its key.
DELETED = "_is_deleted"


def orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.StructType):
        return all(orderable(field.dataType) for field in data_type)
    if isinstance(data_type, T.ArrayType):
        return orderable(data_type.elementType)
    return not isinstance(data_type, (T.MapType, T.VariantType))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _comparable(field: T.StructField) -> str:
    """SQL for something that orders the column's values; a map counts as its sorted entries."""
    name, kind = _quoted(field.name), field.dataType
    if orderable(kind):
        return name
    if isinstance(kind, T.MapType) and orderable(kind.keyType) and orderable(kind.valueType):
        return f"sort_array(map_entries({name}))"
    raise ValueError(f"column {field.name} of type {kind.simpleString()} has no order: give a tie-break")


def ranking_order(
    schema: T.StructType, keys: Sequence[str], sequence_by: str, tie_break: Sequence[str] | None
) -> list[str]:
    """What orders the rows of a key, as SQL, the first to be kept.

    Without a tie-break, rows of equal sequence are ordered by all other columns in the order
    of their *names*, lineage last. Where in the schema a column stands, and whether a batch
    has it already, then makes no difference: a column nobody has yet is NULL in every row.

    Where rows are marked as deletes, a delete comes before other rows of equal sequence (and
    equal tie-break, if there is one).
    """
    marked = [f"coalesce({_quoted(DELETED)}, false)"] if DELETED in schema.names else []
    if tie_break is None:
        taken = {*keys, sequence_by, DELETED}
        fields = sorted((f for f in schema if f.name not in taken), key=lambda f: (f.name in LINEAGE, f.name))
        order = [*marked, *map(_comparable, fields)]
    else:
        order = [*[_comparable(schema[name]) for name in tie_break if name in schema.names], *marked]
    return [f"{value} DESC NULLS LAST" for value in (_quoted(sequence_by), *order)]


def mark_deletes(changes: DataFrame, delete_when: str | None) -> DataFrame:
    """Add whether a change deletes its key: where the predicate is true, not where it is NULL."""
    if delete_when is None:
        return changes
    if DELETED in changes.columns:
        raise ValueError(f"changes have a column {DELETED} of their own")
    return changes.withColumn(DELETED, F.coalesce(F.expr(delete_when), F.lit(False)))


def without_deleted(rows: DataFrame) -> DataFrame:
    """Rows that stand, without the mark. To be called on the latest rows, not before ranking."""
    if DELETED not in rows.columns:
        return rows
    return rows.filter(~F.coalesce(F.col(DELETED), F.lit(False))).drop(DELETED)


def latest_by_key(
    df: DataFrame, keys: Sequence[str], sequence_by: str, tie_break: Sequence[str] | None = None
) -> DataFrame:
    """Keep, for each key, the whole row with the greatest sequence value.

    A NULL sequence loses to any value, but a key that has nothing else keeps its row. Rows
    with equal sequence are ordered by ``tie_break``; without one, by every other column by
    name, so that the result depends neither on the order in which rows arrive nor on the
    order of columns. A column without any order, other than a map of ordered values, is then
    an error.

    Ranking with a limit of one lets Spark reduce each key to one row before the shuffle
    (``WindowGroupLimit``), so a key with a third of all rows does not load one task, and
    columns that neither decide nor are asked for are pruned through it, which an aggregate
    over whole rows prevents.
    """
    order = [_order_column(term) for term in ranking_order(df.schema, keys, sequence_by, tie_break)]
    ranking = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranking)).filter("_rank = 1").drop("_rank")


def _order_column(term: str):
    return F.expr(term.removesuffix(" DESC NULLS LAST")).desc_nulls_last()


def latest_by_key_sql(
    relation: str, schema: T.StructType, keys: Sequence[str], sequence_by: str, tie_break: Sequence[str] | None = None
) -> str:
    """The same as SQL, for a view, without the rows that are marked as deleted."""
    columns = ", ".join(_quoted(name) for name in schema.names if name != DELETED)
    by = ", ".join(map(_quoted, keys))
    order = ", ".join(ranking_order(schema, keys, sequence_by, tie_break))
    stands = f" AND NOT coalesce({_quoted(DELETED)}, false)" if DELETED in schema.names else ""
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {order})"
        f" AS `_rank` FROM {relation}) WHERE `_rank` = 1{stands}"
    )
