"""A history table: for each key one row per change, with the interval in which it held.

A change holds from its sequence value to that of the next change of its key. Changes arrive in
any order, so a late one splits an interval that an earlier batch wrote. A batch reads the intervals
of its own keys, works out which of them end earlier now, and appends those and its own changes;
no other row is written, and none is ever overwritten.

The table is, for each key and sequence value, the appended row that ends first. An end only ever
moves to an earlier value, because changes are added and never taken away; so rows of an interval
that was split lose against the newer ones by themselves, and replayed batches change nothing. A
delete is a change too: it ends the interval before it and is not an interval of its own. One
writer at a time, as a stream is: two that do not see each other's changes may leave an overlap.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators.latest import DELETED, mark_deletes, ranking_order, without_deleted
from changeflow.operators.layout import cluster_by_curve, cluster_within
from changeflow.session import CODEC
from changeflow.sources.paths import NumberedFiles, delete, make_dir, names
from changeflow.sources.schema import widen

VALID_FROM = "valid_from"
VALID_TO = "valid_to"
IS_CURRENT = "is_current"
_NEW = "_is_new"

# The changes of a key are put in order in so many parts at most.
SLICES = 32
# Rows that hot keys are found from, and of how many of them a key has to be one.
SAMPLE = 20_000
HOT = 200
# A batch of so many changes at most sends its keys to all tasks, which then leave other keys aside
# before anything is shuffled.
FEW = 100_000
_DIVISIBLE = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(_quoted(x)).eqNullSafe(F.col(_quoted(y))) for x, y in zip(left, right, strict=True)))


def sequence_cuts(rows: DataFrame, sequence_by: str, slices: int = SLICES) -> list:
    """Values that cut a sequence into parts of about equal numbers of rows; none for texts."""
    if slices < 2 or not isinstance(rows.schema[sequence_by].dataType, _DIVISIBLE):
        return []
    shares = [i / slices for i in range(1, slices)]
    return sorted(set(rows.agg(F.percentile_approx(F.col(_quoted(sequence_by)), shares, 1000)).first()[0] or ()))


def hot_keys(rows: DataFrame, keys: Sequence[str]) -> list[tuple]:
    """Keys with about a hundredth of all rows or more, by at most ``SAMPLE`` rows of the least hash.
    They only decide whose changes are put in order in slices."""
    number = F.xxhash64(F.monotonically_increasing_id())
    sample = rows.select(*[F.col(_quoted(k)).alias(f"_{i}") for i, k in enumerate(keys)], number.alias("_hash"))
    counted = sample.orderBy("_hash").limit(SAMPLE).groupBy(*[f"_{i}" for i in range(len(keys))]).count()
    return [tuple(row)[:-1] for row in counted.filter(F.col("count") >= HOT).collect()]


def _is_one_of(schema: T.StructType, keys: Sequence[str], found: Sequence[tuple]) -> Column:
    def same(values: tuple) -> Column:
        parts = [F.col(_quoted(k)).eqNullSafe(F.lit(v).cast(schema[k].dataType)) for k, v in zip(keys, values, strict=True)]
        return reduce(lambda a, b: a & b, parts)

    return reduce(lambda a, b: a | b, map(same, found), F.lit(False))


def with_next(
    rows: DataFrame,
    keys: Sequence[str],
    sequence_by: str,
    into: str,
    cuts: Sequence = (),
    sliced: Column | None = None,
    one_each: Callable[[DataFrame, Sequence[str]], DataFrame] | None = None,
) -> DataFrame:
    """Add the next greater sequence value of the same key; NULL for the last.

    ``rows`` has a key and a sequence value at most once, or ``one_each`` picks the row, by the columns
    it is given; a NULL sequence comes before all others. Rows are shuffled once, by key and slice: a key
    is put in order slice by slice between the cuts, so one that holds a third of all rows is spread over
    many tasks. ``sliced`` says of which keys that is to be, all if it is not given; the others are put in
    order whole. Each slice gets a row with the first value of the next slice of its key, which goes
    again, as do rows that are marked ``_ahead`` already: values that others come before. Any cuts and any choice of keys give the same result.
    """
    value = F.col(_quoted(sequence_by))
    kind = rows.schema[sequence_by].dataType
    over = [F.coalesce((value > F.lit(cut).cast(kind)).cast("int"), F.lit(0)) for cut in cuts]
    part = F.when(value.isNull(), F.lit(-1)).otherwise(reduce(lambda a, b: a + b, over, F.lit(0)))
    if sliced is not None:
        part = F.when(sliced, part).otherwise(F.lit(0))
    cut = rows if "_ahead" in rows.columns else rows.withColumn("_ahead", F.lit(False))
    own = [*map(_quoted, keys)]
    if cuts:  # else keys are whole, and a slice that is the same for all rows would cost a second shuffle
        own, cut = [*own, "_slice"], cut.withColumn("_slice", part)
        few = (rows if sliced is None else rows.filter(sliced)).select(*own[:-1], part.alias("_slice"), value.alias("_value"))
        firsts = few.groupBy(*own).agg(F.min("_value").alias("_value"))
        after = F.lead("_value").over(Window.partitionBy(*own[:-1]).orderBy("_slice"))
        ahead = firsts.withColumn("_value", after).filter("_value IS NOT NULL")
        ahead = ahead.select(*own, F.col("_value").alias(sequence_by), F.lit(True).alias("_ahead"))
        cut = cut.unionByName(ahead, allowMissingColumns=True)
    cut = cut.repartition(*own)
    if one_each is not None:
        cut = one_each(cut, [*own, _quoted(sequence_by)])
    following = F.lead(value).over(Window.partitionBy(*own).orderBy(value.asc_nulls_first()))
    return cut.withColumn(into, following).filter("NOT _ahead").drop("_slice", "_ahead")


class HistoryTable:
    """Rows lie below ``path/rows``, a folder for each batch and each compaction."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys: Sequence[str],
        sequence_by: str,
        tie_break: Sequence[str] | None = None,
        cluster_by: Sequence[str] = (),
        comment: str = "",
        delete_when: str | None = None,
    ):
        self.spark = spark
        self.path = path.rstrip("/")
        self.rows = f"{self.path}/rows"
        self.keys = tuple(keys)
        self.sequence_by = sequence_by
        self.tie_break = tie_break
        self.cluster_by = tuple(cluster_by)
        self.comment = comment
        self.delete_when = delete_when
        self._schemas = NumberedFiles(spark, f"{self.path}/_schemas")

    def create(self, schema: T.StructType) -> HistoryTable:
        """Make an empty table of these columns, or add those an existing one lacks."""
        clash = sorted({VALID_FROM, VALID_TO, IS_CURRENT, DELETED, _NEW, "_ahead"} & set(schema.names))
        if clash:
            raise ValueError(f"changes have columns of their own named {', '.join(clash)}")
        number, stored = self._schemas.latest()
        known = T.StructType.fromJson(stored) if stored else T.StructType([])
        ends = T.StructField(VALID_TO, schema[self.sequence_by].dataType)
        wider = widen(known, T.StructType([*schema, T.StructField(DELETED, T.BooleanType()), ends]))
        if wider != known:
            make_dir(self.spark, self.rows)
            self._schemas.put(number + 1, wider.jsonValue())
        return self

    def schema(self) -> T.StructType:
        """Of the rows as they are stored."""
        stored = self._schemas.latest()[1]
        if stored is None:
            raise LookupError(f"no history table in {self.path}")
        return T.StructType.fromJson(stored)

    def appended(self) -> DataFrame:
        """All rows appended so far, also those of intervals that were split since."""
        return self.spark.read.schema(self.schema()).option("recursiveFileLookup", "true").parquet(self.rows)

    def _order(self, schema: T.StructType) -> list[str]:
        """Of rows of one key and sequence value, the first is the one that holds."""
        payload = T.StructType([f for f in schema if f.name not in (VALID_TO, _NEW, "_slice", "_ahead")])
        return ranking_order(payload, self.keys, self.sequence_by, self.tie_break)[1:]

    def _one_each(self, rows: DataFrame, by: Sequence[str], *last: Column) -> DataFrame:
        order = [F.expr(term.removesuffix(" DESC NULLS LAST")).desc_nulls_last() for term in self._order(rows.schema)]
        ranking = Window.partitionBy(*by).orderBy(*order, *last)
        return rows.withColumn("_rank", F.row_number().over(ranking)).filter("_rank = 1").drop("_rank")

    def events(self) -> DataFrame:
        """One row per key and sequence value with where it ends, deletes among them. A single folder
        has no more, as a batch and a compaction write it, so it is read as it is, without a shuffle."""
        folders = names(self.spark, self.rows)
        if len(folders) == 1:
            return self.spark.read.schema(self.schema()).option("recursiveFileLookup", "true").parquet(f"{self.rows}/{folders[0]}")
        by = [*map(_quoted, self.keys), _quoted(self.sequence_by)]
        return self._one_each(self.appended(), by, F.col(VALID_TO).asc_nulls_last())

    def read(self) -> DataFrame:
        """The intervals: the columns of the changes, from when, to when (NULL while it holds), and
        whether it holds now. Ranked by key and sequence, so a hot key is spread over tasks."""
        return self._shown(without_deleted(self.events()))

    def _shown(self, rows: DataFrame) -> DataFrame:
        ends = F.col(VALID_TO)
        shown = rows.withColumns({VALID_FROM: F.col(_quoted(self.sequence_by)), IS_CURRENT: ends.isNull()})
        return shown.select(*[_quoted(c) for c in shown.columns if c not in (VALID_FROM, VALID_TO, IS_CURRENT)], VALID_FROM, VALID_TO, IS_CURRENT)

    def as_of(self, moment) -> DataFrame:
        """The rows that held at a sequence value: begun then or before, not ended by then."""
        moment = F.lit(moment)
        begun = F.col(VALID_FROM).isNull() | (F.col(VALID_FROM) <= moment)
        return self.read().filter(begun & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > moment)))

    def select_sql(self, relation: str) -> str:
        """:meth:`read` as SQL over a relation of the appended rows."""
        schema, sequence = self.schema(), _quoted(self.sequence_by)
        columns = ", ".join(_quoted(n) for n in schema.names if n not in (DELETED, VALID_TO))
        by = ", ".join([*map(_quoted, self.keys), sequence])
        order = ", ".join([*self._order(schema), f"{VALID_TO} ASC NULLS LAST"])
        return (
            f"SELECT {columns}, {sequence} AS {VALID_FROM}, {VALID_TO}, {VALID_TO} IS NULL AS {IS_CURRENT} FROM (SELECT *,"
            f" row_number() OVER (PARTITION BY {by} ORDER BY {order}) AS `_rank` FROM {relation})"
            f" WHERE `_rank` = 1 AND NOT coalesce({DELETED}, false)"
        )

    def apply(self, changes: DataFrame) -> None:
        """Add a batch of changes: its rows, and those of the intervals it splits or ends, are
        written. Of several changes of a key and sequence value the greatest by tie-break holds.

        Rows are shuffled once. A small batch first leaves the keys aside that it does not have; with a
        large one they are put in order too, come out as they are stored, and are not written. Of rows
        that begin after the whole batch only key and sequence are shuffled: they end what comes before."""
        self.create(changes.schema)
        marked = mark_deletes(changes, self.delete_when)
        if DELETED not in marked.columns:
            marked = marked.withColumn(DELETED, F.lit(False))
        new = marked.withColumns({VALID_TO: F.lit(None).cast(self.schema()[VALID_TO].dataType), _NEW: F.lit(True)})
        known = self.appended()
        places = [_quoted(c) for c in (*self.keys, self.sequence_by)]
        seen = known.select(*places).unionAll(changes.select(*places))
        hot = hot_keys(seen, self.keys)
        cuts = sequence_cuts(seen, self.sequence_by) if hot else []
        if changes.select(*places).limit(FEW + 1).count() <= FEW:
            own = [f"_touched_{i}" for i in range(len(self.keys))]
            touched = changes.select(*[F.col(_quoted(k)).alias(o) for k, o in zip(self.keys, own, strict=True)]).distinct()
            known = known.join(F.broadcast(touched), _same(self.keys, own), "left_semi")
        # Of what begins after all changes of the batch only keys and sequence decide: no payload is shuffled.
        known = known.crossJoin(F.broadcast(changes.agg(F.max(_quoted(self.sequence_by)).alias("_high"))))
        value = F.col(_quoted(self.sequence_by))
        known = known.withColumn("_ahead", value.isNotNull() & F.coalesce(value > F.col("_high"), F.lit(True))).drop("_high")
        payload = [c for c in known.columns if c not in (*self.keys, self.sequence_by, "_ahead")]
        known = known.withColumns({c: F.when(~F.col("_ahead"), F.col(_quoted(c))) for c in payload})
        new = new.withColumn("_ahead", F.lit(False))
        # A change that is there already is not new: the row that is stored goes before an equal one.
        rows = known.withColumn(_NEW, F.lit(False)).unionByName(new, allowMissingColumns=True)
        sliced = _is_one_of(rows.schema, self.keys, hot)
        rows = with_next(
            rows, self.keys, self.sequence_by, "_next", cuts, sliced,
            lambda each, by: self._one_each(each, by, F.col(_NEW).asc(), F.col(VALID_TO).asc_nulls_last()),
        )
        moved = rows.filter(F.col(_NEW) | ~F.col("_next").eqNullSafe(F.col(VALID_TO)))
        moved = moved.withColumn(VALID_TO, F.col("_next")).drop("_next", _NEW)
        cluster_within(moved, self.cluster_by).write.option("compression", CODEC).parquet(self._new_folder())

    def _new_folder(self) -> str:
        return f"{self.rows}/{uuid.uuid4().hex}"

    def compact(self) -> list[str]:
        """Write the intervals anew, clustered; returns the folders that are now superseded, which
        may be removed when no reader that began before is still at work."""
        old = [f"{self.rows}/{name}" for name in names(self.spark, self.rows)]
        cluster_by_curve(self.events(), self.cluster_by, like=self.appended()).write.option("compression", CODEC).parquet(self._new_folder())
        return old

    def remove(self, folders: Iterable[str]) -> None:
        for folder in folders:
            delete(self.spark, folder)
