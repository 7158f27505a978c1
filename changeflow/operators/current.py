"""A current-state table: one row per key, fed by changes in any order.

Plain parquet has no row-level upsert, and a folder must not be overwritten by a job that
reads it. So a batch of changes is reduced to its latest row per key and appended, and the
table *is* the latest row per key of all that was appended. Taking the latest is commutative
and idempotent: late, shuffled and replayed batches give the same table, so the at-least-once
delivery of ``foreachBatch`` is enough, and a second writer does no harm.

A run costs what its batch costs. Reading ranks the rows appended since the last
:meth:`CurrentTable.compact`, which writes the current rows anew and says which folders nobody
needs any more. As long as both are there, rows are read twice, which changes nothing.

With ``buckets``, compaction writes the current rows as a base that is dealt to so many buckets by key
and sorted there. Reading then ranks only what was appended since and joins it to the base bucket by
bucket: the base is neither shuffled nor ranked again, however large it is.

With ``delete_when`` a change may delete its key. The delete is stored as a row like any other, a
tombstone: it ranks by its sequence, is hidden from readers, and stays through compactions, so that
an older change that comes late finds it and does not bring the key back. A newer change does.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators.latest import (
    DELETED,
    latest_by_key,
    latest_by_key_sql,
    mark_deletes,
    ranking_order,
    without_deleted,
)
from changeflow.operators.layout import cluster_by_curve, cluster_within
from changeflow.session import CODEC
from changeflow.sources.paths import NumberedFiles, delete, exists, make_dir, names
from changeflow.sources.schema import widen


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


class CurrentTable:
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
        buckets: int | None = None,
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
        self.buckets = buckets
        self._bases = NumberedFiles(spark, f"{self.path}/_bases")
        self._schemas = NumberedFiles(spark, f"{self.path}/_schemas")

    def create(self, schema: T.StructType) -> CurrentTable:
        """Make an empty table of these columns, or add those an existing one lacks."""
        number, stored = self._schemas.latest()
        known = T.StructType.fromJson(stored) if stored else T.StructType([])
        if self.delete_when is not None and DELETED not in schema.names:
            schema = T.StructType([*schema, T.StructField(DELETED, T.BooleanType())])
        wider = widen(known, schema)
        if wider != known:
            make_dir(self.spark, self.rows)
            self._schemas.put(number + 1, wider.jsonValue())
        return self

    def schema(self) -> T.StructType:
        stored = self._schemas.latest()[1]
        if stored is None:
            raise LookupError(f"no current-state table in {self.path}")
        return T.StructType.fromJson(stored)

    def appended(self) -> DataFrame:
        """All rows appended so far, tombstones with them; columns that came later are NULL in older rows."""
        return self.spark.read.schema(self.schema()).option("recursiveFileLookup", "true").parquet(self.rows)

    def _ranked(self, folders: Sequence[str]) -> DataFrame:
        """The latest row per key of some folders. One folder has a key at most once, as a batch and a
        compaction write it, so a single one is read as it is, without a shuffle."""
        rows = self.spark.read.schema(self.schema()).option("recursiveFileLookup", "true").parquet(*folders)
        return rows if len(folders) == 1 else latest_by_key(rows, self.keys, self.sequence_by, self.tie_break)

    def read(self) -> DataFrame:
        """The current rows."""
        return without_deleted(self._latest())

    def _latest(self) -> DataFrame:
        """One row per key, tombstones with them."""
        base = self._bases.latest()[1]
        if base is None or not exists(self.spark, f"{self.rows}/{base['folder']}"):
            folders = [f"{self.rows}/{name}" for name in names(self.spark, self.rows)]
            return self._ranked(folders) if folders else self.appended()
        known = {base["folder"], *base["supersedes"]}
        since = [f"{self.rows}/{name}" for name in names(self.spark, self.rows) if name not in known]
        new = self._ranked(since) if since else self.spark.createDataFrame([], self.schema())
        return self._merged(self._base(base), new)

    def _base(self, base: dict) -> DataFrame:
        """The base with its buckets, which only the catalog can tell Spark of; the entry goes at once."""
        name = f"base_{uuid.uuid4().hex}"
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in self.schema())
        keys = ", ".join(map(_quoted, self.keys))
        place = f"{self.rows}/{base['folder']}".replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys})"
            f" INTO {base['buckets']} BUCKETS LOCATION '{place}'"
        )
        try:
            table = self.spark.table(name)
            table.schema  # noqa: B018 - resolved here
        finally:
            self.spark.sql(f"DROP TABLE {name}")
        return table

    def _merged(self, base: DataFrame, new: DataFrame) -> DataFrame:
        """Of the rows of a key in both the later one; both have a key at most once.

        A NULL key equals itself here and not in a join by buckets, so those few are ranked.
        """
        keyed = reduce(lambda a, b: a & b, (F.col(_quoted(k)).isNotNull() for k in self.keys))
        order = ranking_order(base.schema, self.keys, self.sequence_by, self.tie_break)
        rank = F.struct(*[F.expr(term.removesuffix(" DESC NULLS LAST")).alias(f"o{i}") for i, term in enumerate(order)])
        fields = base.schema.names
        sides = []
        for label, rows in (("b", base), ("n", new)):
            own = [F.col(_quoted(c)).alias(f"{label}{i}") for i, c in enumerate(fields)]
            sides.append(rows.filter(keyed).select(*own, rank.alias(f"{label}_rank")))
        at = [fields.index(k) for k in self.keys]
        same = reduce(lambda a, b: a & b, (F.col(f"b{i}") == F.col(f"n{i}") for i in at))
        newer = F.col(f"n{at[0]}").isNotNull() & (F.col(f"b{at[0]}").isNull() | (F.col("n_rank") > F.col("b_rank")))
        joined = sides[0].join(sides[1], same, "full_outer")
        picked = [F.when(newer, F.col(f"n{i}")).otherwise(F.col(f"b{i}")).alias(c) for i, c in enumerate(fields)]
        without_key = base.filter(~keyed).unionByName(new.filter(~keyed))
        rest = latest_by_key(without_key, self.keys, self.sequence_by, self.tie_break)
        return joined.select(*picked).unionByName(rest)

    def select_sql(self, relation: str) -> str:
        """:meth:`read` as SQL over a relation of the appended rows."""
        return latest_by_key_sql(relation, self.schema(), self.keys, self.sequence_by, self.tie_break)

    def apply(self, changes: DataFrame) -> None:
        """Merge a batch of changes: one shuffle by key, and only rows of the batch are written."""
        changes = mark_deletes(changes, self.delete_when)
        self.create(changes.schema)
        winners = latest_by_key(changes, self.keys, self.sequence_by, self.tie_break)
        cluster_within(winners, self.cluster_by).write.option("compression", CODEC).parquet(self._new_folder())

    def _new_folder(self) -> str:
        return f"{self.rows}/{uuid.uuid4().hex}"

    def compact(self, forget_before: Any = None) -> list[str]:
        """Write the current rows anew, clustered; returns the folders that are now superseded.

        They may be removed, in any order, when no reader that began before is still at work.

        Tombstones stay for ever unless ``forget_before`` says that no change of a lesser sequence
        will come any more. One that is older goes if the table has no row left that it hides:
        with the rows it hides it stays once more, so it is never the first to be removed.
        """
        old = [f"{self.rows}/{name}" for name in names(self.spark, self.rows)]
        rows = self._latest()
        if forget_before is not None and DELETED in rows.columns:
            dead = F.coalesce(F.col(DELETED), F.lit(False))
            stale = F.coalesce(dead & (F.col(self.sequence_by) < F.lit(forget_before)), F.lit(False))
            hidden = self.appended().filter(~dead).select(*[F.col(k).alias(f"_hidden_{i}") for i, k in enumerate(self.keys)])
            rows = rows.filter(~stale).unionByName(rows.filter(stale).join(hidden, self._same_key("_hidden_"), "left_semi"))
        folder = self._new_folder()
        if self.buckets is None:
            cluster_by_curve(rows, self.cluster_by, like=self.appended()).write.option("compression", CODEC).parquet(folder)
            return old
        self._write_base(rows, folder)
        number, _ = self._bases.latest()
        base = {"folder": folder.rsplit("/", 1)[1], "buckets": self.buckets, "supersedes": [f.rsplit("/", 1)[1] for f in old]}
        self._bases.put(number + 1, base)
        return old

    def _write_base(self, rows: DataFrame, folder: str) -> None:
        name = f"base_{uuid.uuid4().hex}"
        writer = rows.repartition(self.buckets, *self.keys).write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
        try:
            writer.format("parquet").option("compression", CODEC).option("path", folder).saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")

    def _same_key(self, prefix: str) -> Column:
        equal = [F.col(k).eqNullSafe(F.col(f"{prefix}{i}")) for i, k in enumerate(self.keys)]
        return reduce(lambda a, b: a & b, equal)

    def remove(self, folders: Iterable[str]) -> None:
        for folder in folders:
            delete(self.spark, folder)
