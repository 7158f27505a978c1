"""The whole chain: change files, raw and checked changes, current state, reports."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.operators import CurrentTable, HistoryTable, apply_rules, cluster_globally, latest_by_key, quality_history
from changeflow.operators.latest import mark_deletes, without_deleted
from changeflow.operators.quality import FAILED_RULES
from changeflow.plans.specs import ReportSpec, TableSpec
from changeflow.sources import publish_table, publish_view, read_files, refresh, starting_schema, stored_schema
from changeflow.sources.files import INGESTED_AT, SOURCE_FILE
from changeflow.sources.paths import NumberedFiles, delete, exists, make_dir, write_json
from changeflow.sources.tables import quoted
from changeflow.streaming import MOST_FILES, Refused, counts_file, intake, write_checked


def checked(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Changes of one entity, cleaned and with the failing rows dropped; batch or stream."""
    return apply_rules(spec.clean(changes), spec.rules)


def current(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """The current state in one go, for changes that are all at hand.

    Filtering comes first: a row that is deleted, inactive or broken does not replace an
    older good one. With ``delete_when`` a delete does, and its key is gone.
    """
    rows = mark_deletes(with_deletes(checked(changes, spec), changes, spec), spec.delete_when)
    return without_deleted(latest_by_key(rows, spec.keys, spec.sequence_by, spec.tie_break))


def with_deletes(passed: DataFrame, changes: DataFrame, spec: TableSpec) -> DataFrame:
    """The checked rows and, if the entity applies deletes, those among the raw changes.

    A delete needs its key and nothing else: often it has no more, so the rules are not for it.
    Derived columns are NULL in it.
    """
    if spec.delete_when is None:
        return passed
    keyed = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in spec.keys))
    gone = changes.filter(F.expr(spec.delete_when) & keyed)
    shared = [name for name in passed.columns if name in changes.columns]
    return passed.unionByName(gone.select(*shared), allowMissingColumns=True)


@dataclass
class Layers:
    """The folders of one flow. ``source`` has one folder of change files per entity.

    Each entity is one stream over its change files, which ``max_files_per_trigger`` may cut
    into micro-batches. A batch goes through all layers before the next one, so raw and checked
    rows are never listed or read again as sources of their own. A run appends to the current
    state what its batches change; :meth:`compact` is to be called now and then.
    """

    spark: SparkSession
    source: str
    root: str
    tables: Sequence[TableSpec]
    reports: Sequence[ReportSpec] = ()
    max_files_per_trigger: int = MOST_FILES
    parallel: int = 4
    skip_refused: bool = False  # go on past a batch that fails a blocking rule, instead of stopping
    database: str = ""  # where datasets are published; the session's if empty

    def path(self, dataset: str) -> str:
        return f"{self.root}/{dataset}"

    def _checkpoint(self, dataset: str) -> str:
        return f"{self.root}/_checkpoints/{dataset}"

    def _counts(self, spec: TableSpec) -> str:
        return f"{self.root}/_quality/{spec.silver}"

    def current_table(self, spec: TableSpec) -> CurrentTable:
        return CurrentTable(
            self.spark,
            self.path(spec.current),
            spec.keys,
            spec.sequence_by,
            spec.tie_break,
            cluster_by=spec.layout,
            comment=spec.comments.get("gold", ""),
            delete_when=spec.delete_when,
            buckets=spec.buckets,
        )

    def history_table(self, spec: TableSpec) -> HistoryTable:
        return HistoryTable(
            self.spark,
            self.path(spec.history),
            spec.keys,
            spec.sequence_by,
            spec.tie_break,
            cluster_by=spec.layout,
            comment=spec.comments.get("history", ""),
            delete_when=spec.delete_when,
        )

    def _refused(self, spec: TableSpec) -> str:
        return f"{self.root}/_refused/{spec.silver}"

    def run(self) -> Layers:
        """Take in everything new and bring all datasets up to date.

        The entities do not depend on each other and run side by side, ``parallel`` at a
        time. The reports are built when all of them are done, so they agree with each other.
        A batch that fails a blocking rule goes no further than the raw layer: the run ends with
        ``BatchRefused`` before the reports, and the next run meets the batch again.
        """
        with ThreadPoolExecutor(self.parallel) as pool:
            state = dict(zip((s.name for s in self.tables), pool.map(self._advance, self.tables)))
        if self.reports:
            self._refresh_reports(state)
        rows = [name(s) for s in self.tables for name in (self._rows_name, self._history_rows_name)]
        for name in (*self.datasets(), *rows):
            refresh(self.spark, self._published(name))
        return self

    def _refresh_reports(self, state: dict[str, DataFrame]) -> None:
        """Build all reports beside the old ones, then switch to them together.

        Each run has a folder of its own, and one small file that is written last says which is
        valid: whoever reads sees all reports of one run, and a run that fails leaves the old ones.
        The folder before the valid one stays for readers that began earlier, older ones go.
        """
        folder = f"{self.root}/_reports/{uuid.uuid4().hex}"
        versions = self._versions()
        number, _ = versions.latest()  # before reading: of two runs at once the slower one fails
        shared = {}
        for name, table in state.items():
            asked = [report.uses[name] for report in self.reports if name in report.uses]
            if len(asked) > 1:  # ranked once for all of them
                shared[name] = table.select(*sorted(set().union(*asked))).persist()
        try:
            for report in self.reports:
                own = {**state, **{name: shared[name] for name in report.uses if name in shared}}
                cluster_globally(report.build(own), report.layout).write.parquet(f"{folder}/{report.name}")
            versions.put(number + 1, {"folder": folder})
        except BaseException:
            delete(self.spark, folder)
            raise
        finally:
            for table in shared.values():
                table.unpersist()
        for report in self.reports:
            if self.spark.catalog.tableExists(quoted(self._published(report.name))):
                self._publish_report(report)
        for old in versions.numbers()[:-2]:
            delete(self.spark, versions.get(old)["folder"])
            versions.drop(old)

    def _versions(self) -> NumberedFiles:
        return NumberedFiles(self.spark, f"{self.root}/_reports_versions")

    def read_reports(self) -> dict[str, DataFrame]:
        """All reports of the last run that completed them, by name."""
        valid = self._versions().latest()[1]
        if valid is None:
            raise LookupError("no run has built reports yet")
        return {report.name: read_files(self.spark, f"{valid['folder']}/{report.name}") for report in self.reports}

    def _publish_report(self, report: ReportSpec) -> None:
        folder = self._versions().latest()[1]["folder"]
        publish_table(
            self.spark, self._published(report.name), self.read(report.name), f"{folder}/{report.name}",
            report.comment, within=f"{self.root}/_reports",
        )

    def _published(self, dataset: str) -> str:
        return f"{self.database}.{dataset}" if self.database else dataset

    def compact(self) -> dict[str, list[str]]:
        """Write the current tables anew; per table the folders that may go when readers are done."""
        found = {spec.current: self.current_table(spec).compact() for spec in self.tables}
        return found | {spec.history: self.history_table(spec).compact() for spec in self.tables if spec.keep_history}

    @staticmethod
    def _rows_name(spec: TableSpec) -> str:
        return f"{spec.current}_rows"

    @staticmethod
    def _history_rows_name(spec: TableSpec) -> str:
        return f"{spec.history}_rows"

    def _advance(self, spec: TableSpec) -> DataFrame:
        """Bring one entity from its new files to its current state, batch by batch.

        The counts of a batch are written last and mark it as done: one that is delivered
        again before that replaces its rows, and merging them again changes nothing.
        """
        table, source = self.current_table(spec), f"{self.source}/{spec.name}"
        starting_schema(self.spark, source, self._schemas(spec))
        make_dir(self.spark, self.path(spec.silver))
        make_dir(self.spark, self._counts(spec))
        table.create(self._schema(spec, spec.silver))
        if spec.keep_history:
            self.history_table(spec).create(self._schema(spec, spec.silver))

        def check_and_merge(raw: DataFrame, name: str) -> None:
            marker = counts_file(self._counts(spec), name)
            if exists(self.spark, marker):
                return
            folder, clean = f"{self.path(spec.silver)}/{name}", spec.clean(raw)
            try:
                counts = write_checked(clean, folder, spec.layout, spec.rules, f"{self._refused(spec)}/{name}")
            except Refused as error:
                if not self.skip_refused:
                    raise
                write_json(self.spark, marker, error.counts, replace=True)
                return
            passed = self.spark.read.schema(clean.schema).parquet(folder)
            changes = with_deletes(passed, raw, spec)
            table.apply(changes)
            if spec.keep_history:
                self.history_table(spec).apply(changes)
            write_json(self.spark, marker, counts, replace=True)

        intake(
            self.spark,
            source,
            self._schemas(spec),
            self.path(spec.bronze),
            self._checkpoint(spec.bronze),
            spec.raw_layout,
            check_and_merge,
            self.max_files_per_trigger,
        )
        return table.read()

    def _schemas(self, spec: TableSpec) -> str:
        return f"{self.root}/_schemas/{spec.bronze}"

    def _schema(self, spec: TableSpec, dataset: str) -> T.StructType:
        """Of the raw or the checked rows. Older files lack the columns that came later, so no
        single file has it."""
        raw = stored_schema(self.spark, self._schemas(spec))
        raw = raw.add(INGESTED_AT, T.TimestampType()).add(SOURCE_FILE, T.StringType())
        return raw if dataset == spec.bronze else spec.clean(self.spark.createDataFrame([], raw)).schema

    def read(self, dataset: str) -> DataFrame:
        """A dataset by name, as of the last run."""
        for spec in self.tables:
            if dataset == spec.current:
                return self.current_table(spec).read()
            if dataset == spec.history and spec.keep_history:
                return self.history_table(spec).read()
            if dataset in (spec.bronze, spec.silver):
                return read_files(self.spark, self.path(dataset), self._schema(spec, dataset))
        return self.read_reports()[dataset]

    def quality(self, spec: TableSpec, by_batch: bool = False) -> DataFrame:
        """How often each rule failed, over all runs or batch by batch."""
        return quality_history(self.spark, self._counts(spec), spec.rules, spec.silver, by_batch)

    def refused(self, spec: TableSpec) -> DataFrame:
        """The rows for which batches were refused that have not passed since, with the names of the
        rules they fail and their batch."""
        make_dir(self.spark, self._refused(spec))
        schema = T.StructType([*self._schema(spec, spec.silver), T.StructField(FAILED_RULES, T.ArrayType(T.StringType()))])
        rows = read_files(self.spark, self._refused(spec), schema)
        return rows.withColumn("batch", F.concat_ws("/", F.slice(F.split("_metadata.file_path", "/"), -3, 2)))

    def datasets(self) -> list[str]:
        names = [
            name for s in self.tables for name in (s.bronze, s.silver, s.current, *([s.history] if s.keep_history else []))
        ]
        return names + [report.name for report in self.reports]

    def publish(self) -> None:
        """Register everything under its name, with comments, in ``database`` if there is one.

        The current state is a view over a table of the rows appended, so it has the newest
        state whenever it is read, in any session of the catalog. Call again when a column is new.
        Runs point published reports to their new folders, each in one step; a catalog cannot
        switch several at once, as :meth:`read_reports` does.
        """
        for spec in self.tables:
            for layer, name in (("bronze", spec.bronze), ("silver", spec.silver)):
                publish_table(
                    self.spark, self._published(name), self.read(name), self.path(name), spec.comments.get(layer, "")
                )
            self._publish_state(spec.current, self._rows_name(spec), self.current_table(spec))
            if spec.keep_history:
                self._publish_state(spec.history, self._history_rows_name(spec), self.history_table(spec))
        for report in self.reports:
            self._publish_report(report)

    def _publish_state(self, name: str, rows: str, table: CurrentTable | HistoryTable) -> None:
        rows = self._published(rows)
        publish_table(self.spark, rows, table.appended(), table.rows, f"Changes that are ranked by {name}")
        publish_view(self.spark, self._published(name), table.select_sql(quoted(rows)), table.comment)
