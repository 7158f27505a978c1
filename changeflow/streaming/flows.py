"""Run-to-completion streams: take what has arrived since the last run, then stop.

Progress lives in the checkpoint folder, one per flow, so a run that was cut short goes on
where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from changeflow.operators.current import CurrentTable
from changeflow.operators.history import HistoryTable
from changeflow.operators.layout import cluster_within
from changeflow.operators.quality import (
    FAIL,
    BatchRefused,
    Rule,
    apply_rules,
    as_counts,
    blocking_failures,
    observe_rules,
    refused_rows,
)
from changeflow.session import CODEC, bound_splits
from changeflow.sources.files import INGESTED_AT, SOURCE_FILE, read_named, stream_names, with_lineage
from changeflow.sources.paths import delete, exists, make_dir, replace_folder, write_json
from changeflow.sources.rescue import RESCUED, fit, schema_groups
from changeflow.sources.schema import grow_schema, starting_schema, stored_schema


# How many files a micro-batch of intake has at most: the driver holds their names.
MOST_FILES = 10_000


def batch_name(batch: DataFrame, number: int) -> str:
    """Query and number of a micro-batch, the same when it is delivered again."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}/{number:09d}"


def counts_file(counts: str, name: str) -> str:
    """Where the rule counts of a batch lie."""
    return f"{counts}/{name.replace('/', '-')}.json"


def write_checked(
    batch: DataFrame, folder: str, cluster_by: Sequence[str], rules: Sequence[Rule], refused: str | None = None
) -> dict[str, int]:
    """Write the rows that pass, replacing leftovers, and count the rules in the same pass.

    With rules that block, the rows first go to a folder beside, which no reader lists, and the
    counts of that pass decide. If none failed, the folder takes its place. If any did, it goes,
    the rows that failed are written to the folder ``refused``, and ``BatchRefused`` is raised.
    """
    seen, rows = Observation(), batch
    if rules:
        rows = apply_rules(observe_rules(batch, rules, seen), rules)
    rows = cluster_within(rows, cluster_by)
    if not any(rule.action == FAIL for rule in rules):
        rows.write.mode("overwrite").option("compression", CODEC).parquet(folder)
        return as_counts(seen.get) if rules else {}
    spark = batch.sparkSession
    place, name = folder.rsplit("/", 1)
    draft = f"{place}/_draft-{name}"
    rows.write.mode("overwrite").option("compression", CODEC).parquet(draft)
    counts = as_counts(seen.get)
    failures = blocking_failures(counts, rules)
    if not failures:
        replace_folder(spark, draft, folder)
        if refused:
            delete(spark, refused)  # of an earlier try under other rules
        return counts
    delete(spark, draft)
    if refused:
        refused_rows(batch, rules).write.mode("overwrite").option("compression", CODEC).parquet(refused)
    raise Refused(folder, failures, counts)


class Refused(BatchRefused):
    """With the counts of all rules."""

    def __init__(self, batch: str, failures: dict[str, int], counts: dict[str, int]):
        super().__init__(batch, failures)
        self.counts = counts


def intake(
    spark: SparkSession,
    source: str,
    schemas: str,
    path: str,
    checkpoint: str,
    cluster_by: Sequence[str],
    then: Callable[[DataFrame, str], None],
    max_files_per_trigger: int = MOST_FILES,
) -> None:
    """Take in all new files of a folder, whose columns and types may differ from those before.

    The stream says which files are new, and opens none. Each micro-batch of them is written to a
    folder of its own below ``path``. Before, the footers of its files, and of no others, are held
    against the schema tracked in ``schemas``: new columns are added to it, and values of a column
    that arrives as another type are cast to the tracked one, or kept in ``_rescued_data`` where they
    do not fit. Files are read by name, those of one schema together.

    ``then`` gets the rows as written and the batch's name, and has to bear being called again with
    the same batch. If it refuses the batch, the run ends with its ``BatchRefused``; the next run
    delivers the batch again. The driver holds the names of the files of one batch: more than
    ``max_files_per_trigger`` are several batches.
    """
    make_dir(spark, path)
    starting_schema(spark, source, schemas)
    refused: list[BatchRefused] = []

    def store(batch: DataFrame, number: int) -> None:
        session, name = batch.sparkSession, batch_name(batch, number)
        bound_splits(session)  # the stream's own: what is read here is sorted by the task that reads it
        folder = f"{path}/{name}"
        files = [row[0] for row in batch.collect()]
        if not files:
            return
        rows = _as_tracked(session, files, schemas)
        cluster_within(rows, cluster_by).write.mode("overwrite").option("compression", CODEC).parquet(folder)
        written = session.read.schema(rows.schema).parquet(folder)
        try:
            then(written, name)
        except BatchRefused as error:
            refused.append(error)
            raise

    names = stream_names(spark, source, max_files_per_trigger)
    writer = names.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    try:
        finish([writer.foreachBatch(store).start()])
    except StreamingQueryException:
        if refused:
            raise refused[0] from None
        raise


def _as_tracked(spark: SparkSession, files: Sequence[str], schemas: str) -> DataFrame:
    """The rows of some files in the tracked schema, which grows by the columns only they have."""
    groups = schema_groups(spark, files)
    fields = [seen for seen, _ in groups]
    tracked = grow_schema(spark, schemas, fields)
    types = {f.name: f.dataType for f in tracked}
    if all(types[f.name] == f.dataType for seen in fields for f in seen):
        return with_lineage(read_named(spark, files, tracked))
    tracked = grow_schema(spark, schemas, [T.StructType([T.StructField(RESCUED, T.StringType())])])
    parts = []
    for seen, own in groups:
        rows = with_lineage(read_named(spark, own, seen))
        fitted = fit(rows, T.StructType([*tracked, *rows.schema.fields[-2:]]))
        parts.append(fitted.select(*[_quoted(n) for n in (*tracked.names, INGESTED_AT, SOURCE_FILE)]))
    return reduce(DataFrame.unionByName, parts)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def append_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    cluster_by: Sequence[str] = (),
    rules: Iterable[Rule] = (),
    counts: str | None = None,
    refused: str | None = None,
    skip_refused: bool = False,
) -> StreamingQuery:
    """Append the rows of a stream to a parquet folder, each exactly once.

    Without layout and rules this is Spark's own file sink. Sorting and counted rules are
    not allowed on a stream, so they happen per micro-batch. Each batch has a folder of its
    own, named by query and batch number; the rule counts go to a file of that name in
    ``counts``. A batch that is delivered again finds itself done, or replaces its leftovers.

    A batch with rows that fail a blocking rule is not let through; those rows go to a folder of
    its name below ``refused``. The query then fails, and delivers the batch again when it is
    started again, or with ``skip_refused`` counts it and goes on with the next one.
    """
    rules = tuple(rules)
    make_dir(df.sparkSession, path)  # so that a first run without input leaves a readable folder
    writer = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if not cluster_by and not rules:
        return writer.outputMode("append").format("parquet").start(path)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        name = batch_name(batch, number)
        folder = f"{path}/{name}"
        marker = counts_file(counts, name) if counts else f"{folder}/_SUCCESS"
        if exists(spark, marker):
            return
        try:
            found = write_checked(batch, folder, cluster_by, rules, f"{refused}/{name}" if refused else None)
        except Refused as error:
            if not skip_refused:
                raise
            found = error.counts
        if counts:
            make_dir(spark, counts)
            write_json(spark, marker, found, replace=True)

    return writer.foreachBatch(write).start()


def upsert_stream(df: DataFrame, table: CurrentTable | HistoryTable, checkpoint: str) -> StreamingQuery:
    """Merge the rows of a stream into a current-state or a history table.

    Late rows are welcome without limit: there is no watermark and no state but the table. A
    batch that is delivered again merges to the same table.
    """
    table.create(df.schema)

    def merge(batch: DataFrame, number: int) -> None:
        table.apply(batch)

    return (
        df.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(merge)
        .start()
    )


def finish(queries: Iterable[StreamingQuery]) -> None:
    """Wait for all; if one fails, stop the rest and raise its error."""
    queries = list(queries)
    try:
        for query in queries:
            query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
