"""The registered queries and, for each, the same result as plain SQL."""

from __future__ import annotations

import os
import sys
import warnings
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracles  # noqa: E402
from changeflow.operators import (  # noqa: E402
    CurrentTable,
    HistoryTable,
    daily_admissions,
    diagnoses_with_facility,
    diagnosis_distribution,
    expect_or_fail,
    facility_summary,
    file_skips,
    key_ranges,
    quality_history,
    quality_report,
    top_codes,
    write_clustered,
)
from changeflow.plans import Layers, check_specs, checked, current, load_specs, with_deletes  # noqa: E402
from changeflow.plans.clinical import REPORTS, TABLES, with_tie_breaks  # noqa: E402
from changeflow.session import CODEC, bounded_splits, scratch_dir  # noqa: E402
from changeflow.sources import (  # noqa: E402
    infer_schema,
    ingest_files,
    read_files,
    stored_schema,
    stream_files,
    tracked_schema,
)
from changeflow.sources.feeds import FEEDS, TIE_BREAKS, tables_in  # noqa: E402
from changeflow.sources.files import INGESTED_AT, SOURCE_FILE  # noqa: E402
from changeflow.sources.paths import delete  # noqa: E402
from changeflow.streaming import append_stream, finish, intake, upsert_stream  # noqa: E402

try:  # the training-data operators are a part of their own, which may be left out
    import corpus_pipeline
    from changeflow.llm.queries import ORACLES as LLM_ORACLES
    from changeflow.llm.queries import QUERIES as LLM_QUERIES

    LLM_QUERIES = {**LLM_QUERIES, "pipeline": corpus_pipeline.run}
except ImportError as missing:  # of themselves, or of a library only they use
    warnings.warn(f"no training-data queries: {missing}", stacklevel=1)
    LLM_QUERIES, LLM_ORACLES = {}, {}

ENTITIES = {spec.name: spec for spec in with_tie_breaks(TABLES, TIE_BREAKS)}

# How many micro-batches the queries that show incremental work use, at any size of data.
BATCHES = 4
# How many files the query that shows a clustered layout writes.
CLUSTERED_FILES = 4
CURVE_FILES = 16
# How many codes the report of the most frequent ones has for a facility.
TOP = 5
# Which raw changes delete their key, in the queries that apply deletes.
DELETES = "cdc_operation = 'D'"
# Buckets of the base that is compacted in between.
BUCKETS = 8
# The queries that show a rule that blocks take in the encounters in three deliveries, cut here. The
# rule fails where a stay ends more than four and a half years before it begins.
DELIVERY_CUTS = ("1997-01-01", "1999-06-01")
GATE = ("stay_not_reversed", "length_of_stay_hours IS NULL OR length_of_stay_hours >= -40000")


def _feed(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The changes of an entity. Stays and days are those of the session time zone, which
    ``build_session`` sets to UTC."""
    return FEEDS[entity](tables_in(spark, sf_dir))


def _midnight(report: DataFrame) -> DataFrame:
    """Days as time stamps: pandas has no day type, so two engines hand over days differently."""
    return report.withColumn("admit_date_day", F.col("admit_date_day").cast("timestamp_ntz"))


# -- batch ----------------------------------------------------------------------------


def _silver(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return checked(_feed(spark, sf_dir, entity), ENTITIES[entity])


def _quality(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ENTITIES[entity]
    return quality_report(spec.clean(_feed(spark, sf_dir, entity)), spec.rules, spec.silver)


def _current(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    return current(_feed(spark, sf_dir, entity), ENTITIES[entity])


def _facility_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facility_summary(_current("encounters", spark, sf_dir))


def _diagnoses_with_facility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnoses_with_facility(
        _current("diagnoses", spark, sf_dir), _current("encounters", spark, sf_dir)
    )


def _diagnosis_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return diagnosis_distribution(
        _current("diagnoses", spark, sf_dir), _current("encounters", spark, sf_dir)
    )


def _top_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_codes(_current("diagnoses", spark, sf_dir), _current("encounters", spark, sf_dir), TOP)


def _daily_admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _midnight(daily_admissions(_current("encounters", spark, sf_dir)))


def _clustered_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report read back from several files; ``file_apart`` tells whether the range of keys of a
    row's file is apart from those of the files before it, so that a filter on them skips files."""
    path, key = scratch_dir(spark, "clustered"), ("facility_code", "admit_date_day")
    write_clustered(daily_admissions(_current("encounters", spark, sf_dir)), path, key, CLUSTERED_FILES)
    rows = read_files(spark, path)
    ranges = key_ranges(rows, key)
    files = rows.select("*", F.col("_metadata.file_name").alias("file"))
    counted = ranges.withColumn("files", F.count("*").over(Window.partitionBy()))
    found = files.join(counted, "file").withColumn("file_apart", F.col("apart") & (F.col("files") > 1))
    return _midnight(found.drop("file", "apart", "files"))


def _clustered_both_ways(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report laid out along a curve over facility and day; whether a filter on a row's facility
    alone, and on its day alone, skips at least a quarter of the files."""
    path, key = scratch_dir(spark, "curve"), ("facility_code", "admit_date_day")
    report = daily_admissions(_current("encounters", spark, sf_dir))
    write_clustered(report.filter("admit_date_day IS NOT NULL"), path, key, CURVE_FILES, by_curve=True)
    found = file_skips(read_files(spark, path), key)
    for name in key:
        found = found.withColumn(f"skipped_by_{name}", F.col(f"skipped_by_{name}") >= 0.25)
    return _midnight(found)


def _silver_procedures_rescued(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes whose source also delivers the column of values that did not fit."""
    feed = _feed(spark, sf_dir, "procedures")
    rescued = F.when(F.col("s3") % 2 == 0, F.to_json(F.struct("procedure_date")))
    return checked(feed.withColumn("_rescued_data", rescued), ENTITIES["procedures"])


# -- streams --------------------------------------------------------------------------


def _land(feed: DataFrame, folder: str, by: str | None = None) -> None:
    """Write a feed as the change files of a source, in one folder or one per ship year."""
    if by is None:
        feed.write.option("compression", CODEC).parquet(folder)
    else:
        feed.withColumn("year", F.year(by)).write.option("compression", CODEC).partitionBy("year").parquet(folder)


def _files_per_batch(spark: SparkSession, folder: str) -> int:
    """For at least ``BATCHES`` batches, where there are as many files."""
    files = spark.read.option("recursiveFileLookup", "true").parquet(folder).inputFiles()
    return max(1, len(files) // BATCHES)


def _clear(spark: SparkSession, root: str) -> None:
    """Remove what a query made for itself and its result does not read: the change files it
    landed, and what streams and schemas keep to go on from."""
    for name in ("source", "checkpoint", "schema", "quarters", "tables/_checkpoints"):
        delete(spark, f"{root}/{name}")


def _bronze(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = ENTITIES[entity]
    root = scratch_dir(spark, spec.bronze)
    nested = entity == "encounters"
    _land(_feed(spark, sf_dir, entity), f"{root}/source/{entity}", "cdc_timestamp" if nested else None)
    schema = tracked_schema(spark, f"{root}/source/{entity}", f"{root}/schema")
    rows = ingest_files(spark, f"{root}/source/{entity}", schema)
    with bounded_splits(spark):
        finish([append_stream(rows, f"{root}/{spec.bronze}", f"{root}/checkpoint", spec.raw_layout)])
    _clear(spark, root)
    read = read_files(spark, f"{root}/{spec.bronze}", rows.schema)
    return read.select(
        *schema.names,
        F.element_at(F.split(SOURCE_FILE, "/"), -2).alias("source_folder"),
        F.col(INGESTED_AT).isNotNull().alias("ingest_time_set"),
    )


def _bronze_events_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "bronze_events")
    schema = tracked_schema(spark, sf_dir, f"{root}/schema", path_glob="events.parquet")
    rows = ingest_files(spark, sf_dir, schema, path_glob="events.parquet")
    finish([append_stream(rows, f"{root}/bronze_events", f"{root}/checkpoint")])
    read = read_files(spark, f"{root}/bronze_events", rows.schema)
    name = F.element_at(F.split(SOURCE_FILE, "/"), -1)
    return read.select(*schema.names, name.alias("source_file"))


def _bronze_schema_evolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The deliveries from the middle of the month on have two more columns."""
    root = scratch_dir(spark, "bronze_evolving")
    events = tables_in(spark, sf_dir)("events")
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    deliveries = (events.filter(~late).drop("value", "props"), events.filter(late))
    for number, delivery in enumerate(deliveries):
        delivery.write.parquet(f"{root}/source/batch_{number:03d}")
        schema = tracked_schema(spark, f"{root}/source", f"{root}/schema")
        rows = ingest_files(spark, f"{root}/source", schema)
        finish([append_stream(rows, f"{root}/table", f"{root}/checkpoint", ("ts",))])
    _clear(spark, root)
    folder = F.element_at(F.split(SOURCE_FILE, "/"), -2)
    return read_files(spark, f"{root}/table", rows.schema).select(
        *schema.names, folder.alias("source_folder")
    )


def _bronze_rescued_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Procedures whose ``s3`` first arrives as a whole number, and then, in one batch, from some files
    as text that is not always one and from others as a fraction. A new column comes with them."""
    root = scratch_dir(spark, "rescued")
    feed, number = _feed(spark, sf_dir, "procedures"), F.col("s3")
    texts = F.when(number % 7 == 0, F.concat(F.lit("n/a "), number)).otherwise(number.cast("string"))
    deliveries = {
        "whole": feed.filter(number % 3 == 0),
        "text": feed.filter(number % 3 == 1).withColumn("s3", texts).withColumn("origin", F.lit("text")),
        "fraction": feed.filter(number % 3 == 2).withColumn("s3", number + F.when(number % 5 == 0, 0.5).otherwise(0.0)),
    }
    for run in (("whole",), ("text", "fraction")):
        for name in run:
            deliveries[name].write.parquet(f"{root}/source/{name}")
        intake(spark, f"{root}/source", f"{root}/schema", f"{root}/bronze", f"{root}/checkpoint", (), lambda rows, name: None)
    schema = stored_schema(spark, f"{root}/schema").add(SOURCE_FILE, T.StringType())
    _clear(spark, root)
    folder = F.element_at(F.split(SOURCE_FILE, "/"), -2).alias("source_folder")
    found = read_files(spark, f"{root}/bronze", schema).select("*", folder, F.typeof("s3").alias("s3_type")).drop(SOURCE_FILE)
    return found.withColumn("s3", F.col("s3").cast("string"))  # engines hand over whole numbers with NULLs differently


def _age(feed: DataFrame) -> DataFrame:
    """Which quarter of the time stamps a change is in, the newest 0; without one, the oldest."""
    cuts = [(BATCHES - i) / BATCHES for i in range(1, BATCHES)]
    seconds = F.unix_seconds(F.col("cdc_timestamp").cast("timestamp"))
    edges = feed.agg(F.percentile_approx(seconds, cuts)).first()[0] or []
    older = [F.coalesce(seconds <= F.lit(edge), F.lit(True)).cast("int") for edge in edges]
    return feed.withColumn("age", reduce(lambda a, b: a + b, older, F.lit(0)))


def _current_incremental(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checked changes arrive a quarter at a time, the newest first, and the second quarter
    once more at the end; each delivery is a run of the stream."""
    spec = ENTITIES[entity]
    root = scratch_dir(spark, spec.current)
    feed = _silver(entity, spark, sf_dir)
    _age(feed).write.partitionBy("age").parquet(f"{root}/quarters")
    table = CurrentTable(
        spark, f"{root}/{spec.current}", spec.keys, spec.sequence_by, spec.tie_break, cluster_by=spec.layout
    ).create(feed.schema)
    quarters = spark.read.parquet(f"{root}/quarters")
    for number, age in enumerate((*range(BATCHES), 1)):
        quarters.filter(F.col("age") == age).drop("age").write.parquet(f"{root}/source/batch_{number:03d}")
        rows = stream_files(spark, f"{root}/source", feed.schema)
        finish([upsert_stream(rows, table, f"{root}/checkpoint")])
    _clear(spark, root)
    return table.read()


def _deliveries_with_deletes(spark: SparkSession, sf_dir: str, table, root: str) -> DataFrame:
    """Checked changes and deletes arrive a quarter at a time, the newest first, so that most deletes
    are there before what they delete; the second quarter comes once more at the end. After two
    deliveries the table is compacted and the superseded files go."""
    spec = replace(ENTITIES["encounters"], delete_when=DELETES)
    feed = _feed(spark, sf_dir, "encounters")
    changes = with_deletes(checked(feed, spec), feed, spec)
    changes.write.option("compression", CODEC).parquet(f"{root}/quarters")  # once; which quarter a change is in is read off what is stored
    table.create(changes.schema)
    quarters = _age(spark.read.schema(changes.schema).parquet(f"{root}/quarters"))
    for number, age in enumerate((*range(BATCHES), 1)):
        quarters.filter(F.col("age") == age).drop("age").write.option("compression", CODEC).parquet(f"{root}/source/batch_{number:03d}")
        rows = stream_files(spark, f"{root}/source", changes.schema)
        with bounded_splits(spark):
            finish([upsert_stream(rows, table, f"{root}/checkpoint")])
            if number == 1:
                table.remove(table.compact())
    _clear(spark, root)
    return table.read()


def _current_encounters_with_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, spec = scratch_dir(spark, "deletes"), ENTITIES["encounters"]
    table = CurrentTable(
        spark, f"{root}/current", spec.keys, spec.sequence_by, spec.tie_break, spec.layout, delete_when=DELETES, buckets=BUCKETS
    )
    return _deliveries_with_deletes(spark, sf_dir, table, root)


def _history_encounters_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, spec = scratch_dir(spark, "history"), ENTITIES["encounters"]
    table = HistoryTable(spark, f"{root}/history", spec.keys, spec.sequence_by, spec.tie_break, spec.layout, delete_when=DELETES)
    return _deliveries_with_deletes(spark, sf_dir, table, root)


def _gated(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Encounters in three deliveries behind a rule that blocks; those it refuses are passed over.
    Returns the folder, and the changes for their schema."""
    root, spec = scratch_dir(spark, "gated"), ENTITIES["encounters"]
    time = F.col("cdc_timestamp").cast("timestamp")
    number = reduce(lambda a, b: a + b, [(time >= F.lit(cut).cast("timestamp")).cast("int") for cut in DELIVERY_CUTS])
    feed = spec.clean(_feed(spark, sf_dir, "encounters")).withColumn("delivery", number)
    for delivery in (1, 0, 2):  # the one with such stays comes between two that pass
        feed.filter(F.col("delivery") == delivery).write.parquet(f"{root}/source/batch_{delivery:03d}")
        rows = stream_files(spark, f"{root}/source", feed.schema)
        rules = (*spec.rules, expect_or_fail(*GATE))
        gate = append_stream(
            rows, f"{root}/table", f"{root}/checkpoint", spec.layout, rules, f"{root}/counts", f"{root}/refused", skip_refused=True
        )
        finish([gate])
    _clear(spark, root)
    return root, feed


def _silver_encounters_gated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What got through the gate: nothing of a delivery with a row that fails."""
    root, feed = _gated(spark, sf_dir)
    return read_files(spark, f"{root}/table", feed.schema)


def _refused_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows for which deliveries were refused, with the rules they fail."""
    root, feed = _gated(spark, sf_dir)
    rows = read_files(spark, f"{root}/refused", T.StructType([*feed.schema, T.StructField("failed_rules", T.ArrayType(T.StringType()))]))
    return rows.withColumn("failed_rules", F.array_join("failed_rules", ","))


def _current_encounters_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes with and without the last column, tied in time, in both orders of arrival.

    Each change comes twice, once with ``s5`` and once without. The one that has a value wins,
    whichever was first; a row of the result says how many orders led to it.
    """
    root = scratch_dir(spark, "evolving")
    spec = ENTITIES["encounters"]
    feed = _silver("encounters", spark, sf_dir).withColumn("s2", F.lit(0)).drop("s3", "s4")
    found = []
    for order, batches in enumerate(((feed.drop("s5"), feed), (feed, feed.drop("s5")))):
        table = CurrentTable(spark, f"{root}/{order}", spec.keys, spec.sequence_by)
        for batch in batches:
            table.apply(batch)
        found.append(table.read().select(*feed.columns))
    both = found[0].unionByName(found[1])
    return both.groupBy(*feed.columns).agg(F.count("*").alias("orders"))


def _quality_streamed(entity: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counted while the checked rows are written, batch by batch."""
    spec = ENTITIES[entity]
    root = scratch_dir(spark, spec.silver)
    _age(_feed(spark, sf_dir, entity)).write.partitionBy("age").parquet(f"{root}/source")
    changes = stream_files(
        spark,
        f"{root}/source",
        infer_schema(spark, f"{root}/source"),
        max_files_per_trigger=_files_per_batch(spark, f"{root}/source"),
    )
    finish(
        [
            append_stream(
                spec.clean(changes.drop("age")),
                f"{root}/{spec.silver}",
                f"{root}/checkpoint",
                spec.layout,
                spec.rules,
                f"{root}/counts",
            )
        ]
    )
    _clear(spark, root)
    return quality_history(spark, f"{root}/counts", spec.rules, spec.silver)


def _layers(spark: SparkSession, sf_dir: str, database: str = "") -> Layers:
    root = scratch_dir(spark, "layers")
    for entity in ENTITIES:
        by = "cdc_timestamp" if entity == "encounters" else None
        _land(_feed(spark, sf_dir, entity), f"{root}/source/{entity}", by)
    tables = tuple(ENTITIES.values())
    layers = Layers(spark, f"{root}/source", f"{root}/tables", tables, REPORTS, database=database).run()
    _clear(spark, root)
    return layers


@contextmanager
def _database(spark: SparkSession) -> Iterator[str]:
    """A database of the catalog for one query. What was read from it by name stays readable: its
    entries go, the files of its external tables do not."""
    root = scratch_dir(spark, "named")
    name = f"named_{root[-32:]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{root}/database'")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def _layers_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    layers = _layers(spark, sf_dir)
    counts = [
        layers.read(name).agg(F.count("*").alias("row_count")).select(F.lit(name).alias("dataset"), "row_count")
        for name in layers.datasets()
    ]
    return reduce(DataFrame.unionAll, counts)


# The three entities as rows of a table. Names, expressions and values are the fixed ones.
SPEC_ROWS = """
    SELECT 'encounters' AS name, array('encounter_id') AS keys, 'cdc_timestamp' AS sequence_by,
      array('cdc_operation <> \\'D\\'') AS filters,
      array(
        struct('length_of_stay_hours' AS name, 'CASE WHEN discharge_date IS NOT NULL THEN round((unix_seconds(CAST(discharge_date AS TIMESTAMP)) - unix_seconds(CAST(admit_date AS TIMESTAMP))) / 3600, 1) END' AS expression),
        struct('is_emergency' AS name, 'encounter_type = \\'EMERGENCY\\'' AS expression)) AS derived,
      array('_rescued_data') AS dropped,
      array(
        struct('valid_encounter_id' AS name, 'encounter_id IS NOT NULL' AS predicate, 'drop' AS action),
        struct('valid_patient_id' AS name, 'patient_id IS NOT NULL' AS predicate, 'drop' AS action),
        struct('valid_admit_date' AS name, 'admit_date IS NOT NULL' AS predicate, 'drop' AS action),
        struct('valid_discharge_order' AS name, 'discharge_date IS NULL OR discharge_date >= admit_date' AS predicate, 'warn' AS action)) AS rules,
      array('s2', 's3', 's4', 's5') AS tie_break, array('admit_date') AS raw_layout, array('facility_code', 'admit_date') AS layout
    UNION ALL
    SELECT 'diagnoses', array('diagnosis_id'), 'cdc_timestamp', array('cdc_operation <> \\'D\\'', 'is_active'), NULL, array('_rescued_data'),
      array(
        struct('valid_diagnosis_id', 'diagnosis_id IS NOT NULL', 'drop'),
        struct('valid_encounter_id', 'encounter_id IS NOT NULL', 'drop'),
        struct('valid_icd10_format', 'diagnosis_code RLIKE \\'^[A-Z][0-9]{2}([.][0-9A-Z]{1,4})?$\\'', 'warn')),
      array('s3', 's4', 's5'), array('cdc_timestamp'), array('diagnosis_code')
    UNION ALL
    SELECT 'procedures', array('procedure_id'), 'cdc_timestamp', array('cdc_operation <> \\'D\\''), NULL, array('_rescued_data'),
      array(
        struct('valid_procedure_id', 'procedure_id IS NOT NULL', 'drop'),
        struct('valid_encounter_id', 'encounter_id IS NOT NULL', 'drop'),
        struct('valid_status', 'procedure_status IN (\\'COMPLETED\\', \\'SCHEDULED\\', \\'CANCELLED\\')', 'warn')),
      array('s3'), array('procedure_date'), array('procedure_code', 'procedure_date')
"""


def _layers_from_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all datasets, and how many failed each rule, by entities read from a Parquet table."""
    root = scratch_dir(spark, "specs")
    spark.sql(SPEC_ROWS).write.parquet(f"{root}/specs")
    specs = load_specs(spark.read.parquet(f"{root}/specs"))
    check_specs(specs, lambda name: _feed(spark, sf_dir, name))
    for spec in specs:
        _land(_feed(spark, sf_dir, spec.name), f"{root}/source/{spec.name}")
    layers = Layers(spark, f"{root}/source", f"{root}/tables", specs, REPORTS).run()
    _clear(spark, root)
    counts = [
        layers.read(name).agg(F.count("*").alias("row_count")).select(F.lit(name).alias("dataset"), F.lit("").alias("rule"), "row_count")
        for name in layers.datasets()
    ]
    failed = [layers.quality(s).select("dataset", "rule", F.col("failed_rows").alias("row_count")) for s in specs]
    return reduce(DataFrame.unionAll, counts + failed)


def _layers_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All datasets by their published names: the comment the catalog has, and the rows found there."""
    with _database(spark) as database:
        layers = _layers(spark, sf_dir, database)
        layers.publish()
        found = []
        for name in layers.datasets():
            comment = F.lit(spark.catalog.getTable(f"{database}.{name}").description).alias("table_comment")
            counted = spark.read.table(f"{database}.{name}").agg(F.count("*").alias("row_count"))
            found.append(counted.select(F.lit(name).alias("dataset"), comment, "row_count"))
        return reduce(DataFrame.unionAll, found)


def _layers_diagnosis_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report by its published name."""
    with _database(spark) as database:
        _layers(spark, sf_dir, database).publish()
        return spark.read.table(f"{database}.gold_diagnosis_distribution")


def _layers_current_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published after the first half of the deliveries, then two more runs, a compaction, and
    the superseded files gone: read by name, with its comment."""
    root = scratch_dir(spark, "named")
    spec = ENTITIES["procedures"]
    feed = _age(_feed(spark, sf_dir, "procedures"))
    with _database(spark) as database:
        layers = Layers(spark, f"{root}/source", f"{root}/tables", (spec,), database=database)
        for number in range(BATCHES - 1):
            part = feed.filter(F.col("age") >= 2 if number == 0 else F.col("age") == number - 1).drop("age")
            part.write.parquet(f"{root}/source/{spec.name}/batch_{number:03d}")
            layers.run()
            if number == 0:
                layers.publish()
        layers.current_table(spec).remove(layers.compact()[spec.current])
        layers.run()
        comment = spark.catalog.getTable(f"{database}.{spec.current}").description
        rows = spark.read.table(f"{database}.{spec.current}").drop(INGESTED_AT, SOURCE_FILE)
        return rows.withColumn("table_comment", F.lit(comment))


# -- contract -------------------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Facility summary over the current encounters."""
    return _facility_summary(spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Each takes (spark, folder of the tables) and returns a DataFrame."""
    found: dict[str, Callable[[SparkSession, str], DataFrame]] = {
        "bronze_events_ingested": _bronze_events_ingested,
        "bronze_schema_evolution": _bronze_schema_evolution,
        "bronze_rescued_types": _bronze_rescued_types,
    }
    for entity in ENTITIES:
        found[f"bronze_{entity}"] = partial(_bronze, entity)
        found[f"silver_{entity}"] = partial(_silver, entity)
        found[f"quality_{entity}"] = partial(_quality, entity)
        found[f"quality_{entity}_streamed"] = partial(_quality_streamed, entity)
        found[f"current_{entity}"] = partial(_current, entity)
        found[f"current_{entity}_incremental"] = partial(_current_incremental, entity)
    return {
        **found,
        "facility_summary": _facility_summary,
        "diagnoses_with_facility": _diagnoses_with_facility,
        "diagnosis_distribution": _diagnosis_distribution,
        "daily_admissions": _daily_admissions,
        "top_codes": _top_codes,
        "clustered_roundtrip": _clustered_roundtrip,
        "clustered_both_ways": _clustered_both_ways,
        "silver_procedures_rescued": _silver_procedures_rescued,
        "layers_row_counts": _layers_row_counts,
        "layers_diagnosis_distribution": _layers_diagnosis_distribution,
        "layers_current_by_name": _layers_current_by_name,
        "layers_comments": _layers_comments,
        "layers_from_table": _layers_from_table,
        "current_encounters_evolving": _current_encounters_evolving,
        "current_encounters_with_deletes": _current_encounters_with_deletes,
        "history_encounters_incremental": _history_encounters_incremental,
        "silver_encounters_gated": _silver_encounters_gated,
        "refused_encounters": _refused_encounters,
        **LLM_QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    """The same results by SQL over the tables, which are registered as views."""
    found = {
        "bronze_events_ingested": "select *, 'events.parquet' as source_file from events",
        "bronze_schema_evolution": """select event_id, ts, user_id, event_type,
            case when ts >= timestamp '2024-01-16' then value end as value,
            case when ts >= timestamp '2024-01-16' then props end as props,
            case when ts >= timestamp '2024-01-16' then 'batch_001' else 'batch_000' end
              as source_folder
            from events""",
        "bronze_rescued_types": oracles.rescued_types(),
    }
    year = "concat('year=', cast(year(cdc_timestamp) as varchar))"
    for entity in ENTITIES:
        folder = year if entity == "encounters" else f"'{entity}'"
        found[f"bronze_{entity}"] = oracles.bronze(entity, folder)
        found[f"silver_{entity}"] = oracles.silver(entity)
        found[f"quality_{entity}"] = oracles.quality(entity)
        found[f"quality_{entity}_streamed"] = oracles.quality(entity)
        found[f"current_{entity}"] = oracles.current(entity)
        found[f"current_{entity}_incremental"] = oracles.current(entity)
    return {
        **found,
        "facility_summary": oracles.facility_summary(),
        "diagnoses_with_facility": oracles.diagnoses_with_facility(),
        "diagnosis_distribution": oracles.diagnosis_distribution(),
        "daily_admissions": oracles.daily_admissions(),
        "top_codes": oracles.top_codes(TOP),
        "clustered_roundtrip": f"select *, true as file_apart from ({oracles.daily_admissions()})",
        "clustered_both_ways": f"""select *, true as skipped_by_facility_code, true as skipped_by_admit_date_day
            from ({oracles.daily_admissions()})""",
        "silver_procedures_rescued": oracles.silver("procedures"),
        "layers_row_counts": oracles.row_counts(),
        "layers_diagnosis_distribution": oracles.diagnosis_distribution(),
        "layers_current_by_name": f"""select *, 'Procedures, latest row per procedure_id' as table_comment
            from ({oracles.current('procedures')})""",
        "layers_from_table": f"""select dataset, '' as "rule", row_count from ({oracles.row_counts()}) union all
            """ + " union all ".join(f'select dataset, "rule", failed_rows from ({oracles.quality(e)})' for e in ENTITIES),
        "layers_comments": oracles.comments(
            {name: text for s in TABLES for name, text in zip((s.bronze, s.silver, s.current), s.comments.values(), strict=True)}
            | {report.name: report.comment for report in REPORTS}
        ),
        "current_encounters_evolving": oracles.evolving(),
        "current_encounters_with_deletes": oracles.current_with_deletes("encounters"),
        "history_encounters_incremental": oracles.history("encounters"),
        "silver_encounters_gated": oracles.gated_silver(DELIVERY_CUTS, GATE[1]),
        "refused_encounters": oracles.gated_refused(DELIVERY_CUTS, *GATE),
        **LLM_ORACLES,
    }
