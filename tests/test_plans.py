"""The physical plans: what is read, what is shuffled, and what stays out of Python."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from changeflow.operators import (
    cluster_by_curve,
    cluster_globally,
    daily_admissions,
    diagnosis_distribution,
    facility_summary,
    file_skips,
    top_per_group,
    write_clustered,
)

TABLES = "/root/testdata/sf0.001"

needs_tables = pytest.mark.skipif(not os.path.isdir(TABLES), reason="needs the test tables")
BATCH = sorted(
    name
    for name in registry.queries()
    if name.startswith(("silver_", "current_", "facility", "diagnos", "daily"))
    and not name.endswith(("_incremental", "_streamed"))
)


@needs_tables
@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cross_join_no_hint(spark, plan, name):
    text = plan(registry.queries()[name](spark, TABLES))
    for word in ("Python", "Pandas", "Cartesian", "NestedLoop", "SinglePartition"):
        assert word not in text


@needs_tables
def test_checks_are_pushed_to_the_scan_without_a_shuffle(spark, plan):
    text = plan(registry.queries()["silver_diagnoses"](spark, TABLES))
    assert "Exchange" not in text
    assert "GreaterThan(l_quantity,12.0)" in text


def stored(spark, path):
    spark.range(50).select(
        F.col("id").cast("string").alias("encounter_id"),
        F.lit("p").alias("patient_id"),
        F.lit("f").alias("facility_code"),
        F.lit("INPATIENT").alias("encounter_type"),
        F.lit("I10").alias("diagnosis_code"),
        F.lit("ICD-10-CM").alias("code_system"),
        F.lit(1.5).alias("length_of_stay_hours"),
        F.lit(True).alias("is_emergency"),
        F.lit("2026-03-01").cast("timestamp").alias("admit_date"),
        F.lit("never read").alias("notes"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_reports_read_only_their_columns(spark, plan, tmp_path):
    table = stored(spark, str(tmp_path / "t"))
    diagnoses = table.drop("facility_code", "encounter_type")
    for report in (facility_summary(table), daily_admissions(table), diagnosis_distribution(diagnoses, table)):
        text = plan(report)
        assert "ReadSchema" in text and "notes" not in text
    assert "encounter_id" not in plan(facility_summary(table))


def test_distinct_counts_are_shuffled_by_value_and_reduced_first(spark, plan, tmp_path):
    text = plan(facility_summary(stored(spark, str(tmp_path / "t"))))
    by_value = text.split("Exchange hashpartitioning(facility_code")[2]
    assert "patient_id" in by_value.split("\n")[0]
    assert "partial_avg" in by_value.split("\n")[1]


def test_rows_are_reduced_before_they_are_tripled(spark, plan, tmp_path):
    table = stored(spark, str(tmp_path / "t"))
    text = plan(diagnosis_distribution(table.drop("facility_code", "encounter_type"), table))
    below = text.split("Expand")[1]
    assert "HashAggregate(keys=[encounter_id" in below and "count(1)" in below


def test_a_hot_encounter_is_split_in_the_join(spark, tmp_path, plan):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        # A partition is split between the tasks that wrote it; so few rows would get a single one.
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    encounters = spark.range(2000).selectExpr(
        "cast(id as string) encounter_id", "'f' facility_code", "'t' encounter_type"
    )
    diagnoses = spark.range(0, 40_000, 1, 8).selectExpr(
        "if(id % 3 = 0, '7', cast(id % 2000 as string)) encounter_id",
        "cast(id as string) patient_id",
        "'I10' diagnosis_code",
        "'s' code_system",
    )
    encounters.write.parquet(str(tmp_path / "e"))
    diagnoses.write.parquet(str(tmp_path / "d"))
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        report = diagnosis_distribution(
            spark.read.parquet(str(tmp_path / "d")), spark.read.parquet(str(tmp_path / "e"))
        )
        row = report.collect()
        assert [(r.diagnosis_count, r.encounter_count, r.patient_count) for r in row] == [(40000, 2000, 40000)]
        assert "SortMergeJoin(skew=true)" in plan(report)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_a_hot_value_is_spread_by_the_layout(spark):
    try:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        df = spark.range(0, 30_000, 1, 4).selectExpr("if(id % 3 = 0, 'hot', cast(id as string)) f", "id")
        laid = cluster_globally(df, ["f"])
        sizes = [r["count"] for r in laid.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 30_000 and max(sizes) < 10_000
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_top_rows_are_limited_before_the_shuffle(spark, plan):
    """A group with a third of all rows arrives as n rows a task, ties by the declared rule."""
    df = spark.range(0, 30_000, 1, 4).selectExpr("if(id % 3 = 0, 'hot', cast(id % 50 as string)) g", "cast(id % 100 as int) v", "id")
    top = top_per_group(df, ["g"], [F.col("v").desc(), F.col("id")], 3)
    below = plan(top).split("Exchange hashpartitioning(g")[1]
    assert "WindowGroupLimit [g" in below and "Partial" in below
    hot = [tuple(r) for r in top.filter("g = 'hot'").orderBy("rank").collect()]
    assert hot == [("hot", 99, 99, 1), ("hot", 99, 399, 2), ("hot", 99, 699, 3)]
    ties = top_per_group(df, ["g"], [F.col("v").desc()], 3, rank="place", with_ties=True)
    assert ties.filter("g = 'hot'").select("v", "place").distinct().collect() == [(99, 1)]
    assert top_per_group(df.limit(0), ["g"], [F.col("v")], 3).collect() == []
    with pytest.raises(ValueError, match="rank"):
        top_per_group(df.withColumnRenamed("v", "rank"), ["g"], [F.col("id")], 3)


def test_a_curve_skips_files_by_either_column(spark, tmp_path):
    """Sorted by both columns, a filter on the second one reads almost every file."""
    df = spark.range(0, 40_000, 1, 4).selectExpr(
        "if(id % 3 = 0, 'hot', concat('f', id * 7 % 40)) f", "date_add(date '2024-01-01', cast(id * 13 % 365 as int)) d", "id"
    )
    shares = {}
    for name, by_curve in (("curve", True), ("sorted", False)):
        write_clustered(df, f"{tmp_path}/{name}", ("f", "d"), 16, by_curve)
        skips = file_skips(spark.read.parquet(f"{tmp_path}/{name}"), ("f", "d"))
        assert skips.count() == 40_000
        shares[name] = skips.agg(F.avg("skipped_by_f"), F.avg("skipped_by_d"), F.min("skipped_by_d")).first()
    assert shares["sorted"][1] < 0.6 < shares["curve"][1] and shares["curve"][0] > 0.4 and shares["curve"][2] >= 0.25
    sizes = [r["count"] for r in spark.read.parquet(f"{tmp_path}/curve").groupBy("_metadata.file_name").count().collect()]
    assert max(sizes) < 2 * min(sizes) + 500  # the hot value is cut by the other column
    nulls = df.withColumn("f", F.when(F.col("id") % 2 == 0, F.col("f"))).withColumn("_place", F.lit("mine"))
    laid = cluster_by_curve(nulls, ["f", "d"], 4)
    assert laid.columns == nulls.columns and laid.filter("_place = 'mine'").count() == 40_000
    assert cluster_by_curve(df.limit(0), ["f", "d"]).count() == 0
    assert cluster_by_curve(df, ["f"]).count() == cluster_by_curve(df, []).count() == 40_000
