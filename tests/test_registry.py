"""Every registered query beside its SQL, and the fixed numbers the feeds must give."""

import os
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
import compare

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test tables")


OWN = sorted(set(registry.queries()) - set(registry.LLM_QUERIES))  # the others have tests of their own


def test_every_query_has_sql():
    assert set(OWN) <= set(registry.oracle_sql()) <= set(registry.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in compare.TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    got = registry.queries()[name](spark, SMALL).toPandas()
    want = db.execute(registry.oracle_sql()[name]).df()
    assert compare.differences(got, want) is None


def test_entry(spark):
    assert registry.entry(spark).count() > 0


def test_known_values(spark):
    def run(name):
        return registry.queries()[name](spark, MEDIUM)

    silver = run("silver_encounters").agg(
        F.count("*"),
        F.countDistinct("encounter_id"),
        F.sum("length_of_stay_hours"),
        F.min("length_of_stay_hours"),
        F.max("length_of_stay_hours"),
        F.count_if(F.col("length_of_stay_hours").isNull()),
        F.count_if(F.expr("NOT (discharge_date IS NULL OR discharge_date >= admit_date)")),
    )
    assert tuple(silver.first()) == (38713, 13885, 15222432.0, -57024.0, 58944.0, 19394, 9411)
    now = run("current_encounters").agg(F.count("*"), F.sum("s3"), F.count_if("is_emergency"))
    assert tuple(now.first()) == (13885, 13895481, 2762)
    assert tuple(run("current_diagnoses").agg(F.count("*"), F.sum("s3")).first()) == (26053, 26069378)
    ids = F.col("encounter_id").cast("long")
    assert tuple(run("current_procedures").agg(F.count("*"), F.sum(ids)).first()) == (600, 44700)
    failed = {r["rule"]: r["failed_rows"] for r in run("quality_encounters").collect()}
    assert list(failed.values()) == [433, 435, 423, 9807]
    assert run("diagnoses_with_facility").count() == 26012


@pytest.mark.parametrize(("entity", "expected"), [("encounters", 4178), ("diagnoses", 3250)])
def test_keys_that_end_deleted_or_inactive_stay_current(spark, entity, expected):
    """Filtering comes before deduplication; the other order would lose these keys."""
    from changeflow.operators import latest_by_key

    spec = registry.ENTITIES[entity]
    feed = registry._feed(spark, MEDIUM, entity)
    last = latest_by_key(feed, spec.keys, spec.sequence_by, spec.tie_break)
    gone = last.filter("cdc_operation = 'D'" + (" OR NOT is_active" if entity == "diagnoses" else ""))
    now = registry.queries()[f"current_{entity}"](spark, MEDIUM)
    assert now.join(gone.select(*spec.keys), list(spec.keys), "left_semi").count() == expected


def test_late_deliveries_are_late(spark, monkeypatch):
    """The deliveries come newest first; a merge in which the last one wins must be seen."""
    seen = []

    class LastWins(registry.CurrentTable):
        def apply(self, changes):
            times = changes.agg(F.min("cdc_timestamp"), F.max("cdc_timestamp"), F.count("*")).first()
            seen.append(tuple(times))
            super().apply(changes.withColumn("cdc_timestamp", F.lit(f"2030-01-{len(seen):02d}").cast("timestamp_ntz")))

    monkeypatch.setattr(registry, "CurrentTable", LastWins)
    for entity in registry.ENTITIES:
        seen.clear()
        got = registry.queries()[f"current_{entity}_incremental"](spark, SMALL).drop("cdc_timestamp")
        assert len(seen) == registry.BATCHES + 1 and all(n for *_, n in seen)
        for newer, older in zip(seen[:3], seen[1:4]):
            assert older[1] <= newer[0]
        assert seen[4] == seen[1]
        want = registry.queries()[f"current_{entity}"](spark, SMALL).drop("cdc_timestamp")
        assert got.exceptAll(want).count() > 0


def test_quality_is_counted_over_several_batches(spark, monkeypatch):
    batches = []
    real = registry.quality_history

    def spy(session, folder, rules, name):
        batches.append(real(session, folder, rules, name, True).select("batch").distinct().count())
        return real(session, folder, rules, name)

    monkeypatch.setattr(registry, "quality_history", spy)
    for entity in registry.ENTITIES:
        registry.queries()[f"quality_{entity}_streamed"](spark, SMALL).count()
    assert min(batches) >= registry.BATCHES


def test_a_missing_layout_is_seen(spark, monkeypatch):
    monkeypatch.setattr("changeflow.operators.layout.cluster_globally", lambda df, columns, files: df.repartition(files))
    assert registry.queries()["clustered_roundtrip"](spark, SMALL).filter("NOT file_apart").count() > 0
    assert registry.queries()["clustered_both_ways"](spark, SMALL).filter("NOT skipped_by_admit_date_day").count() > 0


def test_the_registry_loads_without_libraries_of_the_training_data_queries():
    """A library only they use may be absent: the other queries are there all the same."""
    code = """
import sys
class Absent:
    def find_spec(self, name, path=None, target=None):
        if name.split('.')[0] in ('numpy', 'zstandard', 'public_tokenizers'):
            raise ModuleNotFoundError(f'No module named {name!r}', name=name)
sys.meta_path.insert(0, Absent())
import __spark_entry__ as registry
print(sorted(registry.queries()) == sorted(set(registry.queries()) - set(registry.LLM_QUERIES)), len(registry.queries()))
"""
    root = os.path.dirname(os.path.abspath(registry.__file__))
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert done.stdout.split() == ["True", str(len(OWN))]
