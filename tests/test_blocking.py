"""Rules that block a batch: nothing of it is seen until it passes."""

import os
from dataclasses import replace

import pytest
from conftest import rows
from pyspark.errors import StreamingQueryException
from test_layers import DIAGNOSIS, FIRST, SECOND, at, deliver, diagnosis, encounter

from changeflow.operators import BatchRefused, expect, expect_or_drop, expect_or_fail, quality_history, quality_report, refused_rows
from changeflow.plans import Layers, checked, current
from changeflow.plans.clinical import DIAGNOSES, ENCOUNTERS, PROCEDURES, REPORTS
from changeflow.sources import read_files, stream_files
from changeflow.streaming import append_stream, finish

SCHEMA = "k string, v int"
RULES = (expect_or_drop("has_key", "k IS NOT NULL"), expect("low", "v < 5"), expect_or_fail("positive", "v > 0"))


def start(spark, tmp_path, rules=RULES, **options):
    stream = stream_files(spark, f"{tmp_path}/in", spark.createDataFrame([], SCHEMA).schema, max_files_per_trigger=1)
    finish([append_stream(stream, f"{tmp_path}/out", f"{tmp_path}/checkpoint", ("k",), rules, f"{tmp_path}/counts", f"{tmp_path}/refused", **options)])


def land(spark, tmp_path, number, data):
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/in/{number}")


def visible(spark, tmp_path):
    return rows(read_files(spark, f"{tmp_path}/out", spark.createDataFrame([], SCHEMA).schema))


def failing(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA + ", failed_rules array<string>").schema
    return rows(read_files(spark, f"{tmp_path}/refused", schema))


def test_a_refused_batch_is_not_seen_and_comes_again(spark, tmp_path):
    land(spark, tmp_path, 0, [("a", 1), (None, 2)])
    start(spark, tmp_path)
    land(spark, tmp_path, 1, [("b", 2), ("c", 0), ("d", None)])
    for _ in range(2):  # it blocks as long as it fails
        with pytest.raises(StreamingQueryException, match="positive"):
            start(spark, tmp_path)
        assert visible(spark, tmp_path) == [("a", 1)]
        assert failing(spark, tmp_path) == [("c", 0, ["positive"]), ("d", None, ["positive"])]
    land(spark, tmp_path, 2, [("e", 3)])
    with pytest.raises(StreamingQueryException):
        start(spark, tmp_path)
    assert visible(spark, tmp_path) == [("a", 1)]  # what comes after waits
    start(spark, tmp_path, RULES[:2])  # the rule is lifted
    assert visible(spark, tmp_path) == [("a", 1), ("b", 2), ("c", 0), ("d", None), ("e", 3)]


def test_a_batch_that_passes_later_is_no_longer_refused(spark, tmp_path):
    land(spark, tmp_path, 0, [("b", 2), ("c", 0)])
    with pytest.raises(StreamingQueryException):
        start(spark, tmp_path)
    assert failing(spark, tmp_path) == [("c", 0, ["positive"])]
    start(spark, tmp_path, (*RULES[:2], expect_or_fail("positive", "v >= 0")))
    assert visible(spark, tmp_path) == [("b", 2), ("c", 0)] and failing(spark, tmp_path) == []


def test_refused_batches_may_be_passed_over(spark, tmp_path):
    for number, data in enumerate(([("a", 1)], [("b", 0), ("c", 7)], [("d", 2)])):
        land(spark, tmp_path, number, data)
    start(spark, tmp_path, skip_refused=True)
    start(spark, tmp_path, skip_refused=True)
    assert visible(spark, tmp_path) == [("a", 1), ("d", 2)]
    assert failing(spark, tmp_path) == [("b", 0, ["positive"])]
    report = quality_history(spark, f"{tmp_path}/counts", RULES, "t")
    assert rows(report, "rule", "action", "total_rows", "failed_rows") == [
        ("has_key", "drop", 4, 0), ("low", "warn", 4, 1), ("positive", "fail", 4, 1)
    ]


def test_a_lost_run_leaves_nothing_to_see(spark, tmp_path, monkeypatch):
    """The run ends between writing and the gate; the draft is no part of the table."""
    land(spark, tmp_path, 0, [("a", 1)])
    monkeypatch.setattr("changeflow.streaming.flows.replace_folder", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(StreamingQueryException, match="lost"):
        start(spark, tmp_path)
    assert any("_draft" in f for f, _, _ in os.walk(tmp_path)) and visible(spark, tmp_path) == []
    monkeypatch.undo()
    start(spark, tmp_path)
    assert visible(spark, tmp_path) == [("a", 1)] and not any("_draft" in f for f, _, _ in os.walk(f"{tmp_path}/out"))


def test_rows_and_reports_of_a_batch_frame(spark):
    df = spark.createDataFrame([("a", 1), ("b", -1), (None, None)], SCHEMA)
    rules = (*RULES, expect_or_fail("odd", "v % 2 = 1"))
    assert rows(refused_rows(df, rules)) == sorted([("b", -1, ["positive", "odd"]), (None, None, ["positive", "odd"])], key=repr)
    assert refused_rows(df, RULES[:2]).count() == 0
    assert rows(quality_report(df, rules, "t"), "rule", "action", "failed_rows") == [
        ("has_key", "drop", 1), ("low", "warn", 1), ("odd", "fail", 2), ("positive", "fail", 2)
    ]
    with pytest.raises(ValueError, match="failed_rules"):
        refused_rows(df.withColumnRenamed("v", "failed_rules"), (expect_or_fail("x", "k IS NULL"),))


def test_layers_stop_before_the_checked_rows_and_the_reports(spark, tmp_path):
    strict = replace(DIAGNOSES, rules=(*DIAGNOSES.rules, expect_or_fail("known_code", "diagnosis_code <> 'none'")))
    flow = Layers(spark, f"{tmp_path}/source", f"{tmp_path}/tables", (ENCOUNTERS, strict, PROCEDURES), REPORTS)
    deliver(spark, flow.source, FIRST, "batch_000")
    flow.run()
    reports = {r.name: rows(flow.read(r.name)) for r in REPORTS}
    before = {name: flow.read(name).count() for name in ("silver_diagnoses", "gold_diagnoses_current")}
    deliver(spark, flow.source, SECOND, "batch_001")
    extra = [diagnosis("D8", "I", 4), diagnosis("D9", "I", 4, code="none")]
    spark.createDataFrame(extra, DIAGNOSIS).write.mode("append").parquet(f"{flow.source}/diagnoses")
    for _ in range(2):
        with pytest.raises(BatchRefused, match="known_code"):
            flow.run()
        assert {name: flow.read(name).count() for name in before} == before
        assert {r.name: rows(flow.read(r.name)) for r in REPORTS} == reports
        assert rows(flow.refused(strict), "diagnosis_id", "failed_rules") == [("D9", ["known_code"])]
    assert flow.read("bronze_diagnoses").count() == 9  # the raw layer is what has arrived
    flow.skip_refused = True
    flow.run()
    assert {name: flow.read(name).count() for name in before} == before
    assert flow.refused(strict).select("batch").distinct().count() == 1
    assert flow.read("gold_facility_summary").count() == 3  # the others went on
    failed = {r["rule"]: r["failed_rows"] for r in flow.quality(strict).collect()}
    assert failed["known_code"] == 1


def test_layers_apply_deletes_and_keep_history(spark, tmp_path):
    spec = replace(ENCOUNTERS, delete_when="cdc_operation = 'D'", keep_history=True)
    flow = Layers(spark, f"{tmp_path}/source", f"{tmp_path}/tables", (spec,))
    deliver(spark, flow.source, {"encounters": [encounter("E1", "D", 3, patient=None), encounter("E2", "I", 1)]}, "batch_000")
    flow.run()
    deliver(spark, flow.source, {"encounters": [encounter("E1", "I", 1, discharge=4), encounter("E2", "U", 2), encounter(None, "D", 9)]}, "batch_001")
    flow.run()
    assert rows(flow.read("gold_encounters_current"), "encounter_id", "cdc_timestamp") == [("E2", at(2))]
    past = rows(flow.read("gold_encounters_history"), "encounter_id", "valid_from", "valid_to", "length_of_stay_hours")
    assert past == sorted([("E1", at(1), at(3), 4.0), ("E2", at(1), at(2), None), ("E2", at(2), None, None)], key=repr)
    changes = flow.read("bronze_encounters")
    assert rows(current(changes, spec), "encounter_id") == [("E2",)]
    assert rows(checked(changes, spec), "encounter_id") == [("E1",), ("E2",), ("E2",)]
    for folders, table in ((flow.compact()[spec.current], flow.current_table(spec)), (flow.compact()[spec.history], flow.history_table(spec))):
        table.remove(folders)
    assert rows(flow.read("gold_encounters_history"), "encounter_id", "valid_from", "valid_to", "length_of_stay_hours") == past
    flow.publish()
    try:
        assert rows(spark.read.table(spec.history), "encounter_id", "valid_to") == [("E1", at(3)), ("E2", None), ("E2", at(2))]
        assert rows(spark.read.table(spec.current), "encounter_id") == [("E2",)]
    finally:
        for name in flow.datasets():
            spark.sql(f"DROP {'VIEW' if name in (spec.current, spec.history) else 'TABLE'} IF EXISTS {name}")
        for name in (spec.current, spec.history):
            spark.sql(f"DROP TABLE IF EXISTS {name}_rows")
