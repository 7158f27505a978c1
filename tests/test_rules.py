import pytest
from conftest import rows
from pyspark.sql import Observation

from changeflow.operators import (
    Rule,
    apply_rules,
    drop_deletes,
    drop_rescued,
    expect,
    expect_or_drop,
    keep_active,
    observe_rules,
    quality_report,
)

RULES = (
    expect_or_drop("has_id", "id IS NOT NULL"),
    expect_or_drop("positive", "n > 0"),
    expect("small", "n < 10"),
)


@pytest.fixture
def data(spark):
    return spark.createDataFrame(
        [("a", 1), ("b", 20), (None, 1), (None, -1), ("c", None), ("d", 0)], "id string, n int"
    )


def test_drop_deletes_also_drops_null_operations(spark):
    df = spark.createDataFrame([("I",), ("U",), ("D",), (None,)], "cdc_operation string")
    assert rows(drop_deletes(df)) == [("I",), ("U",)]


def test_keep_active_drops_false_and_null(spark):
    df = spark.createDataFrame([(1, True), (2, False), (3, None)], "i int, is_active boolean")
    assert rows(keep_active(df), "i") == [(1,)]


def test_drop_rescued_is_silent_without_the_column(spark):
    df = spark.createDataFrame([(1, "x")], "i int, _rescued_data string")
    assert drop_rescued(df).columns == ["i"]
    assert drop_rescued(drop_rescued(df)).columns == ["i"]


def test_drop_rules_drop_false_and_null_and_warn_rules_keep(data):
    assert rows(apply_rules(data, RULES)) == [("a", 1), ("b", 20)]


def test_counts_do_not_depend_on_order_and_null_fails(data):
    want = {"has_id": 2, "positive": 3, "small": 2}
    for rules in (RULES, RULES[::-1]):
        report = quality_report(data, rules, "t").collect()
        assert {r["rule"]: r["failed_rows"] for r in report} == want
        assert all(r["total_rows"] == 6 == r["passed_rows"] + r["failed_rows"] for r in report)
        assert {r["rule"]: r["action"] for r in report} == {x.name: x.action for x in rules}
        assert {r["rule"]: r["failed_pct"] for r in report}["positive"] == 50.0


def test_report_on_no_rows(data):
    report = quality_report(data.filter("false"), RULES, "t").collect()
    assert [(r["total_rows"], r["failed_rows"], r["failed_pct"]) for r in report] == [(0, 0, None)] * 3


def test_kept_and_dropped_add_up(data):
    seen = Observation()
    kept = apply_rules(observe_rules(data, RULES, seen), RULES).count()
    dropped = data.filter("NOT coalesce(id IS NOT NULL AND n > 0, false)").count()
    assert seen.get["total_rows"] == kept + dropped == 6
    assert (seen.get["has_id"], seen.get["positive"], seen.get["small"]) == (2, 3, 2)


def test_unknown_action_is_refused():
    with pytest.raises(ValueError, match="unknown action"):
        Rule("r", "true", "ignore")


def test_drop_rules_reach_the_parquet_scan(spark, data, plan, tmp_path):
    data.write.parquet(str(tmp_path / "t"))
    text = plan(apply_rules(spark.read.parquet(str(tmp_path / "t")), RULES))
    assert "IsNotNull(id)" in text and "GreaterThan(n,0)" in text.split("PushedFilters")[1]
