"""Entities read from a table, and what is told of broken ones."""

import pytest
from conftest import rows

from changeflow.plans import SpecError, check_specs, checked, current, load_specs
from changeflow.plans.spec_table import SCHEMA

ONE = "SELECT 'orders' AS name, array('k') AS keys, 'seq' AS sequence_by"


def changes(spark):
    return spark.createDataFrame(
        [("a", 1, 5, "I"), ("a", 2, 50, "U"), ("b", 1, None, "I"), ("c", 1, 7, "D"), (None, 1, 1, "I")], "k string, seq int, v int, op string"
    )


def test_a_row_is_an_entity(spark):
    table = spark.sql(
        ONE + """, array("op <> 'D'") AS filters, array(struct('twice' AS name, 'v * 2' AS expression)) AS derived,
        array('op', 'nowhere') AS dropped, array(struct('keyed' AS name, 'k IS NOT NULL' AS predicate, 'drop' AS action)) AS rules"""
    )
    (spec,) = load_specs(table)
    check_specs((spec,), lambda name: changes(spark))
    assert rows(checked(changes(spark), spec)) == sorted([("a", 1, 5, 10), ("a", 2, 50, 100), ("b", 1, None, None)], key=repr)
    assert rows(current(changes(spark), spec), "k", "twice") == [("a", 100), ("b", None)]
    assert (spec.tie_break, spec.layout, spec.keep_history, spec.buckets) == (None, (), False, None)
    (plain,) = load_specs(spark.sql(ONE))
    assert checked(changes(spark), plain).count() == 5


def test_deletes_come_from_the_table_too(spark):
    (spec,) = load_specs(spark.sql(ONE + """, array("op <> 'D'") AS filters, "op = 'D'" AS delete_when"""))
    late = changes(spark).unionAll(spark.createDataFrame([("c", 0, 1, "I")], changes(spark).schema))
    assert rows(current(late, spec).filter("k IS NOT NULL"), "k") == [("a",), ("b",)]


def test_all_that_is_wrong_is_told(spark):
    bad = spark.sql(
        """SELECT 'a-b' AS name, array(CAST(NULL AS STRING)) AS keys, CAST(NULL AS STRING) AS sequence_by, array('v >') AS filters,
        array(struct('r' AS name, 'v > 1' AS predicate, 'stop' AS action), struct('r' AS name, 'v > 2' AS predicate, 'drop' AS action)) AS rules
        UNION ALL SELECT 'orders', array('k'), 'seq', NULL, NULL UNION ALL SELECT 'orders', array('k'), 'seq', NULL, NULL"""
    )
    with pytest.raises(SpecError) as told:
        load_specs(bad)
    text = str(told.value)
    for part in ("'a-b' is no name", "no keys", "no sequence", "unknown action stop", "'r' occurs twice", "'orders' occurs twice"):
        assert part in text
    assert load_specs(spark.createDataFrame([], SCHEMA)) == ()


@pytest.mark.parametrize("columns", [
    "array('nobody = 1') AS filters", "array('v >') AS filters", "array(struct('x' AS name, 'v >' AS predicate, 'drop' AS action)) AS rules",
    "array(struct('x' AS name, 'max(v) OVER ()' AS predicate, 'drop' AS action)) AS rules",
    "array(struct('x' AS name, 'sum(v) > 1' AS predicate, 'drop' AS action)) AS rules", "'v + 1' AS delete_when",
    "array(struct('x' AS name, 'nobody' AS expression)) AS derived", "array('nobody') AS layout",
])
def test_expressions_are_held_against_the_changes(spark, columns):
    specs = load_specs(spark.sql(f"{ONE}, {columns}"))
    with pytest.raises(SpecError, match="orders"):
        check_specs(specs, lambda name: changes(spark))
