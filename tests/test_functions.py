from datetime import datetime, timedelta

import pytest
from conftest import rows
from pyspark.sql import functions as F

from changeflow.functions import (
    count_where,
    day_bucket,
    elapsed_hours,
    flag_equals,
    in_order,
    matches,
    not_null,
    one_of,
)
from changeflow.plans.clinical import ICD10_PATTERN

START = datetime(2026, 3, 1, 6)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_elapsed_hours(spark, kind):
    ends = {
        "half_up": START + timedelta(seconds=180),
        "negative_half": START - timedelta(seconds=900),
        "whole": START + timedelta(hours=5),
        "fraction_of_second": START + timedelta(seconds=3600, microseconds=999_999),
        "open": None,
    }
    df = spark.createDataFrame([(k, START, v) for k, v in ends.items()], "k string, a timestamp, b timestamp")
    df = df.withColumns({"a": F.col("a").cast(kind), "b": F.col("b").cast(kind)})
    got = {r.k: r.h for r in df.select("k", elapsed_hours("a", "b").alias("h")).collect()}
    assert got == {
        "half_up": 0.1,
        "negative_half": -0.3,
        "whole": 5.0,
        "fraction_of_second": 1.0,
        "open": None,
    }


def test_elapsed_hours_without_start_is_null(spark):
    df = spark.createDataFrame([(None, START)], "a timestamp, b timestamp")
    assert df.select(elapsed_hours("a", "b")).first()[0] is None


def test_flag_equals_keeps_null(spark):
    df = spark.createDataFrame([("EMERGENCY",), ("INPATIENT",), (None,)], "t string")
    assert [r[0] for r in df.select(flag_equals("t", "EMERGENCY")).collect()] == [True, False, None]


def test_day_bucket_follows_the_session_zone(spark):
    df = spark.range(1).select(F.timestamp_seconds(F.lit(1772326800)).alias("t"))  # 2026-03-01 01:00 UTC
    try:
        assert str(df.select(day_bucket("t")).first()[0]) == "2026-03-01"
        spark.conf.set("spark.sql.session.timeZone", "America/Denver")
        assert str(df.select(day_bucket("t")).first()[0]) == "2026-02-28"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_count_where_ignores_null(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "f boolean")
    assert df.agg(count_where(F.col("f"))).first()[0] == 1


def test_code_pattern(spark):
    codes = ["I10", "G43.909", "I10.", "i10", "I10.12345", "I10\n", None]
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    got = [r[0] for r in df.select(F.expr(matches("code", ICD10_PATTERN))).collect()]
    assert got == [True, True, False, False, False, True, None]


def test_in_order(spark):
    later = START + timedelta(hours=1)
    data = [(START, None), (START, later), (START, START), (later, START), (None, START), (None, None)]
    df = spark.createDataFrame(data, "a timestamp, b timestamp")
    got = [r[0] for r in df.select(F.expr(in_order("a", "b"))).collect()]
    assert got == [True, True, True, False, None, True]


def test_one_of_and_not_null_quote_their_values(spark):
    df = spark.createDataFrame([("it's",), ("a\\b",), ("x",), (None,)], "s string")
    assert rows(df.filter(one_of("s", ("it's", "a\\b")))) == sorted([("it's",), ("a\\b",)], key=repr)
    assert df.filter(not_null("s")).count() == 3
    assert one_of("n", (1, 2.5, True)) == "n IN (1, 2.5, true)"
