"""Values that do not fit their column's tracked type."""

import pytest
from conftest import rows
from pyspark.sql import types as T

from changeflow.sources import read_files
from changeflow.sources.rescue import fit, schema_groups
from changeflow.sources.schema import starting_schema, stored_schema
from changeflow.streaming import intake

KNOWN = "a int, b string, c timestamp_ntz, d double, e struct<x:int>, f decimal(6,2), g date, h boolean"


def test_values_that_fit_and_others(spark):
    df = spark.sql(
        """SELECT * FROM VALUES
        (1.0D, 7, '2024-03-01 10:00:00', '1.5', 'x', 1.25D, timestamp_ntz '2024-03-01 00:00:00', 'true'),
        (1.5D, null, 'never', 'NaN?', null, 1.255D, timestamp_ntz '2024-03-01 08:00:00', 'maybe'),
        (null, -1, null, null, null, null, null, null) AS t(a, b, c, d, e, f, g, h)"""
    )
    known = T.StructType.fromDDL(KNOWN)
    got = fit(df, known).collect()
    assert fit(df, known).drop("_rescued_data").schema == known
    one, two, three = got
    assert (one["a"], one["b"], str(one["c"]), one["d"], one["e"], str(one["f"]), str(one["g"]), one["h"]) == (
        1, "7", "2024-03-01 10:00:00", 1.5, None, "1.25", "2024-03-01", True
    )
    assert one["_rescued_data"] == '{"e":"x"}'
    assert [two[c] for c in "acdfgh"] == [None] * 6
    assert two["_rescued_data"] == (
        '{"a":1.5,"c":"never","d":"NaN?","f":1.255,"g":"2024-03-01T08:00:00.000","h":"maybe"}'
    )
    assert three["_rescued_data"] is None and three["b"] == "-1"


def test_a_rescue_column_of_the_source(spark):
    df = spark.createDataFrame([("1", "own"), ("x", "own"), ("x", None)], "a string, _rescued_data string")
    got = rows(fit(df, T.StructType.fromDDL("a int, z int")), "a", "z", "_rescued_data")
    assert got == sorted([(1, None, "own"), (None, None, '{"a":"x","_rescued_data":"own"}'), (None, None, '{"a":"x"}')], key=repr)


def test_files_are_grouped_by_schema(spark, tmp_path):
    frames = {"a": "1 AS k, 'x' AS v", "b": "'2' AS k", "c": "3 AS k, 1.5D AS w", "d": "'4' AS k, 'y' AS v"}
    files = []
    for name, columns in frames.items():
        spark.sql(f"SELECT {columns}").coalesce(1).write.parquet(f"{tmp_path}/{name}")
        files += spark.read.parquet(f"{tmp_path}/{name}").inputFiles()
    groups = schema_groups(spark, files)
    told = sorted((schema.simpleString(), sorted(f.split("/")[-2] for f in own)) for schema, own in groups)
    assert told == [("struct<k:int,v:string,w:double>", ["a", "c"]), ("struct<k:string,v:string>", ["b", "d"])]
    assert schema_groups(spark, []) == []
    with pytest.raises(Exception, match="(?i)nowhere"):
        schema_groups(spark, [f"{tmp_path}/nowhere"])


def take_in(spark, root, seen):
    intake(
        spark, f"{root}/source", f"{root}/schemas", f"{root}/raw", f"{root}/checkpoint", (), lambda rows, name: seen.append(name), 100
    )
    return read_files(spark, f"{root}/raw", stored_schema(spark, f"{root}/schemas"))


def test_a_start_whose_files_disagree(spark, tmp_path):
    for name, columns in (("a", "1 AS k"), ("b", "'2' AS k, 'n' AS v"), ("c", "'three' AS k")):
        spark.sql(f"SELECT {columns}").write.parquet(f"{tmp_path}/source/{name}")
    start = starting_schema(spark, f"{tmp_path}/source", f"{tmp_path}/other")
    assert start.names[0] == "k"
    seen = []
    got = take_in(spark, tmp_path, seen)
    kind = got.schema["k"].dataType
    want = ["1", "2", "three"] if isinstance(kind, T.StringType) else [1, 2, None]
    assert sorted([r["k"] for r in got.collect()], key=str) == sorted(want, key=str)
    assert [r["v"] for r in got.filter("v IS NOT NULL").collect()] == ["n"]
    assert len(seen) == 1  # no batch is delivered twice
    assert take_in(spark, tmp_path, seen).count() == 3 and len(seen) == 1


def test_a_column_that_two_new_files_type_differently(spark, tmp_path):
    spark.sql("SELECT 1 AS k").write.parquet(f"{tmp_path}/source/a")
    seen = []
    take_in(spark, tmp_path, seen)
    spark.sql("SELECT 2 AS k, 5 AS n").write.parquet(f"{tmp_path}/source/b")
    spark.sql("SELECT 3 AS k, 'many' AS n").write.parquet(f"{tmp_path}/source/c")
    got = take_in(spark, tmp_path, seen)
    if isinstance(got.schema["n"].dataType, T.StringType):
        assert rows(got, "k", "n") == [(1, None), (2, "5"), (3, "many")]
    else:
        assert rows(got, "k", "n", "_rescued_data") == [(1, None, None), (2, 5, None), (3, None, '{"n":"many"}')]
    assert len(seen) == 2


def test_a_large_first_run_is_cut_into_batches(spark, tmp_path, monkeypatch):
    """The driver gets the names of one batch at a time, and no rows of the files."""
    for number in range(5):
        spark.range(number, number + 2).selectExpr("id AS k").coalesce(1).write.parquet(f"{tmp_path}/source/{number}")
    from changeflow.streaming import flows

    seen, real = [], flows._as_tracked
    monkeypatch.setattr(flows, "_as_tracked", lambda spark, files, schemas: (seen.append(len(files)), real(spark, files, schemas))[1])
    intake(spark, f"{tmp_path}/source", f"{tmp_path}/schemas", f"{tmp_path}/raw", f"{tmp_path}/checkpoint", (), lambda rows, name: None, 2)
    assert sorted(seen) == [1, 2, 2] and flows.MOST_FILES == 10_000
    assert read_files(spark, f"{tmp_path}/raw", stored_schema(spark, f"{tmp_path}/schemas")).count() == 10
