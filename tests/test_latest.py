from conftest import rows

from changeflow.operators import latest_by_key

SCHEMA = "k string, seq int, a int, b string"


def test_greatest_sequence_wins_whole_row(spark):
    df = spark.createDataFrame([("x", 1, 1, "old"), ("x", 3, None, None), ("y", 2, 5, "only")], SCHEMA)
    assert rows(latest_by_key(df, ["k"], "seq")) == [("x", 3, None, None), ("y", 2, 5, "only")]


def test_null_sequence_loses_but_keeps_its_key(spark):
    df = spark.createDataFrame([("x", None, 9, "n"), ("x", 1, 1, "v"), ("y", None, 2, "n")], SCHEMA)
    assert rows(latest_by_key(df, ["k"], "seq")) == [("x", 1, 1, "v"), ("y", None, 2, "n")]


def test_ties_do_not_depend_on_order(spark):
    data = [("x", 1, 1, "a"), ("x", 1, 2, "a"), ("x", 1, 2, None)]
    for order in (data, data[::-1]):
        df = spark.createDataFrame(order, SCHEMA)
        assert rows(latest_by_key(df, ["k"], "seq")) == [("x", 1, 2, "a")]
        assert rows(latest_by_key(df.coalesce(1), ["k"], "seq", ["a"]), "a") == [(2,)]


def test_columns_without_an_order_are_carried_along(spark):
    df = spark.createDataFrame([("x", 1, {"m": 1}), ("x", 2, {"m": 2})], "k string, seq int, m map<string,int>")
    assert latest_by_key(df, ["k"], "seq").first()["m"] == {"m": 2}


def test_several_keys_and_null_keys(spark):
    df = spark.createDataFrame([("x", 1, 1, "a"), ("x", 2, 2, "a"), (None, 1, 7, None), (None, 2, 7, None)], SCHEMA)
    assert rows(latest_by_key(df, ["k", "a"], "seq"), "k", "seq", "a") == sorted(
        [("x", 1, 1), ("x", 2, 2), (None, 2, 7)], key=repr
    )


def test_one_shuffle_with_rows_reduced_before_it(spark, plan, tmp_path):
    spark.range(100).selectExpr("cast(id % 3 as string) k", "cast(id as int) seq", "1 a", "'b' b").write.parquet(
        str(tmp_path / "t")
    )
    df = spark.read.parquet(str(tmp_path / "t"))
    text = plan(latest_by_key(df, ["k"], "seq", []))
    assert text.count("Exchange hashpartitioning") == 1
    before_shuffle = text.split("Exchange hashpartitioning")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_columns_nobody_asks_for_are_not_read(spark, plan, tmp_path):
    spark.range(9).selectExpr("id k", "id seq", "id a", "id b").write.parquet(str(tmp_path / "t"))
    text = plan(latest_by_key(spark.read.parquet(str(tmp_path / "t")), ["k"], "seq", []).select("k", "a"))
    assert "ReadSchema: struct<k:bigint,seq:bigint,a:bigint>" in text
