import os
import shutil

import pytest
from conftest import rows
from pyspark.sql import functions as F

from changeflow.operators import (
    CurrentTable,
    apply_rules,
    expect,
    expect_or_drop,
    latest_by_key,
    quality_history,
    quality_report,
)
from changeflow.operators.quality import observe_rules
from changeflow.sources import infer_schema, read_files, stream_files
from changeflow.streaming import append_stream, finish, upsert_stream

RULES = (expect_or_drop("has_key", "k IS NOT NULL"), expect("low", "v < 5"))


@pytest.fixture
def source(spark, tmp_path):
    """300 changes to 40 keys, in 6 files that are each spread over the whole time range."""
    changes = spark.range(300).select(
        F.when(F.col("id") % 11 != 0, (F.col("id") * 7 % 40).cast("string")).alias("k"),
        (F.col("id") * 13 % 97).alias("seq"),
        (F.col("id") % 10).alias("v"),
        (F.col("id") % 6).alias("file"),
    )
    changes.repartition(1).write.partitionBy("file").parquet(str(tmp_path / "in"))
    return str(tmp_path / "in")


def stream(spark, source, files=1):
    return stream_files(spark, source, infer_schema(spark, source), max_files_per_trigger=files)


def forget_last_batch(checkpoint):
    """Put the checkpoint in the state of a run that was lost before it could commit."""
    last = max(int(n) for n in os.listdir(f"{checkpoint}/commits") if n.isdigit())
    os.remove(f"{checkpoint}/commits/{last}")
    crc = f"{checkpoint}/commits/.{last}.crc"
    if os.path.exists(crc):
        os.remove(crc)


@pytest.mark.parametrize("layout", [(), ("v",)])
def test_append_is_exactly_once_across_restarts(spark, source, tmp_path, layout):
    path, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    finish([append_stream(stream(spark, source, 4), path, checkpoint, layout)])
    forget_last_batch(checkpoint)
    finish([append_stream(stream(spark, source, 4), path, checkpoint, layout)])
    finish([append_stream(stream(spark, source, 4), path, checkpoint, layout)])
    columns = ("k", "seq", "v")
    assert rows(read_files(spark, path), *columns) == rows(read_files(spark, source), *columns)


def test_append_replaces_the_leftovers_of_a_lost_batch(spark, source, tmp_path):
    path, checkpoint = f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    query = append_stream(stream(spark, source, 6), path, checkpoint, ("v",))
    finish([query])
    forget_last_batch(checkpoint)
    os.remove(f"{path}/{query.id}/000000000/_SUCCESS")
    finish([append_stream(stream(spark, source, 6), path, checkpoint, ("v",))])
    assert read_files(spark, path).count() == 300


def test_rows_of_a_batch_are_sorted(spark, source, tmp_path):
    finish([append_stream(stream(spark, source, 6), f"{tmp_path}/out", f"{tmp_path}/checkpoint", ("v", "seq"))])
    for folder, _, files in os.walk(f"{tmp_path}/out"):
        for file in files:
            if file.endswith(".parquet"):
                got = [(r.v, r.seq) for r in spark.read.parquet(f"{folder}/{file}").collect()]
                assert got == sorted(got)


def test_rules_on_a_stream_drop_and_count_as_on_a_batch(spark, source, tmp_path):
    path, checkpoint, counts = (f"{tmp_path}/{n}" for n in ("out", "checkpoint", "counts"))
    finish([append_stream(stream(spark, source), path, checkpoint, ("v",), RULES, counts)])
    changes = read_files(spark, source)
    columns = ("k", "seq", "v")
    assert rows(read_files(spark, path), *columns) == rows(apply_rules(changes, RULES), *columns)
    want = rows(quality_report(changes, RULES, "t"))
    assert rows(quality_history(spark, counts, RULES, "t")) == want
    forget_last_batch(checkpoint)
    finish([append_stream(stream(spark, source), path, checkpoint, ("v",), RULES, counts)])
    assert rows(quality_history(spark, counts, RULES, "t")) == want
    assert read_files(spark, path).count() == apply_rules(changes, RULES).count()


def test_counts_of_a_flow_that_has_not_run(spark, tmp_path):
    os.makedirs(tmp_path / "counts")
    report = quality_history(spark, str(tmp_path / "counts"), RULES, "t").collect()
    assert [(r["total_rows"], r["failed_rows"]) for r in report] == [(0, 0), (0, 0)]


def test_rules_may_have_any_name_but_that_of_the_total(spark, source, tmp_path):
    rules = (expect("a rule, with `marks`", "v < 5"), expect("select", "k IS NOT NULL"))
    counts = f"{tmp_path}/counts"
    assert [r["total_rows"] for r in quality_history(spark, counts, rules, "t").collect()] == [0, 0]
    finish([append_stream(stream(spark, source, 6), f"{tmp_path}/out", f"{tmp_path}/cp", (), rules, counts)])
    want = rows(quality_report(read_files(spark, source), rules, "t"))
    assert rows(quality_history(spark, counts, rules, "t")) == want
    assert rows(quality_history(spark, counts, rules, "t", True).drop("batch")) == want
    with pytest.raises(ValueError, match="total_rows"):
        expect("Total_Rows", "true")


def test_observed_rules_are_in_the_progress(spark, source, tmp_path):
    df = observe_rules(stream(spark, source, 6), RULES, "checks")
    query = append_stream(df, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    finish([query])
    seen = [p["observedMetrics"]["checks"] for p in query.recentProgress if p["numInputRows"]]
    assert [(m["total_rows"], m["has_key"], m["low"]) for m in seen] == [(300, 28, 150)]


def test_upsert_equals_batch_with_restart_and_replay(spark, source, tmp_path):
    table = CurrentTable(spark, f"{tmp_path}/t", ["k"], "seq")
    checkpoint = f"{tmp_path}/checkpoint"
    held = f"{tmp_path}/held"
    os.makedirs(held)
    for number in (1, 4):  # arrives later
        shutil.move(f"{source}/file={number}", f"{held}/file={number}")
    finish([upsert_stream(stream(spark, source), table, checkpoint)])
    forget_last_batch(checkpoint)
    for number in (1, 4):
        shutil.move(f"{held}/file={number}", f"{source}/file={number}")
    finish([upsert_stream(stream(spark, source, 3), table, checkpoint)])
    columns = ("k", "seq", "v")
    want = latest_by_key(read_files(spark, source).select(*columns), ["k"], "seq")
    assert rows(table.read(), *columns) == rows(want, *columns)


def test_a_lost_checkpoint_loses_no_rows(spark, source, tmp_path):
    table = CurrentTable(spark, f"{tmp_path}/t", ["k"], "seq")
    finish([upsert_stream(stream(spark, source, 6), table, f"{tmp_path}/first")])
    before = rows(table.read())
    spark.createDataFrame([("new", 1, 1)], "k string, seq long, v long").write.parquet(f"{source}/file=9")
    finish([upsert_stream(stream(spark, source, 6), table, f"{tmp_path}/second")])
    assert rows(table.read()) == sorted([*before, ("new", 1, 1)], key=repr)


def test_a_failing_flow_stops_the_others_and_raises(spark, source, tmp_path):
    bad = stream(spark, source).select(F.raise_error(F.lit("broken row")).alias("v"))
    good = stream(spark, source)
    queries = [
        append_stream(bad, f"{tmp_path}/bad", f"{tmp_path}/bad_checkpoint"),
        append_stream(good, f"{tmp_path}/good", f"{tmp_path}/good_checkpoint"),
    ]
    with pytest.raises(Exception, match="broken row"):
        finish(queries)
    assert not any(query.isActive for query in queries)


def test_rows_that_a_task_sorts_come_from_few_bytes_of_files(spark, tmp_path):
    from changeflow.session import SORTED_SPLIT, bounded_splits
    from changeflow.streaming import intake

    name, seen = "spark.sql.files.maxPartitionBytes", []
    before = spark.conf.get(name)
    spark.range(5).write.parquet(str(tmp_path / "source"))
    spark.conf.set(name, "128MB")
    try:
        with bounded_splits(spark):
            assert spark.conf.get(name) == str(SORTED_SPLIT)
        assert spark.conf.get(name) == "128MB"
        intake(
            spark, f"{tmp_path}/source", f"{tmp_path}/schema", f"{tmp_path}/raw", f"{tmp_path}/checkpoint", ("id",),
            lambda batch, _: seen.append((batch.sparkSession.conf.get(name), batch.count())),
        )
        assert seen == [(str(SORTED_SPLIT), 5)] and spark.conf.get(name) == "128MB"
        spark.conf.set(name, "1MB")
        with bounded_splits(spark):
            assert spark.conf.get(name) == "1MB"  # less stays
    finally:
        spark.conf.set(name, before)


def test_line_items_are_joined_last_in_the_feed_of_encounters(spark, tmp_path):
    from changeflow.sources.feeds import encounters_feed

    kinds = {
        "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_linestatus string,"
        " l_shipdate date, l_returnflag string, l_extendedprice double",
        "orders": "o_orderkey long, o_custkey long, o_orderpriority string, o_orderdate date",
        "customer": "c_custkey long, c_nationkey int",
    }
    for name, kind in kinds.items():
        spark.createDataFrame([], kind).write.parquet(f"{tmp_path}/{name}")
    feed = encounters_feed(lambda name: spark.read.parquet(f"{tmp_path}/{name}"))
    text = feed._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in text.split("\n") if "Join Inner" in line]
    assert len(joins) == 2 and "l_orderkey" in joins[0] and "c_custkey" in joins[1]
