"""The history table beside a plain version of the same."""

import os
from collections import defaultdict

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from changeflow.operators import HistoryTable, with_next
from changeflow.operators.history import sequence_cuts

SCHEMA = "k string, seq int, v int, op string"


def table(spark, path, **more):
    return HistoryTable(spark, str(path), ["k"], "seq", delete_when="op = 'D'", **more)


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def intervals(log):
    """(k, seq, v, op, from, to, current) of all changes that are no deletes."""
    best = {}
    for k, seq, v, op in log:
        rank = (op == "D", op is not None, op or "", v is not None, v or 0)
        if (k, seq) not in best or rank > best[k, seq][0]:
            best[k, seq] = (rank, (k, seq, v, op))
    by_key = defaultdict(list)
    for (k, seq), (_, row) in best.items():
        by_key[k].append(((seq is not None, seq or 0), row))
    out = []
    for own in by_key.values():
        own = [row for _, row in sorted(own, key=lambda at: at[0])]
        for row, after in zip(own, [*own[1:], None], strict=True):
            to = after[1] if after else None
            if row[3] != "D":
                out.append((*row, row[1], to, to is None))
    return sorted(out, key=repr)


def test_a_late_change_splits_an_interval_of_an_earlier_batch(spark, tmp_path):
    t = table(spark, tmp_path)
    t.apply(frame(spark, [("x", 1, 1, "I"), ("x", 9, 9, "U"), ("y", 2, 2, "I")]))
    t.apply(frame(spark, [("x", 5, 5, "U")]))
    assert rows(t.read(), "k", "v", "valid_from", "valid_to", "is_current") == [
        ("x", 1, 1, 5, False), ("x", 5, 5, 9, False), ("x", 9, 9, None, True), ("y", 2, 2, None, True)
    ]
    assert rows(t.as_of(5), "k", "v") == [("x", 5), ("y", 2)]
    assert rows(t.as_of(4), "k", "v") == [("x", 1), ("y", 2)]
    assert rows(t.as_of(0), "k", "v") == []


def test_a_delete_ends_an_interval_and_is_none(spark, tmp_path):
    t = table(spark, tmp_path)
    t.apply(frame(spark, [("x", 5, None, "D")]))
    t.apply(frame(spark, [("x", 1, 1, "I"), ("x", 8, 8, "I")]))
    assert rows(t.read(), "k", "v", "valid_from", "valid_to") == [("x", 1, 1, 5), ("x", 8, 8, None)]
    assert rows(t.as_of(6)) == []


def test_a_batch_writes_rows_of_its_keys_only(spark, tmp_path):
    t = table(spark, tmp_path)
    t.apply(frame(spark, [(str(i), s, i, "I") for i in range(500) for s in (1, 5)]))
    before = {f: os.path.getmtime(f.removeprefix("file:")) for f in map(str, tmp_path.rglob("*.parquet"))}
    t.apply(frame(spark, [("7", 3, -7, "U"), ("9", 6, -9, "U")]))
    new = [f for f in map(str, tmp_path.rglob("*.parquet")) if f not in before]
    written = spark.read.schema(t.schema()).parquet(*new)
    # the change and the interval before it, which ends earlier now; 5 of key 7 is as it was
    assert rows(written, "k", "seq", "valid_to") == [("7", 1, 3), ("7", 3, 5), ("9", 5, 6), ("9", 6, None)]
    assert all(os.path.getmtime(f) == m for f, m in before.items())
    t.apply(frame(spark, [("7", 3, -7, "U"), ("9", 6, -9, "U")]))
    assert t.appended().count() == 1004 and t.read().count() == 1002  # again: nothing to write


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.data())
def test_any_split_order_and_replay_gives_the_same_intervals(spark, tmp_path_factory, data):
    change = st.tuples(
        st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 8)), st.integers(0, 2), st.sampled_from(["I", "U", "D", None])
    )
    log = data.draw(st.lists(change, min_size=1, max_size=25))
    cuts = sorted(data.draw(st.lists(st.integers(0, len(log)), max_size=2)))
    batches = [log[a:b] for a, b in zip([0, *cuts], [*cuts, len(log)])]
    batches = data.draw(st.permutations(batches))
    if data.draw(st.booleans()):
        batches = [*batches, batches[0]]
    t = table(spark, tmp_path_factory.mktemp("t")).create(frame(spark, [], SCHEMA).schema)
    compact_after = data.draw(st.integers(0, len(batches)))
    for number, batch in enumerate(batches):
        t.apply(frame(spark, batch))
        if number == compact_after:
            old = t.compact()
            if data.draw(st.booleans()):
                t.remove(old)
    assert rows(t.read()) == intervals(log)
    t.appended().createOrReplaceTempView("rows_of_history")
    assert rows(spark.sql(t.select_sql("rows_of_history")).select(*t.read().columns)) == intervals(log)


def test_next_value_of_a_hot_key_is_found_slice_by_slice(spark):
    log = [("hot", i) for i in range(0, 3000, 3)] + [(f"k{i}", i) for i in range(200)] + [("hot", None), (None, 1), (None, 7)]
    df = frame(spark, log, "k string, seq int")
    cuts = sequence_cuts(df, "seq", 8)
    assert len(cuts) == 7
    got = with_next(df, ["k"], "seq", "next", cuts)
    want = [("hot", i, i + 3 if i < 2997 else None) for i in range(0, 3000, 3)] + [(f"k{i}", i, None) for i in range(200)]
    want += [("hot", None, 0), (None, 1, 7), (None, 7, None)]
    assert rows(got, "k", "seq", "next") == sorted(want, key=repr)
    assert rows(with_next(df, ["k"], "seq", "next")) == rows(got)
    sizes = got.filter("k = 'hot'").groupBy(F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("seq")))).count()
    assert max(r["count"] for r in sizes.collect()) < 300  # of the hot key no slice has many
    texts = frame(spark, [("a", "x"), ("a", "y"), ("b", "z")], "k string, seq string")
    assert sequence_cuts(texts, "seq") == []
    assert rows(with_next(texts, ["k"], "seq", "next"), "seq", "next") == [("x", "y"), ("y", None), ("z", None)]


def test_sequences_in_time(spark, tmp_path):
    t = HistoryTable(spark, str(tmp_path), ["k"], "ts")
    for day in (3, 1, 2):
        t.apply(spark.sql(f"SELECT 'x' AS k, timestamp_ntz '2024-03-0{day} 01:00:00' AS ts, {day} AS v"))
    got = t.read().select("v", F.date_format("valid_to", "dd").alias("to"))
    assert rows(got) == [(1, "02"), (2, "03"), (3, None)]


def test_new_columns_and_clashing_ones(spark, tmp_path):
    t = table(spark, tmp_path)
    t.apply(frame(spark, [("x", 1, 1, "I")]))
    t.apply(frame(spark, [("x", 2, 2, "I", "new")], SCHEMA + ", w string"))
    assert rows(t.read(), "v", "w", "valid_to") == [(1, None, 2), (2, "new", None)]
    with pytest.raises(ValueError, match="valid_to"):
        t.apply(frame(spark, [("x", 1, 1, "I", 3)], SCHEMA + ", valid_to int"))
    with pytest.raises(LookupError):
        table(spark, tmp_path / "none").read()
    empty = table(spark, tmp_path / "empty").create(frame(spark, []).schema)
    empty.apply(frame(spark, []))
    assert rows(empty.read()) == []


def shuffled(df):
    """The shuffles of rows in a plan, before they run."""
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.split("\n") if "Exchange hashpartitioning" in line]


def test_rows_are_put_in_order_with_one_shuffle(spark):
    df = frame(spark, [(f"k{i % 50}", i, i, "I") for i in range(500)])
    assert len(shuffled(with_next(df, ["k"], "seq", "next", [100, 300], F.lit(False), lambda each, by: each))) <= 4
    plain = with_next(df, ["k"], "seq", "next", [], F.lit(False))
    assert len(shuffled(plain)) == 1
    for cuts, sliced in (([100, 300], F.col("k") == "k7"), ([100, 300], None), ([], None)):
        assert rows(with_next(df, ["k"], "seq", "next", cuts, sliced)) == rows(plain)


def test_a_single_folder_of_a_history_is_read_without_a_shuffle(spark, tmp_path):
    t = table(spark, tmp_path)
    t.apply(frame(spark, [("x", 1, 1, "I"), ("x", 1, 2, "I"), ("x", 9, 9, "U"), (None, None, 2, "I")]))
    assert not shuffled(t.read())
    assert rows(t.read(), "k", "v", "valid_to") == [("x", 2, 9), ("x", 9, None), (None, 2, None)]
    t.apply(frame(spark, [("x", 5, 5, "U")]))
    assert len(shuffled(t.read())) == 1
    t.remove(t.compact())
    assert not shuffled(t.read())


@pytest.mark.parametrize("few", [0, 100_000])
def test_batches_with_and_without_their_keys_sent_to_all_tasks_agree(spark, tmp_path, monkeypatch, few):
    from changeflow.operators import history

    monkeypatch.setattr(history, "FEW", few)
    monkeypatch.setattr(history, "HOT", 2)
    log = [(k, seq, 10 * i, op) for i, (seq, op) in enumerate([(5, "I"), (9, "U"), (7, "D"), (None, "I"), (1, "I")]) for k in ("x", "y", None)]
    t = table(spark, tmp_path)
    for batch in (log[6:9], log[:3], log[12:], log[3:6], log[9:12], log[:3]):
        t.apply(frame(spark, batch))
    assert rows(t.read()) == intervals(log)
    before = t.appended().count()
    t.apply(frame(spark, [("z", 3, 3, "I")]))
    assert t.appended().count() == before + 1  # keys without a change are not written again
