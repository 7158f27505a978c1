import os

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from changeflow.operators import CurrentTable, latest_by_key

SCHEMA = "k string, seq int, v int"


def table(spark, path, **more):
    return CurrentTable(spark, str(path), ["k"], "seq", **more)


def frame(spark, data, schema=SCHEMA):
    return spark.createDataFrame(data, schema)


def test_late_change_does_not_overwrite(spark, tmp_path):
    t = table(spark, tmp_path)
    t.apply(frame(spark, [("x", 5, 1), ("y", 1, 1)]))
    t.apply(frame(spark, [("x", 3, 2), ("y", 2, 2), ("z", 1, 2)]))
    assert rows(t.read()) == [("x", 5, 1), ("y", 2, 2), ("z", 1, 2)]


def test_replay_changes_nothing(spark, tmp_path):
    t = table(spark, tmp_path)
    batch = frame(spark, [("x", 5, 1), ("x", 6, 2), ("y", None, 1)])
    t.apply(batch)
    once = rows(t.read())
    t.apply(batch)
    assert rows(t.read()) == once == [("x", 6, 2), ("y", None, 1)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.data())
def test_any_split_order_and_replay_gives_the_latest_rows(spark, tmp_path_factory, data):
    change = st.tuples(
        st.sampled_from(["a", "b", "c", "d", "e", None]),
        st.one_of(st.none(), st.integers(0, 5)),
        st.integers(0, 3),
    )
    log = data.draw(st.lists(change, min_size=1, max_size=25))
    cuts = sorted(data.draw(st.lists(st.integers(0, len(log)), max_size=2)))
    batches = [log[a:b] for a, b in zip([0, *cuts], [*cuts, len(log)])]
    batches = data.draw(st.permutations(batches))
    if data.draw(st.booleans()):
        batches = [*batches, batches[0]]
    t = table(spark, tmp_path_factory.mktemp("t")).create(frame(spark, [], SCHEMA).schema)
    for batch in batches:
        t.apply(frame(spark, batch))
    assert rows(t.read()) == rows(latest_by_key(frame(spark, log), ["k"], "seq"))


WIDE = "k string, a string, seq int, z string, v int"


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.data())
def test_column_sets_and_order_of_arrival_do_not_matter(spark, tmp_path_factory, data):
    """Batches have different columns in different places, and almost all rows are tied."""
    value = st.one_of(st.none(), st.sampled_from(["p", "q"]))
    change = st.tuples(st.sampled_from("xy"), value, st.integers(0, 1), value, st.integers(0, 2))
    logs = data.draw(st.lists(st.lists(change, min_size=1, max_size=6), min_size=2, max_size=3))
    columns = [data.draw(st.permutations(["k", "seq", *kept])) for kept in data.draw(
        st.lists(st.lists(st.sampled_from(["a", "z", "v"]), unique=True), min_size=len(logs), max_size=len(logs)))]
    batches = [frame(spark, log, WIDE).select(*names) for log, names in zip(logs, columns)]
    whole = frame(spark, [], WIDE)
    for batch in batches:
        whole = whole.unionByName(batch, allowMissingColumns=True)
    want = rows(latest_by_key(whole, ["k"], "seq"), *whole.columns)
    for order in (batches, batches[::-1]):
        t = table(spark, tmp_path_factory.mktemp("t")).create(whole.schema)
        for batch in order:
            t.apply(batch)
        assert rows(t.read(), *whole.columns) == want


def test_a_new_column_before_others_decides_ties_alike(spark, tmp_path):
    old, new = frame(spark, [("x", 1, 1, 0)], "k string, seq int, x int, c int"), frame(spark, [("x", 1, 2, 9)], "k string, seq int, c int, x int")
    for name, batches in (("a", (old.drop("c"), new)), ("b", (new, old.drop("c"))), ("c", (old.drop("c").unionByName(new, True),))):
        t = table(spark, tmp_path / name)
        for batch in batches:
            t.apply(batch)
        assert rows(t.read(), "k", "c", "x") == [("x", 2, 9)]


def test_maps_decide_ties_by_their_entries(spark, tmp_path):
    one, two = (frame(spark, [("x", 1, m)], "k string, seq int, m map<string,int>") for m in ({"a": 1}, {"a": 2}))
    for name, batches in (("a", (one, two)), ("b", (two, one))):
        t = table(spark, tmp_path / name)
        for batch in batches:
            t.apply(batch)
        assert t.read().first()["m"] == {"a": 2}


def test_a_column_without_any_order_needs_a_tie_break(spark):
    df = frame(spark, [("x", 1, [{"a": 1}])], "k string, seq int, m array<map<string,int>>")
    with pytest.raises(ValueError, match="tie-break"):
        latest_by_key(df, ["k"], "seq")
    assert latest_by_key(df, ["k"], "seq", []).count() == 1


def test_a_batch_writes_its_own_rows_only(spark, tmp_path, plan):
    t = table(spark, tmp_path)
    t.apply(frame(spark, [(str(i), 1, i) for i in range(5000)]))
    before = {f: os.path.getmtime(f) for f in t.appended().inputFiles() if os.path.exists(f)}
    t.apply(frame(spark, [("7", 2, -7), ("7", 1, 0)]))
    assert t.appended().count() == 5001 and t.read().count() == 5000
    assert all(os.path.getmtime(f) == m for f, m in before.items())
    assert t.read().filter("k = '7'").first()["v"] == -7
    text = plan(latest_by_key(t.appended(), ["k"], "seq"))
    assert text.count("Exchange hashpartitioning") == 1


def test_readers_see_nothing_of_a_batch_that_failed(spark, tmp_path):
    t = table(spark, tmp_path)
    t.apply(frame(spark, [("x", 1, 1)]))
    bad = frame(spark, [("x", 2, 2)]).selectExpr("k", "seq", "if(seq = 2, cast(raise_error('gone') as int), v) v")
    with pytest.raises(Exception, match="gone"):
        t.apply(bad)
    assert rows(t.read()) == [("x", 1, 1)]


def test_compaction_changes_nothing_but_files(spark, tmp_path):
    t = table(spark, tmp_path, cluster_by=["v"])
    for seq in range(1, 5):
        t.apply(frame(spark, [(str(i), seq, i) for i in range(0, 40, seq)]))
    want = rows(t.read())
    old = t.compact()
    assert len(old) == 4 and rows(t.read()) == want  # base and batches are read together
    t.remove(old)
    assert rows(t.read()) == want and t.appended().count() == 40
    t.apply(frame(spark, [("0", 9, 9)]))
    assert t.read().count() == 40 and t.read().filter("k = '0'").first()["seq"] == 9


def test_the_view_is_the_table(spark, tmp_path):
    t = table(spark, tmp_path)
    t.apply(frame(spark, [("x", 1, 1), ("x", None, 5), ("y", 2, 1), ("y", 2, None)]))
    t.appended().createOrReplaceTempView("rows_of_t")
    assert rows(spark.sql(t.select_sql("rows_of_t"))) == rows(t.read())


def test_new_columns_are_added_and_old_batches_still_fit(spark, tmp_path):
    t = table(spark, tmp_path)
    t.apply(frame(spark, [("x", 1, 1), ("y", 1, 1)]))
    t.apply(frame(spark, [("x", 2, 2, "new")], SCHEMA + ", w string"))
    t.apply(frame(spark, [("z", 1, 1)]))
    assert rows(t.read()) == [("x", 2, 2, "new"), ("y", 1, 1, None), ("z", 1, 1, None)]


def test_empty_table_and_empty_batch(spark, tmp_path):
    t = table(spark, tmp_path)
    with pytest.raises(LookupError):
        t.read()
    t.create(frame(spark, [], SCHEMA).schema)
    assert t.read().columns == ["k", "seq", "v"] and t.read().count() == 0
    t.apply(frame(spark, [("x", 1, 1)]))
    t.apply(frame(spark, [], SCHEMA))
    assert rows(t.read()) == [("x", 1, 1)]


# -- deletes ------------------------------------------------------------------------------

OPS = SCHEMA + ", op string"


def deleting(spark, path, **more):
    return table(spark, path, delete_when="op = 'D'", **more)


def test_a_late_older_change_does_not_bring_a_key_back(spark, tmp_path):
    t = deleting(spark, tmp_path)
    t.apply(frame(spark, [("x", 1, 1, "I"), ("y", 1, 1, None)], OPS))
    t.apply(frame(spark, [("x", 5, None, "D")], OPS))
    t.apply(frame(spark, [("x", 3, 3, "U")], OPS))
    assert rows(t.read(), "k", "seq") == [("y", 1)]
    t.apply(frame(spark, [("x", 6, 6, "I")], OPS))
    assert rows(t.read(), "k", "seq", "v") == [("x", 6, 6), ("y", 1, 1)]
    assert t.read().columns == ["k", "seq", "v", "op"]


def test_a_delete_wins_a_tie(spark, tmp_path):
    for name, tie_break in (("a", None), ("b", ["v"])):
        t = deleting(spark, tmp_path / name, tie_break=tie_break)
        t.apply(frame(spark, [("x", 1, 1, "I"), ("x", 1, 1, "D"), ("y", 1, 2, "I"), ("y", 1, 1, "D")], OPS))
        assert rows(t.read(), "k") == ([] if tie_break is None else [("y",)])


def model(log):
    """What stands: per key the greatest of (sequence, deletes last, other columns)."""
    best = {}
    for k, seq, v, op in log:
        rank = ((seq is not None, seq or 0), op == "D", (op is not None, op or ""), (v is not None, v or 0))
        if k not in best or rank > best[k][0]:
            best[k] = (rank, (k, seq, v, op))
    return sorted((row for _, row in best.values() if row[3] != "D"), key=repr)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.data())
def test_any_split_order_and_replay_with_deletes_agree(spark, tmp_path_factory, data):
    change = st.tuples(
        st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 2), st.sampled_from(["I", "U", "D", None])
    )
    log = data.draw(st.lists(change, min_size=1, max_size=25))
    cuts = sorted(data.draw(st.lists(st.integers(0, len(log)), max_size=2)))
    batches = data.draw(st.permutations([log[a:b] for a, b in zip([0, *cuts], [*cuts, len(log)])]))
    if data.draw(st.booleans()):
        batches = [*batches, batches[0]]
    t = deleting(spark, tmp_path_factory.mktemp("t")).create(frame(spark, [], OPS).schema)
    compact_after = data.draw(st.integers(0, len(batches)))
    for number, batch in enumerate(batches):
        t.apply(frame(spark, batch, OPS))
        if number == compact_after:
            old = t.compact()
            t.remove(old if data.draw(st.booleans()) else old[:1])
    assert rows(t.read()) == model(log)
    t.appended().createOrReplaceTempView("rows_with_deletes")
    assert rows(spark.sql(t.select_sql("rows_with_deletes"))) == model(log)


def test_tombstones_are_forgotten_when_they_hide_nothing(spark, tmp_path):
    t = deleting(spark, tmp_path)
    t.apply(frame(spark, [("x", 1, 1, "I"), ("y", 1, 1, "I")], OPS))
    t.apply(frame(spark, [("x", 2, None, "D"), ("y", 9, None, "D")], OPS))
    old = t.compact(forget_before=5)
    assert t.appended().filter("_is_deleted").count() == 4  # both stay beside the rows they hide
    for folder in old:  # in any order, nothing comes back
        t.remove([folder])
        assert rows(t.read()) == []
    t.remove(t.compact(forget_before=5))
    assert rows(t.appended(), "k") == [("y",)]
    t.apply(frame(spark, [("y", 3, 3, "U"), ("z", 1, 1, "I")], OPS))
    assert rows(t.read(), "k") == [("z",)]


def test_a_table_may_begin_to_apply_deletes(spark, tmp_path):
    table(spark, tmp_path).apply(frame(spark, [("x", 1, 1, "I"), ("y", 1, 1, "D")], OPS))
    t = deleting(spark, tmp_path)
    t.apply(frame(spark, [("x", 2, 1, "D")], OPS))
    assert rows(t.read(), "k", "op") == [("y", "D")]  # stored before deletes were applied
    assert rows(table(spark, tmp_path).read(), "k") == [("y",)]  # whoever reads honours them
    with pytest.raises(ValueError, match="_is_deleted"):
        t.apply(frame(spark, [("x", 2, 1, "D", True)], OPS + ", _is_deleted boolean"))


# -- a base in buckets ----------------------------------------------------------------------


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(data=st.data())
def test_a_base_in_buckets_changes_nothing(spark, tmp_path_factory, data):
    """Compactions between late, tied, deleted and keyless changes, with and without the old files."""
    change = st.tuples(
        st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.integers(0, 2)), st.sampled_from(["I", "D", None])
    )
    log = data.draw(st.lists(change, min_size=1, max_size=25))
    cuts = sorted(data.draw(st.lists(st.integers(0, len(log)), max_size=2)))
    batches = data.draw(st.permutations([log[a:b] for a, b in zip([0, *cuts], [*cuts, len(log)])]))
    t = deleting(spark, tmp_path_factory.mktemp("t"), buckets=3).create(frame(spark, [], OPS).schema)
    compact_after = data.draw(st.sets(st.integers(0, len(batches)), min_size=1))
    for number, batch in enumerate(batches):
        t.apply(frame(spark, batch, OPS))
        if number in compact_after:
            old = t.compact()
            if data.draw(st.booleans()):
                t.remove(old)
    assert rows(t.read()) == model(log)
    t.appended().createOrReplaceTempView("rows_with_base")  # whoever does not know of the base sees the same
    assert rows(spark.sql(t.select_sql("rows_with_base"))) == model(log)


def test_the_base_is_not_shuffled(spark, tmp_path, plan):
    t = deleting(spark, tmp_path, buckets=4)
    t.apply(frame(spark, [(str(i), 1, i, "I") for i in range(3000)], OPS))
    t.remove(t.compact())
    t.apply(frame(spark, [("7", 2, -7, "U"), ("8", 2, None, "D"), ("new", 1, 1, "I"), (None, 1, 1, "I")], OPS))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(t.read()).split("\n")
        depth = [len(line) - len(line.lstrip(" :+-")) for line in text]
        scans = [i for i, line in enumerate(text) if "Bucketed: true" in line and "IsNotNull(k)" in line]
        assert len(scans) == 1
        above, at = [], depth[scans[0]]
        for i in range(scans[0], -1, -1):
            if depth[i] < at:
                at = depth[i]
                above.append(text[i])
        joined = next(i for i, line in enumerate(above) if "SortMergeJoin" in line)
        assert not any("Exchange" in line or "Window" in line for line in above[: joined + 1])
        assert any("Exchange" in line for line in text)  # what was appended is dealt to the buckets
        got = {r["k"]: r["v"] for r in t.read().collect()}
        assert len(got) == 3001 and (got["7"], got["new"], got[None]) == (-7, 1, 1) and "8" not in got
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not [x for x in spark.catalog.listTables() if x.name.startswith("base_")]


def test_new_columns_after_a_base(spark, tmp_path):
    t = table(spark, tmp_path, buckets=2)
    t.apply(frame(spark, [("x", 1, 1), ("y", 1, 1)]))
    t.remove(t.compact())
    t.apply(frame(spark, [("x", 2, 2, "new")], SCHEMA + ", w string"))
    assert rows(t.read()) == [("x", 2, 2, "new"), ("y", 1, 1, None)]
    t.remove(t.compact())
    assert rows(t.read()) == [("x", 2, 2, "new"), ("y", 1, 1, None)] and t.appended().count() == 2


def test_a_single_folder_is_read_without_ranking_and_more_are_ranked(spark, tmp_path, plan):
    t = CurrentTable(spark, str(tmp_path / "t"), ["k"], "seq").create(spark.createDataFrame([], "k string, seq int, v int").schema)
    assert rows(t.read()) == []
    t.apply(spark.createDataFrame([("x", 1, 1), ("x", 2, 2), (None, 1, 3), (None, 4, 4)], "k string, seq int, v int"))
    assert "Exchange" not in plan(t.read())
    assert rows(t.read()) == [("x", 2, 2), (None, 4, 4)]
    t.apply(spark.createDataFrame([("x", 3, 5), ("y", 1, 1)], "k string, seq int, v int"))
    assert "Exchange" in plan(t.read())
    assert rows(t.read()) == [("x", 3, 5), ("y", 1, 1), (None, 4, 4)]
    t.remove(t.compact())
    assert "Exchange" not in plan(t.read()) and t.read().count() == 3
