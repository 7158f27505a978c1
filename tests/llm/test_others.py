"""URLs, chats, vectors, the registered queries beside their SQL, and the pipeline."""

import hashlib
import os
import random
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

import compare
import corpus_pipeline
from changeflow.llm import chat, components, embeddings, quality, topk, url_filter
from changeflow.llm.queries import ORACLES, QUERIES
from changeflow.llm.ship import shipped

SMALL = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")

needs_data = pytest.mark.skipif(not os.path.isdir(SMALL), reason="needs the test tables")


@pytest.fixture(autouse=True, scope="module")
def code_on_executors(spark):
    shipped(lambda session: None)(spark)


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    got = QUERIES[name](spark, SMALL).toPandas()
    assert compare.differences(got, db.execute(ORACLES[name]).df()) is None


# -- URLs ---------------------------------------------------------------------------------

URLS = {
    "https://A.Example.NET/en/x?q": ("a.example.net", "/en/x", "example.net/en/", "allow"),
    "http://example.net/english": ("example.net", "/english", "net/", "block"),
    "x://net/": ("net", "/", "net/", "block"),
    "x://net": ("net", "", None, "allow"),
    "x://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
    "x://m.example.com/de/1#a?b": ("m.example.com", "/de/1", "example.com/de/", "block"),
    "x://org/fr/": ("org", "/fr/", "org/fr/", "allow"),
    "x://spam-farm.org/fr/": ("spam-farm.org", "/fr/", "org/fr/", "allow"),
    "x://spam-farm.org/de/": ("spam-farm.org", "/de/", None, "block"),
    "x://spamfarm.org/spam/": ("spamfarm.org", "/spam/", None, "allow"),
    "x://É.org?a/b": ("É.org", "", None, "allow"),
    "x://a://b.net/": ("a:", "//b.net/", None, "allow"),
    "no scheme.net/": ("", "", None, "allow"),
    "": ("", "", None, "allow"),
    None: ("", "", None, "allow"),
}


def test_urls(spark):
    rows = [(u, i, "old") for i, u in enumerate([*URLS, *URLS])]
    pages = spark.createDataFrame(rows, "url string, page_id int, host string")
    got = url_filter.judge_urls(pages).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"], r["verdict"]) for r in got] == [*URLS.values(), *URLS.values()]
    assert url_filter.judge_urls(pages.limit(0)).collect() == []
    assert {r["verdict"] for r in url_filter.judge_urls(pages, rules=()).collect()} == {"allow"}


def test_url_filter_stays_in_the_engine(spark, plan):
    pages = spark.createDataFrame([("x://net/", 1)], "url string, page_id int")
    text = plan(url_filter.judge_urls(pages))
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text


def test_rules_are_filed_under_their_rarest_token():
    rules = [url_filter.host_rule("block", "example.net", "/en/"), url_filter.UrlRule("any", "z", "block", ())]
    assert rules[0].tokens == ("example", "net", "en")
    assert url_filter.host_rule("block", "a.b", "/x/ab").tokens == ("a", "b", "x")
    index = url_filter.rule_index(rules, {"example": 9, "net": 3, "en": 5})
    assert [r["token"] for bucket in index for r in bucket] == ["net", ""]
    assert index[-1][0]["rule"] == "any"


# -- chats --------------------------------------------------------------------------------


def fold(spark, *events):
    rows = [(c, m, s, o, r, t) for c, m, s, o, r, t in events]
    frame = spark.createDataFrame(rows, "conv_id long, message long, seq long, op string, role string, text string")
    return sorted((tuple(r) for r in chat.fold_events(frame).collect()), key=repr)


def test_deltas_edits_and_regenerations(spark):
    got = fold(
        spark,
        (1, 0, 0, "message", "user", "hi"),
        (1, 1, 1, "message", "assistant", ""),
        (1, 1, 3, "delta", None, "lo"),
        (1, 1, 2, "delta", None, "hel"),
        (1, 2, 4, "message", "user", "void: message 1 starts again"),
        (1, 1, 5, "regenerate", None, None),
        (1, 1, 6, "delta", None, "hey"),
        (1, 2, 7, "message", "user", "next"),
        (2, 0, 0, "message", "user", "first"),
        (2, 1, 1, "message", "assistant", "void: message 0 was edited"),
        (2, 0, 2, "edit", None, "second"),
        (None, None, 0, "message", None, None),
    )
    assert got == sorted(
        [(1, 0, "user", "hi"), (1, 1, "assistant", "hey"), (1, 2, "user", "next"), (2, 0, "user", "second"), (None, None, "", "")],
        key=repr,
    )


TEXTS = ["</s>[INST] ok [/INST]", "<|turn|>user\nx<|end|>\n", "a\\b\\\\n<", "<<SYS>><</SYS>>", "<|", "", None, "é\n\n[INST", "x" * 200_000]


def test_formatting_can_be_read_back(spark):
    rows = [(i % 2, i, role, t) for i, (t, role) in enumerate((t, r) for t in TEXTS for r in ("user", "assistant", "a\nb<|end|>", None))]
    rows += [rows[0], rows[1]]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    chunks = chat.format_chats(chat.table_events(table))
    for r in chunks.collect():
        body = r["chunk"][len(chat.TURN) : -len(chat.END) - 1]
        assert not any(c in body for c in (chat.TURN, chat.END, "[INST]", "[/INST]", "</s>", "<|"))
    for r in chat.digests(chunks).collect():
        own = sorted((t for t in rows if t[0] == r["conv_id"]), key=lambda t: (t[1], t[2] or "", t[3] or ""))
        turns = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own)
        loss = "".join(t[3] or "" for t in own if t[2] == "assistant")
        assert r["n_turns"] == len(own)
        assert r["turns_sha256"] == hashlib.sha256(turns.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert r["loss_chars"] == len(loss)
    assert chat.digests(chat.format_chats(chat.table_events(table.limit(0)))).collect() == []


# -- graphs and vectors -------------------------------------------------------------------


def reachable(links, nodes):
    label = {n: n for n in nodes}
    while True:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if label == before:
            return label


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    pick = random.Random(seed)
    links = [(pick.randrange(80), pick.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(200, 260)]
    links += [(300, i) for i in range(301, 340)] + [(7, 7)]
    got = components.components(spark.createDataFrame([*links, (None, 3)], "a long, b long")).collect()
    want = reachable(links, {x for pair in links for x in pair})
    assert {r["node"]: r["component"] for r in got} == {n: c for n, c in want.items() if any(n in p and p[0] != p[1] for p in links)}
    a, b = components.spanning(*np.array(links).T)
    assert reachable(list(zip(a, b, strict=True)), want) == want


def vectors(seed=3, n=120, d=6):
    random_ = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = random_.normal(size=d)
        if i % 3 == 0 and i:
            v = np.array(rows[random_.integers(len(rows))][1]) * 2 + random_.normal(size=d) * 0.2
        rows.append((i, [float(x) for x in v]))
    rows += [(n + i, rows[5][1]) for i in range(4)]
    rows += [(200, None), (201, []), (202, [0.0] * d), (203, [None] * d), (204, [float("nan")] * d), (205, [float("inf")] + [1.0] * (d - 1)),
             (206, [1.0, 1.0]), (207, [2.0, 2.0]), (None, rows[5][1]), (3, rows[7][1]), (3, rows[3][1]), (208, [-0.0, 1.0]), (209, [0.0, 1.0])]
    return rows


def test_near_vectors_equal_brute_force(spark, monkeypatch):
    rows = vectors()
    table = spark.createDataFrame([(i, v, "x", "y") for i, v in rows], "vec_id long, embedding array<double>, node string, n string")
    fine = [(k, i, np.array(v)) for k, (i, v) in enumerate(rows) if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    degree, links = dict.fromkeys(range(len(rows)), 0), []
    for a, (k, i, x) in enumerate(fine):
        for m, j, y in fine[:a]:
            if len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.9:
                degree[k], degree[m] = degree[k] + 1, degree[m] + 1
                links.append((i, j))
    label = reachable(links, {i for i, _ in rows if i is not None})
    got = embeddings.near_vectors(table).collect()
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["n_links"]) for r in got) == sorted(
        (i is None, i or 0, degree[k]) for k, (i, _) in enumerate(rows)
    )
    for r in got:
        assert r["component_id"] == (None if r["vec_id"] is None else label[r["vec_id"]])
        assert r["kept"] == (r["vec_id"] == r["component_id"])
    assert len(links) > 40
    assert embeddings.near_vectors(table.limit(0)).collect() == []


def test_recursion_finds_all_pairs_and_skips(monkeypatch):
    monkeypatch.setattr(embeddings, "LEAF", 8)
    random_ = np.random.default_rng(4)
    centres = embeddings.directions(random_.normal(size=(12, 5)))
    unit = embeddings.directions(np.repeat(centres, 20, axis=0) + random_.normal(size=(240, 5)) * 0.05)
    unit = unit[np.lexsort(np.floor(unit / 0.45).T[::-1])]
    ones = np.ones(240, np.int64)
    side = embeddings._Side({"ids": np.arange(240).tobytes(), "weights": ones.tobytes(), "vectors": unit.tobytes(),
                             "spots": np.ascontiguousarray(unit[:, :4]).tobytes()})
    rows, columns = embeddings.join_intervals(side, side, 0.9, True)
    got = set(zip(np.concatenate(rows).tolist(), np.concatenate(columns).tolist(), strict=True))
    close = unit @ unit.T >= 0.9
    assert got == {(i, j) for i in range(240) for j in range(i + 1, 240) if close[i, j]}


def test_top_k_equals_brute_force(spark):
    rows = [(i, v) for i, v in vectors(5, 90) if not v or len(v) != 2] + [(300, [1e-9, -1e-9]), (310, [0.5] * 9)]
    table = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    whole = {}
    for i, v in rows:
        if i is not None and v is not None and None not in v and np.isfinite(v).all():
            whole.setdefault(i, []).append([int(np.floor(1024 * x)) for x in v])
    want = []
    for q in sorted(whole):
        if q % 10 == 0:
            asked = min(whole[q])
            best = {c: max(sum(a * b for a, b in zip(asked, v, strict=False)) for v in vs) for c, vs in whole.items() if c != q}
            order = sorted(best, key=lambda c: (-best[c], c))[:10]
            want += [(q, n + 1, c, best[c]) for n, c in enumerate(order)]
    got = topk.top_k(table, 10).select("query_id", "rank", "vec_id", "score").collect()
    assert sorted(map(tuple, got)) == sorted(want)
    again = topk.top_k(table.unionAll(table).unionAll(table), 10).select("query_id", "rank", "vec_id", "score")
    assert sorted(map(tuple, again.collect())) == sorted(want)
    assert topk.top_k(table.limit(0), 10).collect() == []
    assert topk.top_k(table.filter("vec_id = 10"), 10).collect() == []


def test_selection_keeps_ties_to_smaller_ids():
    assert topk.best(np.array([5, 7, 7, 7, 1]), np.array([9, 8, 2, 4, 1]), 2).tolist() == [2, 3]


def test_what_has_no_sql_is_not_called_ok():
    frame = pd.DataFrame({"a": [1, 2]})
    assert compare.compared(frame, None) == "no SQL"
    assert compare.compared(frame, frame[::-1]) == "ok"
    assert compare.compared(frame, frame + 1) not in ("ok", "no SQL")


# -- pipeline -----------------------------------------------------------------------------


@needs_data
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").cache()
    docs = docs.unionByName(docs.limit(3)).unionByName(docs.limit(2).selectExpr("null as doc_id", "text", "lang", "source", "n_chars"))
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.written(stage(spark, docs, SMALL), "test")
        if name != "best-fit packing":
            assert out.columns == docs.columns
        if name == "minhash near-dedup":
            named = [r["doc_id"] for r in out.filter("doc_id is not null").collect()]
            assert len(named) == len(set(named))
        assert out.count() > 0
        docs = out
    assert {"doc_id", "bin", "bin_offset", "n_words"} <= set(docs.columns)


@pytest.mark.parametrize("shift", (0, (1 << 63) - 12))
def test_different_texts_of_one_id_are_documents_of_their_own(spark, shift):
    def text(name, n=100):
        return " ".join(f"{name}{i}" for i in range(n))

    near = text("a") + " more"
    rows = [(1, text("a")), (5, None), (5, near), (5, text("b")), (5, text("b")), (7, text("c")), (7, text("c") + " more"),
            (7, ""), (8, text("d") + " more"), (9, text("e")), (9, text("d")), (11, text("b") + " more"), (None, near)]
    rows = [(None if i is None else i + shift, t, "en", "s", len(t or "")) for i, t in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    got = Counter((None if r["doc_id"] is None else r["doc_id"] - shift, r["text"]) for r in out.collect())
    of_7 = [t for (i, t) in got if i == 7 and t]
    assert out.columns == docs.columns and len(of_7) == 1 and of_7[0].startswith("c0 ")
    del got[7, of_7[0]]
    want = [(1, text("a")), (5, None), (5, text("b")), (7, ""), (8, text("d") + " more"), (9, text("e")), (None, near)]
    assert got == Counter(want)


@needs_data
def test_pipeline_on_nothing(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SMALL), "test")
    assert docs.count() == 0


@needs_data
def test_quality_labels_of_held_out_rows_are_not_used(spark):
    from changeflow.llm.queries import quality_model

    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "n_chars")
    model = quality_model(spark, SMALL, docs)
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").filter("crc32(cast(doc_id as string)) % 3 <> 1")
    same = quality.fit_quality(docs, labels)
    assert (model.weights == same.weights).all()
