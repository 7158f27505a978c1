"""Operators on documents beside plain Python, and the rows that tend to break things."""

import hashlib
import os
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from changeflow.llm import kernels, minhash, mixing, packing, quality, suffix, token_counts
from changeflow.llm.ship import shipped

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(autouse=True, scope="module")
def code_on_executors(spark):
    shipped(lambda session: None)(spark)


def lower(text):
    return text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def shingle_set(text):
    words = WORD.findall(lower(text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))}


def corpus(seed=1, n=60):
    """Random texts with exact and near copies, shared passages, and the odd rows."""
    pick = random.Random(seed)
    vocabulary = ["".join(pick.choices("abcdeéß", k=pick.randint(2, 6))) for _ in range(150)]
    passage = " ".join(pick.choices(vocabulary, k=40))
    texts = []
    for _ in range(n):
        kind, words = pick.random(), pick.choices(vocabulary, k=pick.randint(1, 80))
        if texts and kind < 0.15:
            words = pick.choice(texts).split(" ")
        elif texts and kind < 0.5:
            words = pick.choice(texts).split(" ")
            for _ in range(pick.randint(1, 3)):
                words[pick.randrange(len(words))] = pick.choice(vocabulary)
        text = " ".join(words)
        texts.append(text + " " + passage if kind > 0.85 else text)
    texts += [None, "", " \t\n", "one", "ONE", "a b c d", "x\u00a0y", texts[0].upper(), "ab " * 400, "ab " * 400]
    rows = [(i, t, "en", f"s{i % 4}" if i % 9 else None, None if t is None else len(t)) for i, t in enumerate(texts)]
    return rows + [rows[3], (None, texts[1], None, None, None), (5, texts[2], "de", "s1", 7)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = corpus()
    random.Random(2).shuffle(rows)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def wide(docs):
    """The same with columns whose names operators use themselves."""
    for name in ("id", "mark", "signature", "block", "rest", "hash", "size", "epochs", "threshold", "cluster"):
        docs = docs.selectExpr("*", f"'x' as {name}")
    return docs


# -- words and shingles -------------------------------------------------------------------


def test_shingles_agree_with_sets_of_words():
    texts = [r[1] or "" for r in corpus(7)] + ["word " * 300_000]
    data, offsets = kernels.text_bytes(pa.array(texts))
    seen, size = {}, []
    for a, b in kernels.pieces(offsets):
        part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        for text, found in zip(texts[a:b], kernels.sets_of(*kernels.shingles(part, own)), strict=True):
            want = shingle_set(text)
            size.append(len(found) == len(want))
            for h in found.tolist():
                seen.setdefault(h, set()).add(len(want))
    assert all(size) and len(size) == len(texts)


def test_equal_shingles_have_equal_hashes_and_others_not():
    texts = ["a b c d e f", "z a b c d e", "A B C D E", "a b c d", "a b c d", "d c b a"]
    data, offsets = kernels.text_bytes(pa.array(texts))
    sets = [set(s.tolist()) for s in kernels.sets_of(*kernels.shingles(data, offsets))]
    assert sets[0] & sets[1] == sets[2] and len(sets[0] | sets[1]) == 3
    assert sets[3] == sets[4] != sets[5]


# -- near-duplicates ----------------------------------------------------------------------


def brute_components(rows, percent=75):
    """Least id reachable, by comparing all rows; rows of one id are one node."""
    ids = sorted({r[0] for r in rows if r[0] is not None})
    label = {i: i for i in ids}

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    known = [(r[0], shingle_set(r[1])) for r in rows if r[0] is not None]
    for i, (a, x) in enumerate(known):
        for b, y in known[:i]:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(a), root(b)))
                label[high] = low
    return {i: root(i) for i in ids}


def test_near_duplicates_equal_brute_force(docs):
    rows = [tuple(r) for r in docs.collect()]
    want = brute_components(rows)
    got = minhash.near_duplicates(wide(docs)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == want[r["doc_id"]] and r["kept"] == (r["doc_id"] == r["component_id"])
    sizes = sorted((r["doc_id"] or -1, r["n_shingles"]) for r in got)
    assert sizes == sorted((r[0] or -1, len(shingle_set(r[1]))) for r in rows)
    assert len(set(want.values())) < len(want) - 10


@pytest.mark.parametrize("bound", ["BLOCK", "BLOCK_SHINGLES"])
def test_stragglers_around_a_large_group_are_compared(spark, monkeypatch, bound):
    """A chain of small changes: ends are far from the least id, and blocks are many."""
    monkeypatch.setattr(minhash, bound, {"BLOCK": 8, "BLOCK_SHINGLES": 512}[bound])
    pick = random.Random(4)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(words), None, None, None))
        words[pick.randrange(60)] = f"n{i}"
    far = [(100 + i, " ".join(pick.choices(words, k=60)), None, None, None) for i in range(5)]
    docs = spark.createDataFrame(rows + far, SCHEMA)
    want = brute_components(rows + far)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs).collect()}
    assert got == want


def test_candidates_that_agree_in_few_minhashes_are_compared(spark):
    """Two similar texts, 17 of whose 40 minhashes agree, meet behind a third in all their tables."""
    words = [f"w11x933x{i}" for i in range(104)]
    a, b = " ".join(words), " ".join([f"v11x933x{i}" for i in range(14)] + words[14:])

    def signed(*texts):
        hashes, bounds = kernels.shingles(*kernels.text_bytes(pa.array(texts)))
        return minhash.signatures(hashes, bounds)

    both = signed(a, b)
    agree = both[0] == both[1]
    keys = minhash.table_keys(both)
    tables = np.flatnonzero(keys[0] == keys[1])
    assert agree.sum() == 17 and len(tables) == 4
    groups = agree.reshape(-1, minhash.ROWS).all(axis=1)
    windows = {i: " ".join(words[i : i + 5]) for i in range(100)}
    single = signed(*windows.values())
    of = sorted({int(np.flatnonzero(single[:, j] == both[0, j])[0]) for j in np.flatnonzero(np.repeat(groups, minhash.ROWS))})
    pick = random.Random(1)
    for _ in range(10_000):
        pick.shuffle(of)
        hub = " ".join(windows[i] for i in of)
        if (minhash.table_keys(signed(hub))[0, tables] == keys[0, tables]).all():
            break
    else:
        raise AssertionError("no third text")
    sets = [shingle_set(t) for t in (hub, a, b)]
    assert [100 * len(x & y) >= 75 * len(x | y) for x, y in ((sets[0], sets[1]), (sets[0], sets[2]), (sets[1], sets[2]))] == [False, False, True]
    docs = spark.createDataFrame([(0, hub), (1, a), (2, b)], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 1}


def test_what_is_ruled_out_is_never_similar():
    pick = np.random.default_rng(4)
    sets = [np.zeros(1, np.uint64)]
    for size in (1, 3, 60, 64, 65, 130, 700, 1030):
        whole = pick.integers(0, 1 << 63, size, dtype=np.uint64)
        for share in (1, 0.95, 0.9, 0.87, 0.8, 0.6):
            own = whole[pick.random(size) < share]
            sets.append(np.unique(np.r_[own, pick.integers(0, 1 << 63, pick.integers(0, size // 8 + 2), dtype=np.uint64)]))
    sets = [s for s in sets if len(s)]
    bits = [minhash.parity(s) for s in sets]
    size, every = np.array([len(s) for s in sets]), np.arange(len(sets))
    seen = 0
    for percent in (50, 75, 90):
        bound = minhash.Bound(size, np.concatenate(bits), np.cumsum([0, *map(len, bits)]), percent)
        for i, s in enumerate(sets):
            both = np.array([len(np.intersect1d(s, t)) for t in sets])
            similar = every[100 * both >= percent * (size + len(s) - both)]
            within = bound.within(i, every)
            assert set(similar) <= set(within)
            seen += len(every) - len(within)
    assert seen > len(sets) ** 2


def test_tensored_tables_reach_their_recall():
    random_ = np.random.default_rng(3)
    missed = 0
    for _ in range(400):
        common = random_.integers(0, 1 << 63, 300, dtype=np.uint64)
        a, b = (np.concatenate([common, random_.integers(0, 1 << 63, 50, dtype=np.uint64)]) for _ in range(2))
        pair = minhash.signatures(np.concatenate([a, b]), np.array([0, 350, 700]))
        keys = minhash.table_keys(pair)
        missed += not (keys[0] == keys[1]).any()
    assert missed <= 3
    assert minhash.TABLES == minhash.HALVES**2 and minhash.HASHES == 2 * minhash.HALVES * minhash.ROWS


# -- repeated passages --------------------------------------------------------------------


def brute_repeats(rows):
    """doc rows → (id, bytes, removed, spans, hash)."""
    least = {}
    key = lambda i: (i is None, i or 0)
    for i, text, *_ in rows:
        data = (text or "").encode()
        for p in range(len(data) - 49):
            g = data[p : p + 50]
            least[g] = min(least.get(g, key(i)), key(i))
    out = []
    for i, text, *_ in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, dtype=bool)
        for p in range(len(data) - 49):
            if least[data[p : p + 50]] < key(i):
                gone[p : p + 50] = True
        kept = bytes(b for b, g in zip(data, gone[:-1], strict=True) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((i, len(data), int(gone[:-1].sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


NAMES = ("doc_id", "_n_bytes", "_n_removed", "_n_spans", "_kept_sha256")


@pytest.mark.parametrize("seed", [1, 5])
def test_removed_passages_equal_brute_force(spark, seed):
    rows = corpus(seed, 80)
    got = suffix.remove_repeats(wide(spark.createDataFrame(rows, SCHEMA).repartition(3)), block_bytes=4096)
    assert {"id", "block", "rest", "lang"} <= set(got.columns) and "text" not in got.columns
    assert sorted((tuple(r[n] for n in NAMES) for r in got.collect()), key=repr) == brute_repeats(rows)
    assert sum(r[2] for r in brute_repeats(rows)) > 1000


def test_common_anchors_are_dealt_out_string_by_string(spark):
    rows = corpus(9, 80)
    pick = random.Random(1)
    phrase = "the very same words of forty bytes or so "
    rows += [(1000 + i, "".join(pick.choices("ab ", k=20)) + phrase + "".join(pick.choices("ab ", k=3)), None, None, None)
             for i in range(200)]
    got = suffix.remove_repeats(spark.createDataFrame(rows, SCHEMA).repartition(4), block_bytes=2048, common=2)
    assert sorted((tuple(r[n] for n in NAMES) for r in got.collect()), key=repr) == brute_repeats(rows)


def test_contexts_differ_if_any_bit_of_their_hashes_does(monkeypatch):
    """Hashes are cut to bits that were once thrown away; contexts with one anchor stay apart."""
    real = kernels.mixed
    monkeypatch.setattr(suffix.kernels, "mixed", lambda x: real(x) & np.uint64(0xFFF << 32))
    pick = random.Random(3)
    phrase = pick.randbytes(40)
    data = b"".join(pick.randbytes(40) + phrase + pick.randbytes(40) for _ in range(30))
    block = suffix._Block.__new__(suffix._Block)
    block.data, block.offsets = np.frombuffer(data, np.uint8), np.arange(31) * 120
    block.contexts()
    ends = block.start + block.run + suffix.LENGTH - 1
    contexts = {(int(k) >> 20, data[a:b]) for k, a, b in zip(block.key, block.start, ends, strict=True)}
    assert len({a for a, _ in contexts}) < len(contexts) == len(block.first)


@pytest.mark.parametrize(("seed", "letters", "depth"), [(1, b"a", 50), (2, b"ab", 50), (3, b"ab", 12), (4, b"abc", 5), (5, b"ab", 28)])
def test_previous_factors_have_the_lengths_of_brute_force(seed, letters, depth):
    pick = random.Random(seed)
    texts = [bytes(pick.choices(letters, k=pick.randrange(depth, 2 * depth))) for _ in range(12)]
    texts += [t[i : i + 2 * depth] for t in texts[:6] for i in (0, 1)]
    texts = [t for t in texts if len(t) >= depth]
    ids = [pick.choice([0, 1, 2, 3, 5, 9, np.iinfo(np.int64).max]) for _ in texts]
    starts, owner, at = [], [], 0
    for text, i in zip(texts, ids, strict=True):
        starts += range(at, at + len(text) - depth + 1)
        owner += [i] * (len(text) - depth + 1)
        at += len(text)
    data = b"".join(texts)
    cut = [data[s : s + depth] for s in starts]
    want = [
        max((len(os.path.commonprefix([a, b])) for b, j in zip(cut, owner, strict=True) if j < i), default=0)
        for a, i in zip(cut, owner, strict=True)
    ]
    order = pick.sample(range(len(starts)), len(starts))
    got = suffix.longest_previous_factors(
        np.frombuffer(data, np.uint8), np.array(starts)[order], np.array(owner)[order], depth
    )
    assert got.tolist() == [want[k] for k in order]
    assert 0 in want and max(want) == depth


def test_what_is_sent_follows_the_entries_and_not_the_buckets():
    rows = corpus(4, 300)
    table = pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    blocks = list(suffix._packer("doc_id", "text", 1 << 16)(iter(table.to_batches())))
    blocks = [b.append_column("block", pa.array([n], pa.int64())) for n, b in enumerate(blocks)]

    def sent(buckets):
        out = list(suffix._entries("doc_id", buckets)(iter(blocks)))
        entries = sum(len(v) // 8 for b in out for v in b.column("key").to_pylist())
        return entries, sum(len(v) for b in out for c in ("key", "more", "per_doc", "steps") for v in b.column(c).to_pylist())

    entries, _ = sent(8)
    for buckets in (1, 8, 2048):
        assert sent(buckets)[0] == entries and sent(buckets)[1] <= 28 * entries


def asked_texts(texts, routes, common, block_bytes=1 << 16):
    """What the blocks of these texts send on to be compared."""
    table = pa.table({"doc_id": range(len(texts)), "text": texts})
    blocks = list(suffix._packer("doc_id", "text", block_bytes)(iter(table.to_batches())))
    blocks = [b.append_column("block", pa.array([n], pa.int64())) for n, b in enumerate(blocks)]
    entries = pa.Table.from_batches(list(suffix._entries("doc_id", 1)(iter(blocks))))
    judged = {r["block"]: r for r in suffix._judge(common, entries).to_pylist()}
    kind = pa.list_(pa.struct([("bucket", pa.int32()), ("state", pa.binary())]))
    states = [pa.array([[{"bucket": 0, "state": judged[n]["state"]}]], kind) for n in range(len(blocks))]
    blocks = [b.append_column("states", s) for b, s in zip(blocks, states, strict=True)]
    return list(suffix._texts("doc_id", 1, routes)(iter(blocks))), len(blocks)


def test_texts_to_compare_are_not_sent_route_by_route():
    """A batch has a cost of its own; one for each block and route grew with the square of the corpus."""
    texts = [r[1] for r in corpus(4, 300) if r[1]]
    one, blocks = asked_texts(texts, 1, suffix.COMMON)
    many, _ = asked_texts(texts, 4096, suffix.COMMON)
    size = [sum(len(v) for b in sent for v in b.column("text").to_pylist()) for sent in (one, many)]
    assert size[0] == size[1] > 10_000
    assert len(many) <= 2 * blocks < sum(b.num_rows for b in many) / 10


def test_contexts_of_a_common_anchor_are_sent_in_few_parts():
    """As many bytes as for one context after the other, or some; not ``LENGTH`` for each string."""
    pick = random.Random(2)
    phrase = "these are the words that all of them have in common"
    texts = [f"{pick.randbytes(30).hex()} {phrase} {pick.randbytes(30).hex()}" for _ in range(300)]
    size = [
        sum(len(v) for b in asked_texts(texts, 64, common)[0] for v in b.column("text").to_pylist())
        for common in (suffix.COMMON, 2)
    ]
    assert 0 < size[0] < size[1] < 3 * size[0]


def test_only_strings_that_may_be_shared_get_into_the_suffix_array(monkeypatch):
    pick = random.Random(6)
    phrase = "thirty bytes that many have in"
    texts = [f"{pick.randbytes(30).hex()} {phrase} {pick.randbytes(30).hex()}" for _ in range(400)]
    texts += [f"{pick.randbytes(30).hex()} {t[40:100]} {pick.randbytes(30).hex()}" for t in texts[:3]]
    sent, _ = asked_texts(texts, 1, suffix.COMMON)
    group = pa.Table.from_batches(sent)
    group = group.take(np.flatnonzero(np.array(group.column("route").to_pylist()) >= 0))
    taken, real = [], suffix.longest_previous_factors
    monkeypatch.setattr(suffix, "longest_previous_factors", lambda d, s, *a: taken.append(len(s)) or real(d, s, *a))
    found = suffix._compare(group).to_pylist()
    strings = sum(np.frombuffer(v, np.uint32).sum() for v in group.column("size").to_pylist())
    gone = sum(np.frombuffer(r["size"], np.uint32).sum() for r in found)
    assert 0 < gone <= sum(taken) <= 2 * gone < strings / 20


def test_order_by_two_numbers():
    pick = np.random.default_rng(8)
    for kinds in (2, 5, 1 << 40):
        key, more = (pick.integers(0, kinds, 500).astype(np.uint64) for _ in range(2))
        order, new = suffix._in_order(key, more)
        pairs = list(zip(key[order].tolist(), more[order].tolist(), strict=True))
        assert pairs == sorted(pairs) and sorted(order.tolist()) == list(range(500))
        assert new.tolist() == [i == 0 or pairs[i] != pairs[i - 1] for i in range(500)]


def test_steps_over_a_block_need_little_beside_its_text():
    """Workers share an executor's memory: no arrays of eight bytes for each byte, one block at a time."""
    pick = random.Random(7)
    n = 4 << 20
    texts = [pick.randbytes(1 << 10).hex() for _ in range(n >> 11)]
    table = pa.table({"doc_id": range(len(texts)), "text": texts})
    blocks = list(suffix._packer("doc_id", "text", n)(iter(table.to_batches())))
    blocks = pa.Table.from_batches(blocks * 3).append_column("block", pa.array(range(3), pa.int64()))
    runs = pa.array([[{"start": np.arange(0, n - 99, 99).tobytes(), "size": np.ones(n // 99, np.uint32).tobytes()}]] * 3)
    rows = {
        "entries": (suffix._entries("doc_id", 8), blocks),
        "cut": (suffix._cut("doc_id", True), blocks.append_column("runs", runs)),
    }
    taken, count = {}, {}
    for name, (step, given) in rows.items():
        batches = given.combine_chunks().to_batches()
        tracemalloc.start()
        count[name] = [out.num_rows for out in step(iter(batches))]
        taken[name] = tracemalloc.get_traced_memory()[1] / n
        tracemalloc.stop()
    assert taken["entries"] < 15 and taken["cut"] < 15, taken
    assert sum(count["cut"]) == 3 * len(texts) and max(count["cut"]) < len(texts)


def test_buckets_beyond_the_tasks_change_nothing(spark):
    rows = corpus(6, 80)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = suffix.remove_repeats(docs, block_bytes=4096, bucket_bytes=1000)
    assert sorted((tuple(r[n] for n in NAMES) for r in got.collect()), key=repr) == brute_repeats(rows)


def test_kept_text_is_what_stays(spark):
    shared = "this sentence of more than fifty bytes stands in both of the texts. "
    rows = [(1, shared + "first", None, None, None), (2, "é" + shared + "second", None, None, None)]
    got = suffix.remove_repeats(spark.createDataFrame(rows, SCHEMA), with_text=True).orderBy("doc_id")
    assert [r["_kept_text"] for r in got.collect()] == [rows[0][1], "ésecond"]


def test_suffix_ranks_order_and_equality():
    pick = random.Random(3)
    data = bytes(pick.choices(b"ab", k=400))
    ranks = suffix.suffix_ranks(np.frombuffer(data, np.uint8), 50)
    cut = [data[i : i + 50] for i in range(len(data))]
    order = sorted(set(cut))
    assert ranks.tolist() == [order.index(c) for c in cut]


# -- quality ------------------------------------------------------------------------------


def test_pairs_by_squares_equal_pairs_by_pairs():
    random_ = np.random.default_rng(1)
    model = quality.FactorisationMachine(0.3, random_.normal(size=40), random_.normal(size=(40, quality.RANK)))
    number, value, bounds = random_.permutation(40)[:12], random_.normal(size=12), np.array([0, 5, 12])
    for k, raw in enumerate(model.raw(number, value, bounds)):
        i, x = number[bounds[k] : bounds[k + 1]], value[bounds[k] : bounds[k + 1]]
        pairs = sum(
            model.factors[i[a]] @ model.factors[i[b]] * x[a] * x[b] for a in range(len(i)) for b in range(a)
        )
        assert raw == pytest.approx(0.3 + model.weights[i] @ x + pairs)


def test_classifier_learns_and_scores_odd_rows(spark, docs, empty):
    pick = random.Random(2)
    words = ["".join(pick.choices("abcdefg", k=4)) for _ in range(300)]
    good = [(i, " ".join(pick.choices(words, k=60)), None, None, 10) for i in range(0, 300)]
    bad = [(i, " | ".join(pick.choices(words, k=60)), None, None, 10) for i in range(300, 600)]
    table = spark.createDataFrame(good + bad, SCHEMA)
    labels = spark.createDataFrame([(i, int(i < 300)) for i in range(600)] + [(None, 1), (7777, 0)], "doc_id long, quality int")
    learned = labels.filter(~quality.held_out())
    model = quality.fit_quality(table, learned, rows=300)
    scored = quality.score_quality(table, model).filter(quality.held_out()).collect()
    assert np.mean([(r["score"] >= 0.5) == (r["doc_id"] < 300) for r in scored]) > 0.95 and len(scored) > 100
    again = quality.fit_quality(table.repartition(5), learned.repartition(3), rows=300)
    assert (again.weights == model.weights).all() and (again.factors == model.factors).all()
    odd = quality.score_quality(wide(docs).selectExpr("*", "'old' as score"), model).collect()
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert quality.score_quality(empty, model).collect() == []
    blank = quality.fit_quality(empty, labels)
    assert {r["score"] for r in quality.score_quality(table, blank).collect()} == {0.5}


# -- mixing -------------------------------------------------------------------------------


def water_fill(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while True:
        share = left / (sum(weight[s] for s in open_) or 1)
        over = {s for s in open_ if share * weight[s] > most * sizes[s] + 1e-9}
        if not over:
            return {**target, **{s: share * weight[s] for s in open_}}
        for s in over:
            target[s], left = most * sizes[s], left - most * sizes[s]
        open_ -= over


def test_targets_and_what_is_taken(spark, docs):
    pick = random.Random(8)
    rows = [(i, "w " * pick.randint(0, 40), None, pick.choice(["a", "a", "a", "a", "B", "é", None]), None) for i in range(3000)]
    table = wide(spark.createDataFrame(rows, SCHEMA)).drop("size")
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(r[1].split())
    parts, plan = mixing.mix(table)
    plan = {r["source"]: r for r in plan.collect()}
    want = water_fill(sizes)
    assert {s: p["source_size"] for s, p in plan.items()} == sizes
    assert {s: p["target"] for s, p in plan.items()} == pytest.approx(want)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    words = lambda rows: sum(len((r["text"] or "").split()) for r in rows)
    taken = mixing.take(table).collect()
    for s in sizes:
        own = [r for r in taken if r["source"] == s]
        assert abs(words(own) - want[s]) <= 40
        often = {}
        for r in own:
            often[r["doc_id"]] = often.get(r["doc_id"], 0) + 1
        assert max(often.values()) <= 3
    again = mixing.take(table.repartition(7)).collect()
    assert sorted(r["doc_id"] for r in again) == sorted(r["doc_id"] for r in taken)


def test_mixing_odd_rows(spark, docs, empty):
    taken = mixing.take(docs)
    assert taken.columns == docs.columns and taken.count() > 0
    assert mixing.take(empty).collect() == []
    blank = spark.createDataFrame([(1, None, None, "a", None), (2, " ", None, "b", None)], SCHEMA)
    _, plan = mixing.mix(blank)
    assert [r["target"] for r in plan.collect()] == [0.0, 0.0]


# -- packing ------------------------------------------------------------------------------


def test_best_fit_takes_the_tightest_compatible_bin():
    placed = packing.best_fit([7, 6, 3, 3], ["a", "b", "c", "d"], [1, 2, 2, None], 10)
    # The first 3 fits bin 0 exactly; the second goes to bin 1.
    assert placed == [(0, 0), (1, 0), (0, 7), (1, 6)]
    placed = packing.best_fit([7, 6, 3], ["a", "b", "c"], [2, 1, 2], 10)
    assert placed[2] == (1, 6)  # bin 0 is tighter but has a copy
    placed = packing.best_fit([2, 2, 2], ["a"] * 3, [None] * 3, 10, per_source=2)
    assert [b for b, _ in placed] == [0, 0, 1]


def test_packing_keeps_its_rules(spark, docs):
    pick = random.Random(5)
    rows = [(i, "w " * pick.choice([0, 3, 20, 50, 130, 450]) + str(i % 90), None, pick.choice("aaab"), None) for i in range(900)]
    found = packing.pack_documents(wide(spark.createDataFrame(rows, SCHEMA)).drop("size"), capacity=200, bins_per_group=20)
    text = {r[0]: r[1] for r in rows}
    bins, pieces = {}, {}
    for r in found.collect():
        bins.setdefault(r["bin"], []).append(r)
        pieces.setdefault(r["doc_id"], []).append((r["first_word"], r["n_words"]))
    assert set(pieces) == set(text)
    for i, own in pieces.items():
        own.sort()
        assert [a for a, _ in own] == [200 * k for k in range(len(own))]
        assert sum(n for _, n in own) == len(text[i].split())
    for own in bins.values():
        own.sort(key=lambda r: r["bin_offset"])
        ends = [0, *(r["bin_offset"] + r["n_words"] for r in own)]
        assert [r["bin_offset"] for r in own] == ends[:-1] and ends[-1] <= 200
        assert len({text[r["doc_id"]] for r in own}) == len(own)
        assert max(sum(r["source"] == s for r in own) for s in "ab") <= packing.PER_SOURCE


def test_packing_odd_rows(docs, empty):
    got = packing.pack_documents(docs).collect()
    blank = [r for r in got if r["bin"] is None]
    assert len(got) == docs.count() and all(r["n_words"] == 0 for r in blank) and len(blank) == 3
    assert packing.pack_documents(empty).collect() == []


# -- tokens -------------------------------------------------------------------------------


def test_token_counts_equal_the_encoder(docs, empty, monkeypatch):
    with open(token_counts.VOCABULARY, "rb") as file:
        encoder = token_counts.load_encoder(file.read(), token_counts.split_pattern())
    want = sorted((r["doc_id"] or -1, len(encoder.encode_ordinary(r["text"] or ""))) for r in docs.collect())
    got = sorted((r["doc_id"] or -1, r["n_tokens"]) for r in token_counts.document_tokens(wide(docs)).collect())
    assert got == want
    assert token_counts.document_tokens(empty).collect() == []


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64])
def test_lengths_do_not_depend_on_where_blocks_end(spark, tmp_path, block):
    pick = random.Random(block)
    for name in ("a", "b"):
        lengths = [pick.choice([0, 0, 1, 2, 5, 20]) for _ in range(30)]
        flat = [t for n in lengths for t in [*(pick.randrange(100) for _ in range(n)), token_counts.SEPARATOR]]
        flat += [1, 2, 3] if name == "b" else []  # a file without a last separator
        (tmp_path / f"{name}.bin").write_bytes(np.array(flat, np.uint16).tobytes())
        want = lengths + ([3] if name == "b" else [])
        blocks = token_counts.read_token_files(spark, str(tmp_path / f"{name}.bin"), block)
        got = token_counts.count_tokens(blocks).orderBy("document").collect()
        assert [r["n_tokens"] for r in got] == want


# -- all of them on nothing ---------------------------------------------------------------


def test_empty_tables(empty):
    assert minhash.near_duplicates(empty).collect() == []
    assert suffix.remove_repeats(empty).collect() == []
