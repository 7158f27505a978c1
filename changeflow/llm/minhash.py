"""Near-duplicate texts by MinHash with tensored banding.

A document is the set of its distinct shingles of five words. Ordinary banding would need a
fresh group of minhashes for each of its tables. Here there are two small collections of
``HALVES`` groups with ``ROWS`` minhashes each, and a table for every pair of a group from
the one and a group from the other: 100 tables of four minhashes each from 40 minhashes
instead of 400. Two documents of similarity s meet in a table with probability
(1 - (1 - s**2)**10)**2, which is 0.9995 at s = 0.75 and more above.

What follows the tables is exact. Members of a bucket are first compared with its least member
only, and the links found join them to components. Buckets that still hold several components
are looked at again: components with members that may be similar form a family. The sets of a
family meet once, and every two of its members that may be similar and are not joined yet are
compared. Whether two may be similar is a bound that never errs to the other side: their sizes,
and a bit set of each with at least as many bits as it has shingles, in which every shingle
turns one bit; sets differ in as many shingles or more as these differ in bits. So a bucket of
thousands of copies costs a comparison a member, only links that join something leave a task,
and no link that the tables show is missed: what is missed are pairs that meet in no table.
Comparing is always done on the full sets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm import kernels
from changeflow.llm.components import components, spanning
from changeflow.llm.scratch import tasks_for, written

HALVES = 10
ROWS = 2
TABLES = HALVES * HALVES
HASHES = 2 * HALVES * ROWS
# Members that are compared with each other in one go, and how many shingles they may have
# together. Larger buckets and families are cut into blocks, and each two blocks are compared
# by one task.
BLOCK = 2048
BLOCK_SHINGLES = 1 << 21

_random = np.random.default_rng(75)
_FLIP = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_TIMES = _random.integers(1, 1 << 63, HASHES, dtype=np.uint64) | np.uint64(1)
_GROUP = _random.integers(1, 1 << 63, (2, ROWS), dtype=np.uint64) | np.uint64(1)
_TABLE = _random.integers(1, 1 << 63, TABLES, dtype=np.uint64)


def signatures(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each text with shingles, in order, its minhashes as 32-bit numbers."""
    starts = bounds[:-1][np.diff(bounds) > 0]
    out = np.empty((len(starts), HASHES), dtype=np.uint32)
    if len(starts):
        for j in range(HASHES):
            least = np.minimum.reduceat((hashes ^ _FLIP[j]) * _TIMES[j], starts)
            out[:, j] = least >> np.uint64(32)
    return out


def table_keys(signature: np.ndarray) -> np.ndarray:
    """The keys of the 100 tables: one group of the first collection with one of the second."""
    groups = signature.astype(np.uint64).reshape(len(signature), 2, HALVES, ROWS)
    halves = kernels.mixed((groups * _GROUP[None, :, None, :]).sum(axis=3, dtype=np.uint64))
    pairs = halves[:, 0, :, None] * np.uint64(0x9E3779B97F4A7C15) + halves[:, 1, None, :]
    return kernels.mixed(pairs.reshape(len(signature), TABLES) ^ _TABLE)


def parity(hashes: np.ndarray) -> np.ndarray:
    """A set as bits, each turned by every shingle that falls on it: 64-bit words, a power of two
    of them, with at least one bit a shingle."""
    bits = 1 << max(6, (len(hashes) - 1).bit_length())
    at = (hashes & np.uint64(bits - 1)).astype(np.int64)
    odd = np.bincount(at, minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.uint64)


class Bound:
    """Sizes and bits of sets, and which of them may be similar to ``percent`` hundredths."""

    def __init__(self, size: np.ndarray, words: np.ndarray, bounds: np.ndarray, percent: int):
        self.size, self.words, self.percent = size, words, percent
        self.start, self.width = bounds[:-1], np.diff(bounds)

    def within(self, i: int, others: np.ndarray) -> np.ndarray:
        """Those of the others whose similarity to ``i`` is not ruled out. None that is similar
        enough is left out: a similarity of p hundredths is a difference of at most
        (100 - p) / (100 + p) of both sizes together, and the bits differ in no more."""
        own = self.size[i]
        sizes = self.size[others]
        others = others[100 * np.minimum(sizes, own) >= self.percent * np.maximum(sizes, own)]
        differ = np.zeros(len(others), dtype=np.int64)
        mine = self.words[self.start[i] : self.start[i] + self.width[i]]
        widths = self.width[others]
        for width in np.unique(widths):
            of = np.flatnonzero(widths == width)
            theirs = self.words[self.start[others[of], None] + np.arange(width)]
            # The longer of two folds to the shorter, as if it had been made with fewer bits.
            least = min(width, len(mine))
            theirs = np.bitwise_xor.reduce(theirs.reshape(len(of), -1, least), axis=1)
            folded = np.bitwise_xor.reduce(mine.reshape(-1, least), axis=0)
            differ[of] = np.bitwise_count(theirs ^ folded).sum(axis=1, dtype=np.int64)
        return others[(100 + self.percent) * differ <= (100 - self.percent) * (self.size[others] + own)]


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in kernels.slices(batches, 2048):
        data, offsets = kernels.text_bytes(batch.column(1))
        for a, b in kernels.pieces(offsets):
            part = data[offsets[a] : offsets[b]]
            hashes, bounds = kernels.shingles(part, offsets[a : b + 1] - offsets[a])
            sets = kernels.sets_of(hashes, bounds)
            signed = iter(signatures(hashes, bounds))
            marks = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(marks, pa.binary()),
                    pa.array([next(signed).tobytes() if len(s) else None for s in sets], pa.binary()),
                    pa.array([parity(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                ["id", "n_shingles", "mark", "signature", "parity"],
            )


def _signature_rows(column: pa.Array) -> np.ndarray:
    return np.frombuffer(kernels.text_bytes(column)[0], dtype=np.uint32).reshape(-1, HASHES)


def _star(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of equal keys: (key, least id) of each, and (least id, other id) within them."""
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    first = np.r_[True, keys[1:] != keys[:-1]]
    hub = ids[first][np.cumsum(first) - 1]
    other = hub != ids
    a, b = hub[other], ids[other]
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return keys[first], ids[first], a[new], b[new]


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Table entries, one per key and batch, and links between what met within the batch."""
    for batch in kernels.slices(batches, 4096):
        ids = batch.column(0).to_numpy(zero_copy_only=False)
        keys = table_keys(_signature_rows(batch.column(1)))
        key, hub, a, b = _star(keys.ravel(), np.repeat(ids, TABLES))
        yield _pairs_batch(np.r_[key.view(np.int64), a], np.r_[hub, b], np.arange(len(key) + len(a)) < len(key))


def _pairs_batch(a: np.ndarray, b: np.ndarray, entry: np.ndarray | None = None) -> pa.RecordBatch:
    columns, names = [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
    if entry is not None:
        columns, names = [*columns, pa.array(entry, pa.bool_())], [*names, "entry"]
    return pa.RecordBatch.from_arrays(columns, names)


def _all_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in kernels.slices(batches, 512):
        keys = table_keys(_signature_rows(batch.column(3))).view(np.int64).ravel()
        at = pa.array(np.repeat(np.arange(batch.num_rows), TABLES))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), *(batch.column(n).take(at) for n in range(3))], ["key", "id", "component", "n_shingles"]
        )


def _groups(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]]:
    """Whole groups of rows sorted by key, x and y: where block x and where block y of each are."""
    marks = np.stack([rows.column(n).to_numpy() for n in ("key", "x", "y")])
    cuts = np.flatnonzero(np.r_[True, (marks[:, 1:] != marks[:, :-1]).any(axis=0), True])
    part = {n: rows.column(n).to_numpy() for n in ("id", "component", "side")}
    for s, e in zip(cuts[:-1], cuts[1:], strict=True):
        left = np.flatnonzero(part["side"][s:e] == marks[1, s]) + s
        right = np.flatnonzero(part["side"][s:e] == marks[2, s]) + s
        yield left, right, part


def _by_group(compare):
    """Apply to whole groups, as many at a time as a batch has. A group has two blocks at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(n).to_numpy() for n in ("key", "x", "y")])
            if held and tuple(marks[:, 0]) != last:
                yield from compare(pa.Table.from_batches(held))
                held = []
            last = tuple(marks[:, -1])
            other = np.flatnonzero((marks != marks[:, -1:]).any(axis=0))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield from compare(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from compare(pa.Table.from_batches(held))

    return run


def _relatives(percent: int):
    def relate(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """Of buckets, which components have members that may be similar: links of a spanning forest."""
        words, offsets = kernels.text_bytes(rows.column("parity"))
        size = rows.column("n_shingles").to_numpy()
        bound, found = Bound(size, np.frombuffer(words, np.uint64), offsets // 8, percent), []
        for left, right, part in _groups(rows):
            comp = part["component"]
            edges = []
            for i in left:
                others = right[comp[right] != comp[i]]
                if len(others):
                    others = np.unique(comp[bound.within(i, others)])
                    edges.append(np.stack([np.full(len(others), comp[i]), others]))
            if edges:
                found.append(np.stack(spanning(*np.concatenate(edges, axis=1))))
        if found:
            pairs = np.unique(np.concatenate(found, axis=1), axis=1)
            yield _pairs_batch(pairs[0], pairs[1])

    return relate


def _compared(percent: int):
    def compare(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        """Of families, the links that join two components."""
        data = rows.column("shingles").combine_chunks()
        flat, offsets = kernels.text_bytes(data)
        flat, bounds = np.frombuffer(flat, np.uint64), offsets // 8
        size, found = np.diff(bounds), []
        bits = [parity(flat[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        widths = np.cumsum([0, *map(len, bits)])
        bound = Bound(size, np.concatenate(bits), widths, percent)
        _, flat = np.unique(flat, return_inverse=True)
        mark = np.zeros(flat.max(initial=-1) + 1, dtype=np.int64)
        for left, right, part in _groups(rows):
            ids, label = part["id"], part["component"].copy()
            for i in left:
                apart = right[label[right] != label[i]]
                if len(apart):
                    apart = bound.within(i, apart)
                if not len(apart):
                    continue
                own = flat[bounds[i] : bounds[i + 1]]
                mark[own] = 1
                before = np.cumsum(size[apart]) - size[apart]
                at = np.repeat(bounds[apart] - before, size[apart]) + np.arange(size[apart].sum())
                both = np.add.reduceat(mark[flat[at]], before)
                mark[own] = 0
                linked = apart[100 * both >= percent * (size[apart] + size[i] - both)]
                for j in linked:
                    if label[j] != label[i]:
                        found.append((ids[i], ids[j]))
                        label[label == label[j]] = label[i]
        if found:
            yield _pairs_batch(*(np.array(x) for x in zip(*found, strict=True)))

    return compare


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    data, offsets = kernels.text_bytes(column)
    for a, b in kernels.pieces(offsets):
        part = data[offsets[a] : offsets[b]]
        yield from kernels.sets_of(*kernels.shingles(part, offsets[a : b + 1] - offsets[a]))


def _verified(percent: int):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in kernels.slices(batches, 1024):
            texts = zip(*(_sets(batch.column(n)) for n in ("text_a", "text_b")), strict=True)
            keep = []
            for a, b in texts:
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return verify


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in kernels.slices(batches, 1024):
        sets = pa.array([x.tobytes() for x in _sets(batch.column(1))], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), sets], ["id", "shingles"])


def _links(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs of ids whose full sets are similar enough.

    The texts come by joins, which Spark splits where an id is in very many pairs.
    """
    a = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))
    joined = pairs.hint("merge").join(a, "a").hint("merge").join(b, "b").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(_verified(percent), "a long, b long")


def _in_blocks(members: DataFrame, key: str, payload: DataFrame, tasks: int) -> DataFrame:
    """Rows of each key by pairs of blocks, sorted, so that any two members of different
    components meet somewhere.

    The largest component of a key needs no comparison with itself. Its members are dealt to
    shards, which the blocks of the others come to: while those are few, as stragglers around
    a large group of copies are, every member of it moves once. ``payload`` has what else rows
    need, by id; only members of keys with several components are given it.
    """
    share = F.greatest(F.lit(1 / BLOCK), F.col("n_shingles") / BLOCK_SHINGLES)
    sizes = members.groupBy(key, "component").agg(F.sum(share).alias("n"))
    of_key = sizes.groupBy(key).agg(
        F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("all"), F.count("*").alias("parts")
    )
    of_key = of_key.filter("parts > 1").select(
        key,
        F.col("main.component").alias("main"),
        F.ceil("main.n").cast("int").alias("shards"),
        F.ceil(F.col("all") - F.col("main.n")).cast("int").alias("blocks"),
    )
    rows = members.select(key, "id", "component").distinct().join(of_key, key).join(payload, "id")
    # Blocks of the others are numbered after the shards.
    in_main = F.col("component") == F.col("main")
    side = F.when(in_main, F.pmod(F.xxhash64("id"), F.col("shards"))).otherwise(
        F.col("shards") + F.pmod(F.xxhash64("id"), F.col("blocks"))
    )
    rows = rows.withColumn("side", side.cast("int"))
    first, last = F.col("shards"), F.col("shards") + F.col("blocks") - 1
    # As x, a block meets each shard and each block up to itself; as y, each block from itself.
    as_x = F.when(in_main, F.array().cast("array<struct<x:int,y:int>>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.col("side")), lambda y: F.struct(F.col("side").alias("x"), y.alias("y")))
    )
    as_y = F.transform(
        F.sequence(F.greatest(first, F.when(in_main, first).otherwise(F.col("side") + 1)), F.greatest(last, first)),
        lambda x: F.struct(x.alias("x"), F.col("side").alias("y")),
    )
    as_y = F.when(in_main | (F.col("side") < last), as_y).otherwise(F.array().cast("array<struct<x:int,y:int>>"))
    rows = rows.withColumn("at", F.explode(F.concat(as_x, as_y)))
    rows = rows.select(F.col(key).alias("key"), "at.x", "at.y", "side", "id", "component", *payload.drop("id").columns)
    return rows.repartition(tasks, "key", "x", "y").sortWithinPartitions("key", "x", "y", "id")


def near_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = 75
) -> DataFrame:
    """One row per document: id, n_shingles, component_id and kept.

    ``component_id`` is the least id reachable by links, a link being a similarity of the two
    sets of shingles of ``percent`` hundredths or more; ``kept`` marks the one document of
    each group that stays. A null or empty text, or one of white space only, has no shingles
    and links with nothing. Rows of equal id are one node that has all their texts. A row
    without an id links with nothing, has no component and is kept. An empty table gives an
    empty result. Columns other than the two named are not looked at.
    """
    docs = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    schema = "id long, n_shingles long, mark binary, signature binary, parity binary"
    rows = written(docs.mapInArrow(_sketch, schema), "minhash-sets")

    known = rows.filter("id IS NOT NULL AND mark IS NOT NULL")
    # Equal sets are one class, which its least id stands for from here on.
    classes = known.groupBy("mark").agg(F.min("id").alias("rep"))
    reps = known.groupBy("mark").agg(F.min(F.struct("id", "n_shingles", "signature", "parity")).alias("r")).select("r.*")
    reps = written(reps, "minhash-classes")
    several = known.groupBy("id").agg(F.min("mark").alias("lo"), F.max("mark").alias("hi")).filter("lo <> hi")
    several = known.join(several.select("id"), "id", "left_semi").join(classes, "mark")
    same = several.select(F.col("id").alias("a"), F.col("rep").alias("b")).filter("a <> b")

    signed = reps.select("id", "signature")
    entries = written(signed.mapInArrow(_entries, "a long, b long, entry boolean"), "minhash-entries")
    met = entries.filter("entry").groupBy("a").agg(F.min("b").alias("hub"), F.max("b").alias("last"))
    met = entries.filter("entry").join(met.filter("hub < last"), "a").filter("b <> hub")
    pairs = entries.filter("NOT entry").select("a", "b").unionAll(met.select(F.col("hub").alias("a"), "b"))
    pairs = written(pairs.distinct(), "minhash-pairs")
    ends = pairs.select(F.col("a").alias("id")).unionAll(pairs.select(F.col("b").alias("id"))).distinct()
    ends = written(ends, "minhash-ends")
    # The merge hint keeps one plan at all sizes: ids of copies grow with the table.
    texts = written(docs.join(ends.hint("merge"), "id", "left_semi").distinct(), "minhash-texts")
    first = written(_links(pairs, texts, percent).unionAll(same), "minhash-links")

    # What met in a bucket and is not joined so far.
    tasks = tasks_for(docs)
    groups = written(components(first, "minhash-groups"), "minhash-groups")
    members = reps.join(ends, "id", "left_semi").join(groups, F.col("id") == F.col("node"), "left")
    members = members.select("id", F.coalesce("component", "id").alias("component"), "n_shingles", "signature")
    members = written(members, "minhash-members")
    keyed = members.mapInArrow(_all_keys, "key long, id long, component long, n_shingles long")
    bits = reps.select("id", "n_shingles", "parity")
    near = _in_blocks(keyed, "key", bits, tasks)
    relatives = near.mapInArrow(_by_group(_relatives(percent)), "a long, b long")
    families = written(components(relatives, "minhash-families"), "minhash-families")
    families = families.select(F.col("node").alias("component"), F.col("component").alias("family"))
    members = members.join(families, "component").select("family", "id", "component", "n_shingles")
    sets = texts.mapInArrow(_set_rows, "id long, shingles binary")
    members = _in_blocks(members, "family", sets, tasks)
    second = written(members.mapInArrow(_by_group(_compared(percent)), "a long, b long"), "minhash-more")

    joined = components(first.unionAll(second), "minhash-components")
    classes = classes.join(joined, F.col("rep") == F.col("node"), "left")
    classes = classes.select("mark", F.coalesce("component", "rep").alias("component"))
    out = rows.join(classes, "mark", "left")
    # A row without words may share its id with one that has some.
    alone = several.select("id").distinct().join(joined, F.col("id") == F.col("node"))
    out = out.join(alone.select("id", F.col("component").alias("by_id")), "id", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "by_id", "id"))
    return out.select(
        F.col("id").alias(id_column),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
