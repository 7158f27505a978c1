"""Exact top-k search by inner product, term at a time over dense score arrays.

A vector's components that are not zero are its terms. Candidates are kept in blocks, and a
block's postings have for each term the rows that have it and their weights. For a block of
queries and a block of candidates there is one dense array of scores; each term of the queries
scatters its weighted postings into it. The k best of each query are then selected by
partitioning, and the blocks' results merged. Every candidate is scored.

Candidates move once. They are dealt to groups of blocks that fit into a task, which holds their
postings while all blocks of queries are streamed past, and sends on k rows for each query. So what
is moved is the candidates, and the queries once for each group.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.scratch import tasks_for, written

CANDIDATES = 4096
QUERIES = 512
SCALE = 1024
LIMIT = float(1 << 43)
# A component that a task holds takes so many bytes: a row and a weight.
HELD_ENTRY = 16
HELD_BYTES = 128 << 20


class Postings:
    """Per term, the rows that have it and their weights, in the order of the terms."""

    def __init__(self, vectors: pa.Array):
        lengths = np.diff(vectors.offsets.to_numpy())
        values = vectors.flatten().to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(lengths)), lengths)
        term = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        held = np.flatnonzero(values)
        order = held[np.argsort(term[held], kind="stable")]
        self.n = len(lengths)
        self.rows, self.weights = row[order], values[order]
        self.terms, first = np.unique(term[order], return_index=True)
        self.cuts = np.r_[first, len(order)]

    def of(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        cuts = zip(self.terms, self.cuts[:-1], self.cuts[1:], strict=True)
        return {int(t): (self.rows[a:b], self.weights[a:b]) for t, a, b in cuts}


def scores(queries: Postings, candidates: Postings) -> np.ndarray:
    """Inner products of every query with every candidate, one term after the other.

    Where a sum of products may have more than 62 bits, all of them are Python integers.
    """
    most = [float(np.abs(side.weights).max(initial=0)) for side in (queries, candidates)]
    fits = most[0] * most[1] * max(len(queries.terms), 1) < float(1 << 62)
    total = np.zeros((queries.n, candidates.n), dtype=np.int64 if fits else object)
    other = candidates.of()
    for term, (rows, weights) in queries.of().items():
        if term in other:
            at, by = other[term]
            if len(at) == candidates.n:
                for row, weight in zip(rows, weights if fits else weights.tolist(), strict=True):
                    total[row] += weight * (by if fits else by.astype(object))
            else:
                for row, weight in zip(rows, weights if fits else weights.tolist(), strict=True):
                    total[row, at] += weight * (by if fits else by.astype(object))
    return total


def best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Where the k highest scores are, ties to smaller ids, best first."""
    if len(score) > k:
        bar = np.partition(score, len(score) - k)[len(score) - k]
        at = np.flatnonzero(score >= bar)  # ties with the last one included
    else:
        at = np.arange(len(score))
    if score.dtype == object:
        return np.array(sorted(at.tolist(), key=lambda i: (-score[i], ids[i]))[:k], dtype=np.int64)
    return at[np.lexsort((ids[at], -score[at]))][:k]


def _decimals(parts: list[np.ndarray]) -> pa.Array:
    whole = [
        pa.array([Decimal(v) for v in part.tolist()], pa.decimal128(38, 0))
        if part.dtype == object
        else pa.array(part).cast(pa.decimal128(38, 0))
        for part in parts
    ]
    return pa.concat_arrays(whole)


def _merged(asked: np.ndarray, found: list[np.ndarray], score: np.ndarray, k: int) -> np.ndarray:
    """Where each query's k best are in rows of (query, id, score); of rows with one id the best counts."""
    if score.dtype == object:
        order = np.array(sorted(range(len(score)), key=lambda i: (asked[i], found[i], -score[i])), dtype=np.int64)
    else:
        order = np.lexsort((-score, found, asked))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (asked[order[1:]] != asked[order[:-1]]) | (found[order[1:]] != found[order[:-1]])
    order = order[new]
    cuts = np.r_[np.flatnonzero(np.r_[True, asked[order[1:]] != asked[order[:-1]]]), len(order)]
    parts = [order[x:y] for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
    return np.concatenate([p[best(score[p], found[p], k)] for p in parts])


class _Held:
    """The candidates of a task, in blocks of postings, while queries are streamed past them."""

    def __init__(self):
        self.blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray, Postings]] = []

    def add(self, rows: pa.StructArray) -> None:
        ids = rows.field("id").to_numpy()
        order = np.argsort(ids, kind="stable")
        distinct, first = np.unique(ids[order], return_index=True)
        self.blocks.append((distinct, first, order, Postings(rows.field("vector"))))

    def best(self, rows: pa.StructArray, k: int) -> pa.RecordBatch | None:
        asked, queries = rows.field("id").to_numpy(), Postings(rows.field("vector"))
        out: list[list[np.ndarray]] = [[], [], []]
        for ids, first, order, candidates in self.blocks:
            total = scores(queries, candidates)
            total = np.maximum.reduceat(total[:, order], first, axis=1)  # of rows with one id the best counts
            for q, name in enumerate(asked):
                others = np.flatnonzero(ids != name)
                at = others[best(total[q][others], ids[others], k)]
                for column, values in zip(out, (np.full(len(at), name), ids[at], total[q][at]), strict=True):
                    column.append(values)
        if not out[0] or not sum(map(len, out[0])):
            return None
        names, found = np.concatenate(out[0]), np.concatenate(out[1])
        exact = any(part.dtype == object for part in out[2])
        score = np.concatenate([p.astype(object) for p in out[2]] if exact else out[2])
        at = _merged(names, found, score, k)
        values = [pa.array(names[at], pa.int64()), pa.array(found[at], pa.int64()), _decimals([score[at]])]
        return pa.RecordBatch.from_arrays(values, ["query_id", "vec_id", "score"])


def _search(k: int):
    """Rows come by group, its blocks of candidates (kind 0) before the blocks of queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, _Held()
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column("group")[i].as_py() != group:
                    group, held = batch.column("group")[i].as_py(), _Held()
                rows = batch.column("rows")[i].values
                if batch.column("kind")[i].as_py() == 0:
                    held.add(rows)
                elif (found := held.best(rows, k)) is not None:
                    yield found

    return run


def _blocks(rows: DataFrame, size: int, count: int) -> DataFrame:
    """Rows dealt by a hash to blocks of about ``size``; a row that is repeated is one."""
    number = F.pmod(F.xxhash64("id", "vector"), F.lit(max(1, -(-count // size)))).cast("int")
    return rows.groupBy(number.alias("block")).agg(F.collect_set(F.struct("id", "vector")).alias("rows"))


def top_k(
    table: DataFrame, queries_every: int, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding",
    held_bytes: int = HELD_BYTES,
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score, exact in a decimal: for each query its k highest.

    Queries are the rows whose id is divisible by ``queries_every``; candidates are all rows but
    those of the query's own id. Components x count as floor(1024 * x). Ties go to the smaller
    id. Of candidates with an equal id the best counts; of queries with an equal id the least
    vector asks. A missing component is zero, so vectors may differ in length. Rows without an id,
    and vectors that are null or have a null or a value that is not finite, take no part; nor do
    those with a component of 2**43 or more, which is 2**53 as a whole number and past what a double
    counts exactly. With
    fewer than k candidates all are returned, with none nothing.
    """
    vector = F.transform(F.col(vector_column).cast("array<double>"), lambda x: F.floor(x * SCALE).cast("long"))
    fine = F.forall(
        F.col(vector_column).cast("array<double>"),
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT),
    )
    rows = table.filter(fine & F.col(id_column).isNotNull())
    rows = written(rows.select(F.col(id_column).cast("long").alias("id"), vector.alias("vector")), "topk-rows")
    asked = rows.filter(F.col("id") % queries_every == 0).groupBy("id").agg(F.min("vector").alias("vector"))
    asked = written(asked, "topk-queries")
    held = F.sum(HELD_ENTRY * F.size("vector")).alias("bytes")
    size = rows.agg(F.count("*").alias("n"), held).first()
    n_asked = asked.count()

    queries = _blocks(asked, QUERIES, n_asked)
    candidates = _blocks(rows, CANDIDATES, size["n"])
    # Candidates are dealt once, to groups that a task can hold; each block of queries goes to every group.
    n_blocks = max(1, -(-size["n"] // CANDIDATES))
    groups = min(n_blocks, max(tasks_for(table), -(-(size["bytes"] or 0) // held_bytes)))
    dealt = candidates.select((F.col("block") % groups).alias("group"), F.lit(0).alias("kind"), "rows")
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    streamed = queries.select(every, F.lit(1).alias("kind"), "rows")
    met = dealt.unionByName(streamed).repartition(groups, "group").sortWithinPartitions("group", "kind")
    found = met.mapInArrow(_search(k), "query_id long, vec_id long, score decimal(38,0)")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
