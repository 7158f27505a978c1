"""Near-duplicate vectors by an epsilon grid order join.

A cosine of c or more between two vectors is a distance of at most e = sqrt(2 - 2c) between
their directions. Directions are projected on a few leading principal axes and sorted by the
cells of a grid of width e there, first axis first: the epsilon grid order. The sorted
sequence is cut into blocks, each with the box its projections fill. Two blocks whose boxes
are more than e apart have no links; others are joined by halving both again and again,
skipping halves that are too far apart, until small enough to multiply. Projecting shortens
distances, so nothing within e is ever skipped. Candidates are confirmed in double precision.

Equal vectors are one class before all that. Links are counted where they are found and only
a spanning forest of them goes on, so a group of copies costs what its size is, squared only
in the arithmetic.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.components import components, spanning
from changeflow.llm.scratch import tasks_for, written

AXES = 4
BLOCK = 4096
LEAF = 256
# Vectors the axes are fitted on. Axes only decide what is skipped, never what is found.
FIT_ROWS = 10_000


def directions(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length one."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


class _Side:
    """A block in one task: ids, how many vectors each stands for, directions, projections."""

    def __init__(self, row: dict):
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.weights = np.frombuffer(row["weights"], np.int64)
        self.exact = np.frombuffer(row["vectors"], np.float64).reshape(len(self.ids), -1)
        self.rough = self.exact.astype(np.float32)
        self.spots = np.frombuffer(row["spots"], np.float64).reshape(len(self.ids), -1)


def _apart(a: np.ndarray, b: np.ndarray) -> float:
    """Squared distance of the boxes around two sets of points."""
    gap = np.maximum(np.maximum(a.min(0) - b.max(0), b.min(0) - a.max(0)), 0)
    return float((gap * gap).sum())


def join_intervals(left: _Side, right: _Side, cosine: float, same: bool) -> tuple[list, list]:
    """(rows, columns) of pairs with at least this cosine, in parts; of one block, each pair once."""
    reach = 2 - 2 * cosine + 1e-9
    rows, columns = [], []

    def join(a: int, b: int, c: int, d: int) -> None:
        if same and c < a or _apart(left.spots[a:b], right.spots[c:d]) > reach:
            return
        if b - a <= LEAF and d - c <= LEAF:
            i, j = np.nonzero(left.rough[a:b] @ right.rough[c:d].T >= cosine - 1e-4)
            if same:
                i, j = i[i + a < j + c], j[i + a < j + c]
            if len(i):
                sure = np.einsum("ij,ij->i", left.exact[a + i], right.exact[c + j]) >= cosine
                if sure.any():
                    rows.append(a + i[sure])
                    columns.append(c + j[sure])
            return
        halves = [(a, b)] if b - a <= LEAF else [(a, (a + b) // 2), ((a + b) // 2, b)]
        others = [(c, d)] if d - c <= LEAF else [(c, (c + d) // 2), ((c + d) // 2, d)]
        for x in halves:
            for y in others:
                join(*x, *y)

    if len(left.ids) and len(right.ids):
        join(0, len(left.ids), 0, len(right.ids))
    return rows, columns


def _joined(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows by owner, its own block first: counts (id, links) and a forest (id, other)."""
        owner, left = None, None
        for batch in batches:
            for k in range(batch.num_rows):
                row = {n: batch.column(n)[k].as_py() for n in batch.schema.names}
                if row["owner"] != owner:
                    owner, left = row["owner"], _Side(row)
                same = row["partner"] == owner
                right = left if same else _Side(row)
                parts = list(zip(*join_intervals(left, right, cosine, same), strict=True))
                if not parts:
                    continue
                count = [np.zeros(len(left.ids), np.int64), np.zeros(len(right.ids), np.int64)]
                forest = []
                for i, j in parts:
                    np.add.at(count[0], i, right.weights[j])
                    np.add.at(count[1], j, left.weights[i])
                    forest.append(spanning(left.ids[i], right.ids[j]))
                a, b = spanning(*(np.concatenate(x) for x in zip(*forest, strict=True)))
                for side, n in ((left, count[0]), (right, count[1])):
                    own = np.flatnonzero(n)
                    if len(own):
                        yield _found(side.ids[own], side.ids[own], n[own])
                yield _found(a, b, np.zeros(len(a), np.int64))

    return run


def _found(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b, n)], ["id", "other", "n"])


def _placed(axes: dict[int, np.ndarray], width: float):
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for vector in batch.column("vector").to_pylist():
                unit = directions(np.array([vector], dtype=np.float64))[0]
                spot = _project(unit, axes)
                out.append((unit.tobytes(), spot.tobytes(), np.floor(spot / width).astype(int).tolist(), len(unit)))
            kinds = (pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.int32())
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    batch.column("weight"),
                    *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True)),
                ],
                ["node", "weight", "unit", "spot", "cells", "size"],
            )

    return place


def _project(unit: np.ndarray, axes: dict[int, np.ndarray]) -> np.ndarray:
    """On the fitted axes of this length, else on the first coordinates: both shorten distances."""
    spot = np.zeros(AXES)
    got = unit @ axes[len(unit)] if len(unit) in axes else unit[:AXES]
    spot[: len(got)] = got
    return spot


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted rows of equal length, with the box of their projections."""
    held: list[dict] = []

    def block() -> pa.RecordBatch:
        spots = np.stack([np.frombuffer(r["spot"], np.float64) for r in held])
        cells = [r["cells"][0] for r in held]
        values = {
            "size": pa.array([held[0]["size"]], pa.int32()),
            "low": pa.array([spots.min(0).tolist()], pa.list_(pa.float64())),
            "high": pa.array([spots.max(0).tolist()], pa.list_(pa.float64())),
            "first_cell": pa.array([min(cells)], pa.int32()),
            "last_cell": pa.array([max(cells)], pa.int32()),
            "ids": pa.array([np.array([r["node"] for r in held], np.int64).tobytes()], pa.binary()),
            "weights": pa.array([np.array([r["weight"] for r in held], np.int64).tobytes()], pa.binary()),
            "vectors": pa.array([b"".join(r["unit"] for r in held)], pa.binary()),
            "spots": pa.array([spots.tobytes()], pa.binary()),
        }
        return pa.RecordBatch.from_arrays(list(values.values()), list(values))

    for batch in batches:
        for row in batch.to_pylist():
            if held and (len(held) == BLOCK or held[0]["size"] != row["size"]):
                yield block()
                held = []
            held.append(row)
    if held:
        yield block()


def _axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Principal axes of the most frequent length of a bounded sample."""
    sample = vectors.orderBy(F.xxhash64("vector"), "rep").limit(FIT_ROWS).select("vector").collect()
    by_size: dict[int, list] = {}
    for row in sample:
        by_size.setdefault(len(row[0]), []).append(row[0])
    if not by_size:
        return {}
    size, rows = max(by_size.items(), key=lambda x: (len(x[1]), x[0]))
    units = directions(np.array(rows, dtype=np.float64))
    _, axes = np.linalg.eigh(units.T @ units - len(units) * np.outer(units.mean(0), units.mean(0)))
    return {size: axes[:, ::-1][:, :AXES]}


def near_vectors(
    table: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", cosine: float = 0.9
) -> DataFrame:
    """One row per vector: id, n_links, component_id (least id reachable by links) and kept.

    Two vectors are linked if their cosine is ``cosine`` or more. A vector that is null, empty or
    zero, or has a null or a value that is not finite, links with nothing, and so do vectors of
    different lengths with each other. Rows of equal id count as vectors of their own, but are
    one node of the graph. A row without an id has no links and no component and is kept. An
    empty table gives an empty result. Other columns are not looked at.
    """
    rows = table.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"))
    rows = rows.withColumn("vector", F.col("vector").cast("array<double>"))
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine &= F.exists("vector", lambda x: x != 0) & F.col("id").isNotNull()
    # An empty or null vector has no value other than zero.
    rows = rows.withColumn("vector", F.when(fine, F.transform("vector", lambda x: x + 0.0)))
    classes = rows.filter("vector IS NOT NULL").groupBy("vector")
    classes = classes.agg(F.min("id").alias("rep"), F.count("*").alias("weight"))
    classes = classes.withColumn("node", F.monotonically_increasing_id())
    classes = written(classes.select("node", "rep", "weight", "vector"), "ego-classes")

    width = float(np.sqrt(2 - 2 * cosine))
    schema = "node long, weight long, unit binary, spot binary, cells array<int>, size int"
    placed = classes.select("node", "weight", "vector").mapInArrow(_placed(_axes(classes), width), schema)
    order = ["size", *[F.col("cells")[i] for i in range(AXES)], "spot", "node"]
    sequence = placed.repartitionByRange(tasks_for(table), *order).sortWithinPartitions(*order)
    schema = (
        "size int, low array<double>, high array<double>, first_cell int, last_cell int,"
        " ids binary, weights binary, vectors binary, spots binary"
    )
    blocks = sequence.mapInArrow(_blocks, schema).withColumn("block", F.monotonically_increasing_id())
    blocks = written(blocks, "ego-blocks")

    boxes = blocks.select("block", "size", "low", "high", "first_cell", "last_cell")
    own = boxes.withColumn("cell", F.explode(F.sequence("first_cell", "last_cell")))
    near = boxes.select(*[F.col(c).alias(f"o_{c}") for c in boxes.columns])
    near = near.withColumn("o_cell", F.explode(F.expr("sequence(o_first_cell - 1, o_last_cell + 1)")))
    gaps = [
        F.greatest(F.col("low")[i] - F.col("o_high")[i], F.col("o_low")[i] - F.col("high")[i], F.lit(0.0))
        for i in range(AXES)
    ]
    apart = sum((g * g for g in gaps), F.lit(0.0))
    pairs = own.join(near, (F.col("size") == F.col("o_size")) & (F.col("cell") == F.col("o_cell")))
    pairs = pairs.filter((F.col("block") <= F.col("o_block")) & (apart <= width * width + 1e-9))
    pairs = pairs.select("block", "o_block").distinct()
    # Each of the two owns the pair about as often, which evens out the work of a block.
    odd = F.pmod(F.xxhash64("block", "o_block"), F.lit(2)) == 1
    pairs = pairs.select(
        F.when(odd, F.col("block")).otherwise(F.col("o_block")).alias("owner"),
        F.when(odd, F.col("o_block")).otherwise(F.col("block")).alias("partner"),
    )
    joined = pairs.join(blocks.withColumnRenamed("block", "partner"), "partner")
    joined = joined.select("owner", "partner", "ids", "weights", "vectors", "spots")
    joined = joined.withColumn("rank", F.col("owner") != F.col("partner"))
    joined = joined.repartition(tasks_for(table), "owner").sortWithinPartitions("owner", "rank", "partner")
    found = written(joined.drop("rank").mapInArrow(_joined(cosine), "id long, other long, n long"), "ego-links")

    links = found.filter("id <> other").select("id", "other")
    # Rows of equal id and different vectors join their classes.
    members = rows.filter("vector IS NOT NULL").join(classes.select("vector", "node"), "vector")
    many = members.groupBy("id").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).filter("lo <> hi")
    same = members.join(many.select("id", "lo"), "id").select(F.col("node").alias("id"), F.col("lo").alias("other"))
    joined = written(components(links.unionAll(same), "ego-components"), "ego-components")
    counts = found.groupBy(F.col("id").alias("node")).agg(F.sum("n").alias("n"))

    about = classes.join(counts, "node", "left").join(joined, "node", "left")
    least = about.groupBy("component").agg(F.min("rep").alias("least")).filter("component IS NOT NULL")
    about = about.join(least, "component", "left")
    linked = (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    about = about.select("vector", linked, F.coalesce("least", "rep").alias("component"))
    out = rows.join(about, "vector", "left")
    # A vector that is not fine may share its id with one that is.
    by_id = rows.join(about, "vector").groupBy("id").agg(F.min("component").alias("by_id"))
    out = out.join(by_id, "id", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "by_id", "id"))
    return out.select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
