"""Best-fit packing of documents into sequences, with conflicts.

A sequence (bin) holds ``capacity`` words. Two documents of one duplicate cluster never share
a bin, and a bin takes at most ``per_source`` documents of one source. Open bins are kept in
the order of their residual room, and each carries a bitmap of its duplicate clusters and
``per_source`` bitmaps of its sources (the j-th has the sources it holds j times). A document
is put into the successor of its size in that order; while that bin conflicts, the search
goes on to the next larger residual. The first compatible bin is the tightest one.

A document longer than a bin is cut: full pieces have bins of their own, the rest is packed.
Documents are dealt by a hash to groups of about ``bins_per_group`` bins, whose number follows
from the sum of all words, and each group is packed by one task from ids and numbers alone.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm.mixing import word_count
from changeflow.llm.scratch import written

CAPACITY = 2048
BINS_PER_GROUP = 1024
PER_SOURCE = 4


def best_fit(
    sizes: Sequence[int], sources: Sequence, clusters: Sequence, capacity: int, per_source: int = PER_SOURCE
) -> list[tuple[int, int]]:
    """(bin, offset) for each document, which come in any order and are placed largest first.

    No size is above ``capacity``. A null cluster conflicts with nothing; a null source is one.
    """
    often = {c for c, n in Counter(clusters).items() if n > 1 and c is not None}
    cluster_bit = {c: 1 << i for i, c in enumerate(sorted(often))}
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(sources))}
    placed: list[tuple[int, int]] = [(0, 0)] * len(sizes)
    room: list[tuple[int, int]] = []  # (residual, bin), sorted
    cluster_map: list[int] = []
    source_maps: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size, cluster, source = sizes[i], cluster_bit.get(clusters[i], 0), source_bit[sources[i]]
        at = bisect_left(room, (size, -1))
        while at < len(room):
            b = room[at][1]
            if not (cluster_map[b] & cluster or source_maps[b][-1] & source):
                break
            at += 1
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b = capacity, len(cluster_map)
            cluster_map.append(0)
            source_maps.append([0] * per_source)
        placed[i] = (b, capacity - left)
        cluster_map[b] |= cluster
        maps = source_maps[b]
        maps[next(j for j in range(per_source) if not maps[j] & source)] |= source
        if left > size:
            insort(room, (left - size, b))
    return placed


def _packer(capacity: int, per_source: int):
    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("size", "descending"), ("row", "ascending")])
        size = group.column("size").to_pylist()
        rest = [s % capacity or capacity for s in size]
        placed = best_fit(
            rest, group.column("source").to_pylist(), group.column("cluster").to_pylist(), capacity, per_source
        )
        bins = max((b for b, _ in placed), default=-1) + 1
        row, piece, first, length, bin_, offset = [], [], [], [], [], []
        for i, (b, at) in enumerate(placed):
            full = (size[i] - rest[i]) // capacity
            row += [i] * (full + 1)
            piece += range(full + 1)
            first += [p * capacity for p in range(full + 1)]
            length += [capacity] * full + [rest[i]]
            bin_ += [*range(bins, bins + full), b]
            offset += [0] * full + [at]
            bins += full
        number = group.column("group")[0].as_py()
        columns = {n: group.column(n).take(pa.array(row, pa.int64())) for n in ("id", "source", "size")}
        columns |= {n: pa.array(v, pa.int64()) for n, v in (("piece", piece), ("first_word", first), ("n_words", length))}
        columns["bin"] = pa.array(np.array(bin_, np.int64) + (number << 32), pa.int64())
        columns["bin_offset"] = pa.array(offset, pa.int64())
        return pa.table(columns)

    return pack


def pack_documents(
    docs: DataFrame, id_column: str = "doc_id", source_column: str = "source", text_column: str = "text",
    capacity: int = CAPACITY, per_source: int = PER_SOURCE, bins_per_group: int = BINS_PER_GROUP,
) -> DataFrame:
    """One row per piece: id, source, size, piece, first_word, n_words, bin, bin_offset.

    Duplicate clusters are documents of equal text, so copies that a mix made are kept apart.
    Each row of ``docs`` is packed once, repeated rows each. Documents without words (null,
    empty, white space) get a piece of no words and a null bin. Ids and sources may be null.
    An empty table gives an empty result.
    """
    rows = docs.select(
        F.col(id_column).alias("id"),
        F.col(source_column).alias("source"),
        word_count(text_column).alias("size"),
        F.xxhash64(text_column).alias("cluster"),
    )
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "pack-rows")
    words = rows.agg(F.sum("size")).first()[0] or 0
    groups = -(-words // (capacity * bins_per_group)) or 1
    dealt = rows.filter("size > 0").withColumn("group", F.pmod(F.xxhash64("row"), F.lit(groups)))
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = (
        f"id {kind['id']}, source {kind['source']}, size long, piece long, first_word long,"
        " n_words long, bin long, bin_offset long"
    )
    packed = dealt.groupBy("group").applyInArrow(_packer(capacity, per_source), schema)
    zero = F.lit(0).cast("long")
    empty = rows.filter("size = 0").select(
        "id", "source", "size", zero.alias("piece"), zero.alias("first_word"), zero.alias("n_words"),
        F.lit(None).cast("long").alias("bin"), zero.alias("bin_offset"),
    )
    out = packed.unionAll(empty)
    return out.withColumnRenamed("id", id_column).withColumnRenamed("source", source_column)
