"""Dropping lines that many documents share.

Lines are compared by their keys: the line without white space at its ends, A-Z in lower case.
Most lines are seen once, and they never leave their task. Each task fills two Bloom filters of
key hashes, one for keys it has seen and one for keys it has seen in a second document. Filters of
tasks are put together segment by segment: seen is the union, seen twice the union and what two
tasks have both seen. The second filter goes to all tasks, and only lines it suspects are
shuffled, with the bytes of their keys: those are counted exactly, a key and a document once. A
full filter suspects too many lines, never too few, so its size bounds memory and not the result.

What is repeated is looked up where documents are read if its size allows a broadcast, and
otherwise joined to the suspected lines and those, by document, to the texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.kernels import BYTE, mixed, pieces, powers, text_bytes
from changeflow.llm.scratch import tasks_for, written

MIN_DOCUMENTS = 10
MIN_CHARS = 1
BITS_A_LINE = 16
# Words of 64 bits in a filter: at most 32 MB.
MOST_WORDS = 1 << 22
_LEAST_WORDS = 1 << 10
_SEGMENT = 512
# What is repeated is sent to all tasks up to so many bytes of keys, and joined beyond.
BROADCAST_BYTES = 32 << 20
_A_KEY = 100  # bytes of a key besides its text, where it is held

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_FOLDED = BYTE.copy()
_FOLDED[65:91] = BYTE[97:123]
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@dataclass
class Lines:
    """The lines of some texts: bounds, bounds of their keys, hashes, and where each text begins."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    key_starts: np.ndarray
    key_ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray  # of each text, and the number of lines at the end
    long_enough: np.ndarray

    def key(self, line: int) -> bytes:
        return self.data[self.key_starts[line] : self.key_ends[line]].tobytes().translate(_LOWER)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def lines(data: np.ndarray, offsets: np.ndarray, min_chars: int = MIN_CHARS) -> Lines:
    """All lines of the texts in ``data``; an empty text has one empty line."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    first = np.searchsorted(breaks, offsets) + np.arange(n + 1)
    text = np.searchsorted(offsets, breaks, side="right") - 1
    starts, ends = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
    at = np.arange(len(breaks)) + text
    starts[first[:-1]], ends[first[1:] - 1] = offsets[:-1], offsets[1:]
    starts[at + 1], ends[at] = breaks + 1, breaks
    solid = np.flatnonzero(~_IS_SPACE[data])
    left, right = np.searchsorted(solid, starts), np.searchsorted(solid, ends)
    key_starts, key_ends = starts.copy(), starts.copy()
    some = right > left
    key_starts[some], key_ends[some] = solid[left[some]], solid[right[some] - 1] + 1
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_FOLDED[data] * powers(_BASE, len(data)), out=sums[1:])
    hashes = (sums[key_ends] - sums[key_starts]) * powers(_INVERSE, len(data) + 1)[key_starts]
    hashes = mixed(hashes + (key_ends - key_starts).astype(np.uint64))
    if min_chars <= 0:
        long_enough = np.ones(len(starts), dtype=bool)
    elif min_chars == 1:
        long_enough = some
    else:
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        long_enough = chars[key_ends] - chars[key_starts] >= min_chars
    return Lines(data, starts, ends, key_starts, key_ends, hashes, first, long_enough)


def _all_lines(batches: Iterator[pa.RecordBatch], column: int, min_chars: int) -> Iterator[tuple]:
    """(batch, from, to, lines) of texts of about a megabyte together, or of one longer text."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(column))
        for a, b in pieces(offsets):
            part = data[offsets[a] : offsets[b]]
            yield batch, a, b, lines(part, offsets[a : b + 1] - offsets[a], min_chars)
        pa.default_memory_pool().release_unused()


def _bits(hashes: np.ndarray) -> np.ndarray:
    """Four bits of a word of the filter, from the lower part of a hash."""
    out = np.zeros(len(hashes), dtype=np.uint64)
    for shift in (0, 6, 12, 18):
        out |= np.uint64(1) << ((hashes >> np.uint64(shift)) & np.uint64(63))
    return out


def _word(hashes: np.ndarray, words: int) -> np.ndarray:
    """Which word of the filter, from the upper part; ``words`` is a power of two."""
    return (hashes >> np.uint64(24)) & np.uint64(words - 1)


def _set(filter_: np.ndarray, hashes: np.ndarray) -> None:
    if len(hashes):
        at = _word(hashes, len(filter_))
        order = np.argsort(at, kind="stable")
        at, bits = at[order], _bits(hashes)[order]
        cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        filter_[at[cuts]] |= np.bitwise_or.reduceat(bits, cuts)


def _has(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = _bits(hashes)
    return (filter_[_word(hashes, len(filter_))] & bits) == bits


def _filters(words: int, min_chars: int) -> Callable:
    """What a task has seen and seen in two documents: the words that are not zero, by segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(words, np.uint64), np.zeros(words, np.uint64)
        for _, _, _, found in _all_lines(batches, 0, min_chars):
            hashes, text = found.hashes[found.long_enough], found.text_of()[found.long_enough]
            order = np.argsort(hashes, kind="stable")  # texts stay in order among equal hashes
            hashes, text = hashes[order], text[order]
            new = np.r_[True, hashes[1:] != hashes[:-1]][: len(hashes)]
            again = np.r_[False, (hashes[1:] == hashes[:-1]) & (text[1:] != text[:-1])][: len(hashes)]
            hashes_once = hashes[new]
            _set(twice, np.concatenate([hashes[again], hashes_once[_has(once, hashes_once)]]))
            _set(once, hashes_once)
        at = np.flatnonzero(once | twice)
        cuts = np.searchsorted(at, np.arange(0, words + 1, _SEGMENT))
        for segment, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            if b > a:
                yield _row(segment, (at[a:b] - segment * _SEGMENT).astype(np.uint16), once[at[a:b]], twice[at[a:b]])

    return run


def _row(segment: int, *parts: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([segment], pa.int32()), *(pa.array([p.tobytes()], pa.binary()) for p in parts)]
    return pa.RecordBatch.from_arrays(columns, ["segment", "at", "once", "twice"][: len(columns)])


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of all tasks, in order, put together: one segment in memory at a time."""
    segment, once, twice = None, None, None
    for batch in batches:
        for number, *parts in zip(*(c for c in batch.columns), strict=True):
            if number.as_py() != segment:
                if segment is not None:
                    yield _row(segment, twice).rename_columns(["segment", "twice"])
                segment = number.as_py()
                once, twice = np.zeros(_SEGMENT, np.uint64), np.zeros(_SEGMENT, np.uint64)
            kinds = (np.uint16, np.uint64, np.uint64)
            at, own_once, own_twice = (np.frombuffer(p.as_buffer(), k) for p, k in zip(parts, kinds, strict=True))
            twice[at] |= own_twice | (once[at] & own_once)
            once[at] |= own_once
    if segment is not None:
        yield _row(segment, twice).rename_columns(["segment", "twice"])


def seen_twice(texts: DataFrame, min_chars: int = MIN_CHARS, most_words: int = MOST_WORDS) -> np.ndarray:
    """The filter of hashes that may be in two documents, from a DataFrame of one text column.

    Its size follows the number of lines up to ``most_words`` words of 64 bits. A task sends 18
    bytes at most for a line that it has not seen before.
    """
    name = texts.columns[0]
    breaks = F.octet_length(name) - F.octet_length(F.replace(F.col(name), F.lit("\n"), F.lit("")))
    counted = texts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(breaks), F.lit(0)).alias("breaks")).first()
    need = (counted["n"] + counted["breaks"]) * BITS_A_LINE // 64
    words = min(most_words, max(_LEAST_WORDS, 1 << int(need).bit_length()))
    parts = texts.mapInArrow(_filters(words, min_chars), "segment int, at binary, once binary, twice binary")
    parts = parts.repartition(tasks_for(texts), "segment").sortWithinPartitions("segment")
    filter_ = np.zeros(words, np.uint64)
    for segment, twice in parts.mapInArrow(_merged, "segment int, twice binary").collect():
        filter_[segment * _SEGMENT : (segment + 1) * _SEGMENT] = np.frombuffer(twice, np.uint64)
    return filter_


def _suspects(filter_, id_type: pa.DataType, min_chars: int, most: int) -> Callable:
    """Suspected keys with the documents they are in, for each megabyte of text.

    Of more than ``most`` documents of a key the ``most`` least are named: whether all tasks
    together name ``most`` different ones is the same question as whether there are as many.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, b, found in _all_lines(batches, 1, min_chars):
            suspected = np.flatnonzero(found.long_enough & _has(filter_.value, found.hashes))
            ids, text, held = batch.column(0).slice(a, b - a).to_pylist(), found.text_of(), {}
            for line, t in zip(suspected.tolist(), text[suspected].tolist(), strict=True):
                own = held.setdefault(found.key(line), {})
                at = (line - int(found.first[t]), t)
                own[ids[t]] = min(own.get(ids[t], at), at)
            keys, documents, at = [], [], []
            for key, own in held.items():
                for name in sorted(own, key=lambda v: (v is None, v if v is not None else 0))[:most]:
                    keys.append(key)
                    documents.append(name)
                    at.append(own[name][0])
            columns = [pa.array(keys, pa.binary()), pa.array(documents, id_type), pa.array(at, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "id", "line"])

    return run


def repeated_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS, filter_: Broadcast | None = None,
) -> DataFrame:
    """key (bytes), first_id and first_line of each key that ``min_documents`` documents have.

    Rows of equal id are one document, and so are all rows without an id. The first occurrence is
    in the document of the least id, null after all others, on its first such line from 0.
    ``filter_`` is that of :func:`seen_twice`, if it is at hand.
    """
    if min_documents < 2:
        raise ValueError("a line of one document is not repeated: min_documents is 2 at least")
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    field = rows.schema["id"]
    filter_ = filter_ or docs.sparkSession.sparkContext.broadcast(seen_twice(rows.select("text"), min_chars))
    kind = pa.field("id", _arrow_type(field.dataType)).type
    schema = T.StructType().add("key", T.BinaryType()).add("id", field.dataType).add("line", T.LongType())
    found = rows.mapInArrow(_suspects(filter_, kind, min_chars, min_documents), schema)
    # One row for a key and a document, so a line of every document is dealt to all tasks.
    pairs = found.groupBy("key", "id").agg(F.min("line").alias("line"))
    place = F.struct(F.col("id").isNull().alias("none"), "id", "line")
    keys = pairs.groupBy("key").agg(F.count(F.lit(1)).alias("documents"), F.min(place).alias("first"))
    keys = keys.filter(F.col("documents") >= min_documents)
    return written(
        keys.select("key", F.col("first.id").alias("first_id"), F.col("first.line").alias("first_line")), "repeated-lines"
    )


def _arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def _without(found: Lines, text: int, gone: np.ndarray) -> bytes:
    """A text without some of its lines, numbered from its first."""
    a, b = int(found.first[text]), int(found.first[text + 1])
    stay = np.ones(b - a, dtype=bool)
    stay[gone] = False
    kept = np.flatnonzero(stay) + a
    return b"\n".join(found.data[found.starts[i] : found.ends[i]].tobytes() for i in kept)


def _rewritten(batch: pa.RecordBatch, a: int, b: int, found: Lines, gone: dict[int, list[int]]) -> pa.RecordBatch:
    """The texts ``a`` to ``b`` of a batch of id and text, without the lines that go."""
    texts = batch.column(1).slice(a, b - a)
    if gone:
        texts = texts.to_pylist()
        for text, own in gone.items():
            texts[text] = _without(found, text, np.array(own)).decode()
        texts = pa.array(texts, pa.string())
    dropped = np.zeros(b - a, np.int64)
    for text, own in gone.items():
        dropped[text] = len(own)
    columns = [batch.column(0).slice(a, b - a), texts.fill_null("").cast(pa.string()), np.diff(found.first), dropped]
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c) for c in columns], ["id", "text", "n_lines", "n_dropped"]
    )


def _looked_up(keys, min_chars: int, keep_first: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, known_hashes = keys.value
        for batch, a, b, found in _all_lines(batches, 1, min_chars):
            hit = np.flatnonzero(found.long_enough & np.isin(found.hashes, known_hashes))
            gone: dict[int, list[int]] = {}
            for line, text in zip(hit.tolist(), found.text_of()[hit].tolist(), strict=True):
                first = known.get(found.key(line))
                number = line - int(found.first[text])
                if first is None or (keep_first and first == (batch.column(0)[a + text].as_py(), number)):
                    continue
                gone.setdefault(text, []).append(number)
            yield _rewritten(batch, a, b, found, gone)

    return run


def _numbered(filter_, min_chars: int, schema: T.StructType) -> Callable:
    """Every suspected line: the row's hash, its number in the text, its key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, a, b, found in _all_lines(batches, 1, min_chars):
            hit = np.flatnonzero(found.long_enough & _has(filter_.value, found.hashes))
            text = found.text_of()[hit]
            own = batch.slice(a, b - a).take(pa.array(text))
            columns = [
                own.column(0), own.column(2), pa.array(hit - found.first[text]), pa.array([found.key(i) for i in hit.tolist()], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, a, b, found in _all_lines(batches, 1, 0):
        gone = {t: own for t, own in enumerate(batch.column(2).slice(a, b - a).to_pylist()) if own}
        yield _rewritten(batch.select([0, 1]), a, b, found, gone)


def drop_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    min_documents: int = MIN_DOCUMENTS, min_chars: int = MIN_CHARS, keep_first: bool = False,
    broadcast_bytes: int = BROADCAST_BYTES, most_words: int = MOST_WORDS,
) -> DataFrame:
    """id, text, n_lines and n_dropped of each row of ``docs``, without its repeated lines.

    A text is split at line feeds; null and empty texts are one empty line and come back empty.
    A line goes if at least ``min_documents`` documents have its key and the key has at least
    ``min_chars`` code points; with ``keep_first`` its first occurrence of all stays. The other
    lines stay as they are, joined by line feeds, however long they are. Rows of equal id are one
    document (as are all rows without one), each row keeps its own text, and an empty table gives
    an empty one. Other columns of ``docs`` are neither read nor returned, so their names are free.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    filter_ = spark.sparkContext.broadcast(seen_twice(rows.select("text"), min_chars, most_words))
    keys = repeated_lines(rows, "id", "text", min_documents, min_chars, filter_)
    size = F.coalesce(F.sum(F.octet_length("key") + _A_KEY), F.lit(0))
    kind = rows.schema["id"].dataType
    schema = T.StructType().add("id", kind).add("text", T.StringType())
    schema = schema.add("n_lines", T.LongType()).add("n_dropped", T.LongType())
    if keys.agg(size).first()[0] <= broadcast_bytes:
        known = {bytes(r["key"]): (r["first_id"], r["first_line"]) for r in keys.toLocalIterator()}
        hashes = [lines(np.frombuffer(k, np.uint8), np.array([0, len(k)]), 0).hashes[0] for k in known]
        sent = spark.sparkContext.broadcast((known, np.array(hashes, dtype=np.uint64)))
        return rows.mapInArrow(_looked_up(sent, min_chars, keep_first), schema)
    marked = rows.withColumn("digest", F.xxhash64("text"))
    line = T.StructType().add("id", kind).add("digest", T.LongType()).add("line", T.LongType()).add("key", T.BinaryType())
    lost = marked.mapInArrow(_numbered(filter_, min_chars, line), line).distinct().join(keys, "key")
    if keep_first:
        lost = lost.filter(~(F.col("id").eqNullSafe(F.col("first_id")) & (F.col("line") == F.col("first_line"))))
    lost = lost.groupBy(F.col("id").alias("_id"), F.col("digest").alias("_digest")).agg(F.collect_list("line").alias("gone"))
    same = F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest"))
    return marked.join(lost, same, "left").select("id", "text", "gone").mapInArrow(_listed, schema)
