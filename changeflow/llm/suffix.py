"""Removing passages that an earlier document has, by longest previous factors.

Of two documents that share a string of ``LENGTH`` bytes, the one with the larger id loses
it. In a suffix array this is read off the longest-previous-factor array: for a suffix, the
nearest suffix before it in suffix order that starts in a smaller document, and the nearest
after it, share the longest prefixes with it that any earlier document has. The byte string
at a position goes if that prefix has ``LENGTH`` bytes or more.

One suffix array over a corpus can't be sorted, so suffixes are dealt to many small ones by
content. Each string of ``LENGTH`` bytes names one *anchor* inside itself, the substring of
``GRAM`` bytes with the least hash. Equal strings have equal anchors at the same place, so
they get into the same array. Neighbouring strings mostly share their anchor; such a run is
one *context*, of at most 80 bytes, and 16 strings in the mean.

1. Texts are packed into blocks of some megabytes, compressed, written bucketed by block.
2. Each block sends 16 bytes for each of its distinct contexts: the hashes of its anchor (44
   bits) and of its whole (64 bits), and 12 for each document among them. In the order of these
   hashes, documents within, the first of equal contexts tells whether an earlier document has all of it.
3. What is left are contexts nobody earlier has as a whole, but whose anchor occurs in other
   contexts too. Only their text is sent on. Strings whose hash no second document has are left
   out there. In the suffix array of what remains, to a depth of ``LENGTH`` bytes and with ties in
   the order of documents, the previous and the next smaller documents of each suffix and the
   prefixes shared with them give its longest previous factor.
4. Both answers go back to the blocks, which cut out the bytes covered.

Blocks, entries and texts are each read from files or shuffles again if an executor is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeflow.llm import kernels
from changeflow.llm.scratch import tasks_for, written_by_key

LENGTH = 50
GRAM = 20
WINDOW = LENGTH - GRAM + 1
BLOCK_BYTES = 6 << 20
# Text whose entries one bucket gets: about four million, of at most 28 bytes.
BUCKET_BYTES = 64 << 20
# Text whose strings one suffix array may get: each is sorted by itself, in memory.
ARRAY_BYTES = 4 << 20
# An anchor with more different contexts than this is a common phrase. Its strings are then
# dealt out a few at a time, by a hash of more bytes, so that it doesn't load one task.
COMMON = 4096
STEP = 8

_BASE, _INVERSE = 0xD6E8FEB86659FD93, pow(0xD6E8FEB86659FD93, -1, 1 << 64)
_CHUNK = 1 << 16
_PLACES = np.arange(_CHUNK + LENGTH + WINDOW + 2, dtype=np.uint64)
_LAST = np.iinfo(np.int64).max


# -- suffix order -------------------------------------------------------------------------


def _levels(data: np.ndarray, depth: int) -> list[tuple[int, np.ndarray]]:
    """(d, the rank of each position's suffix by its first d bytes) for d = 7, 14, 28 … and ``depth``.

    Prefix doubling: seven bytes make a number, and two ranks make the next one. Beyond the
    end there is a value below all bytes.
    """
    n = len(data)
    padded = np.zeros(n + 8, dtype=np.uint64)
    padded[:n] = data
    first = min(depth, 7)
    words = np.zeros(n, dtype=np.uint64)
    for j in range(first):  # nine bits each: zero stands for the end
        at = padded[j : j + n] + np.uint64(1)
        at[max(n - j, 0) :] = 0
        words = (words << np.uint64(9)) | at
    levels = [(first, _dense(words))]
    del words, padded
    while levels[-1][0] < depth:
        have, ranks = levels[-1]
        step = min(have, depth - have)
        pairs = ranks * np.int64(n + 1)
        pairs[: max(n - step, 0)] += ranks[step:] + 1
        levels.append((have + step, _dense(pairs)))
    return levels


def _dense(values: np.ndarray) -> np.ndarray:
    """The rank of each value among the different ones, in 32 bits where they do."""
    ranks = np.unique(values, return_inverse=True)[1]
    return ranks.astype(np.int32) if len(ranks) < 1 << 31 else ranks


def suffix_ranks(data: np.ndarray, depth: int) -> np.ndarray:
    """Rank of the suffix at each position by its first ``depth`` bytes; equal ones share a rank."""
    return _levels(data, depth)[-1][1]


def _common(data: np.ndarray, levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bytes that the suffixes at ``a`` and ``b`` share at their start, which are fewer than the last level's.

    All have that many bytes before the end of the data.
    """
    a, b = a.copy(), b.copy()
    begin = a.copy()
    for d, ranks in reversed(levels[:-1]):
        step = d * (ranks[a] == ranks[b])
        a, b = a + step, b + step
    going = np.ones(len(a), dtype=bool)
    for _ in range(min(levels[0][0], 7) - 1):
        going &= data[a] == data[b]
        a, b = a + going, b + going
    return a - begin


def _before_smaller(value: np.ndarray, common: np.ndarray) -> np.ndarray:
    """For each place, the least of ``common`` from behind the previous smaller value to the place.

    ``common`` at a place is what it shares with the place before it, so this is what it shares
    with its previous smaller value; 0 where there is none. Places climb a tree of least values
    until a subtree to the left has a smaller one, and go down to its last.
    """
    n = len(value)
    least, shared = [value], [common]
    while len(least[-1]) > 1:
        odd = len(least[-1]) % 2
        v = np.r_[least[-1], np.repeat(_LAST, odd)]
        c = np.r_[shared[-1], np.repeat(_LAST, odd)]
        least.append(np.minimum(v[::2], v[1::2]))
        shared.append(np.minimum(c[::2], c[1::2]))
    out = np.zeros(n, dtype=np.int64)
    place, node, so_far, met = np.arange(n), np.arange(n), common.astype(np.int64), []
    for v, c in zip(least, shared, strict=True):
        left = np.flatnonzero(node & 1)
        smaller = v[node[left] - 1] < value[place[left]]
        found, passed = left[smaller], left[~smaller]
        met.append((place[found], node[found] - 1, so_far[found]))
        so_far[passed] = np.minimum(so_far[passed], c[node[passed] - 1])
        on = np.ones(len(node), dtype=bool)
        on[found] = False
        place, node, so_far = place[on], node[on] >> 1, so_far[on]
    place, node, so_far = (np.empty(0, dtype=np.int64) for _ in range(3))
    for level in range(len(least) - 1, -1, -1):
        place, node, so_far = (np.r_[x, y] for x, y in zip((place, node, so_far), met[level], strict=True))
        if level:
            v, c = least[level - 1], shared[level - 1]
            right = np.minimum(2 * node + 1, len(v) - 1)  # the last node may have one child
            at = (v[right] >= value[place]) & (right > 2 * node)
            so_far = np.where(at, np.minimum(so_far, c[right]), so_far)
            node = np.where(at, 2 * node, right)
    out[place] = so_far
    return out


def longest_previous_factors(
    data: np.ndarray, starts: np.ndarray, document: np.ndarray, depth: int = LENGTH
) -> np.ndarray:
    """For each start, how many bytes from it on (``depth`` at most) also start in a smaller document.

    In suffix order, ties in the order of documents, that is the longer of the prefixes shared with
    the previous and with the next suffix of a smaller document. Suffixes equal to ``depth`` bytes are
    a run. Past its first document their previous smaller one is in the run; the others, whose
    document is the run's least, share with the smaller documents of other runs what the run does.
    All starts have ``depth`` bytes before the end of the data.
    """
    if not len(starts):
        return np.zeros(0, dtype=np.int64)
    levels = _levels(data, depth)
    rank = levels[-1][1][starts]
    order = np.lexsort((document, rank))
    new = np.ones(len(order), dtype=bool)
    new[1:] = rank[order[1:]] != rank[order[:-1]]
    first = order[new]
    least = document[first]
    common = np.zeros(len(first), dtype=np.int64)
    common[1:] = _common(data, levels, starts[first[:-1]], starts[first[1:]])
    before = _before_smaller(least, common)
    after = _before_smaller(least[::-1], np.r_[common[1:], 0][::-1])[::-1]
    run = np.cumsum(new) - 1
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.where(document[order] > least[run], depth, np.maximum(before, after)[run])
    return out


# -- hashes and rows ----------------------------------------------------------------------


def _sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What hashes of all substrings come from: (sums[b] - sums[a]) * back[a] is that of a to b."""
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(kernels.BYTE[data] * kernels.powers(_BASE, len(data)), out=sums[1:])
    return sums, kernels.powers(_INVERSE, len(data))


def _string_hashes(data: np.ndarray, start: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """A hash of the ``length`` bytes from each start on; starts ascend."""
    out = np.empty(len(start), dtype=np.uint64)
    for c in range(0, len(data) if len(start) else 0, _CHUNK):
        a, b = np.searchsorted(start, [c, c + _CHUNK])
        if a < b:
            sums, back = _sums(data[c : c + _CHUNK + length])
            at = start[a:b] - c
            out[a:b] = kernels.mixed((sums[at + length] - sums[at]) * back[at])
    return out


def _in_order(key: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order by both numbers, equal ones in any order, and where in it others begin.

    Almost always the first numbers differ, or both are equal; only what they leave open is sorted by both.
    """
    order = np.argsort(key)
    k, m = key[order], more[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = k[1:] != k[:-1]
    other = m[1:] != m[:-1]
    group = np.cumsum(new) - 1
    open_ = np.unique(group[1:][other & ~new[1:]])
    if len(open_):
        mark = np.zeros(group[-1] + 1, dtype=bool)
        mark[open_] = True
        rows = np.flatnonzero(mark[group])
        order[rows] = order[rows][np.lexsort((m[rows], k[rows]))]
        m = more[order]
        other = m[1:] != m[:-1]
    new[1:] |= other
    return order, new


def _each(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1 … of each run."""
    before = np.cumsum(size) - size
    return np.repeat(start - before, size) + np.arange(size.sum())


def _runs(place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where runs of numbers that follow each other begin, as indices, and how many there are in each."""
    cuts = np.flatnonzero(np.diff(place, prepend=-2) != 1)
    return cuts, np.diff(cuts, append=len(place))


def _parts(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """The bytes of the values, one row from each cut to the next."""
    offsets = ((cuts - cuts[0]) * values.itemsize).astype(np.int32)
    data = np.ascontiguousarray(values[cuts[0] : cuts[-1]])
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _joined(column: pa.ChunkedArray, kind) -> tuple[np.ndarray, np.ndarray]:
    """All values of a column's rows, and how many each row has."""
    data, sizes = [np.empty(0, np.uint8)], [np.empty(0, np.int64)]
    for chunk in column.chunks:
        values, offsets = kernels.text_bytes(chunk)
        data.append(values)
        sizes.append(np.diff(offsets))
    return np.concatenate(data).view(kind), np.concatenate(sizes) // np.dtype(kind).itemsize


# -- blocks -------------------------------------------------------------------------------


def _ids(column: pa.Array) -> np.ndarray:
    """Ids as numbers; rows without one count as the last document."""
    return column.cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)


def _pack(rows: pa.Table, id_column: str, text_column: str) -> pa.RecordBatch:
    rows = rows.combine_chunks()
    rows = rows.take(pa.array(np.argsort(_ids(rows.column(id_column).combine_chunks()), kind="stable")))
    data, offsets = kernels.text_bytes(rows.column(text_column))
    sink = pa.BufferOutputStream()
    rest = rows.drop_columns([text_column])
    with pa.ipc.new_stream(sink, rest.schema) as out:
        out.write_table(rest)
    squeeze = zstandard.ZstdCompressor(level=3).compress
    values = [data.tobytes(), offsets.tobytes(), sink.getvalue().to_pybytes()]
    return pa.RecordBatch.from_arrays(
        [*(pa.array([squeeze(v)], pa.binary()) for v in values), pa.array([len(data)], pa.int64())],
        ["text", "offsets", "rest", "size"],
    )


def _packer(id_column: str, text_column: str, block_bytes: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            _, offsets = kernels.text_bytes(batch.column(batch.schema.get_field_index(text_column)))
            for a, b in kernels.pieces(offsets, block_bytes // 4):
                held.append(batch.slice(a, b - a))
                size += int(offsets[b] - offsets[a])
                if size >= block_bytes:
                    yield _pack(pa.Table.from_batches(held), id_column, text_column)
                    held, size = [], 0
        if held:
            yield _pack(pa.Table.from_batches(held), id_column, text_column)

    return pack


class _Block:
    """The texts of a block, its documents in the order of their ids, and its contexts."""

    def __init__(self, text: bytes, offsets: bytes, rest: bytes, id_column: str):
        expand = zstandard.ZstdDecompressor().decompress
        self.data = np.frombuffer(expand(text), dtype=np.uint8)
        self.offsets = np.frombuffer(expand(offsets), dtype=np.int64)
        self.rest = pa.ipc.open_stream(expand(rest)).read_all()
        self.ids = _ids(self.rest.column(id_column).combine_chunks())

    def contexts(self) -> None:
        """Where each run of strings with one anchor starts, how many, where the anchor is, and its two hashes."""
        n = len(self.data)
        found: list[tuple[np.ndarray, ...]] = []
        for c in range(0, max(n - LENGTH + 1, 0), _CHUNK):
            low = max(c - 1, 0)
            high = min(n - LENGTH + 1, c + _CHUNK + WINDOW + 1)  # starts of strings looked at
            sums, back = _sums(self.data[low : high + LENGTH - 1])
            grams = sums[GRAM:] - sums[:-GRAM]
            grams *= back[: len(grams)]
            least = kernels.mixed(grams)
            least &= ~np.uint64((1 << 20) - 1)
            least |= _PLACES[: len(least)]
            width = 1
            while 2 * width <= WINDOW:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            if width < WINDOW:
                least = np.minimum(least[: -(WINDOW - width)], least[WINDOW - width :])
            change = np.ones(high - low, dtype=bool)
            np.not_equal(least[1:], least[:-1], out=change[1:])
            # Strings across the end of a text are none: runs end before them and begin behind it.
            around = slice(*np.searchsorted(self.offsets, [low, high + LENGTH]))
            for ends in (self.offsets[around] - low, self.offsets[around] - low - LENGTH + 1):
                change[ends[(ends > 0) & (ends < len(change))]] = True
            cuts = np.flatnonzero(change)
            run = np.diff(cuts, append=len(change))
            start = cuts + low
            own = start + LENGTH <= self.offsets[np.searchsorted(self.offsets, start, side="right")]
            own &= (start >= c) & (start < c + _CHUNK) & ((cuts > 0) | (low == c))
            cuts, run, start = cuts[own], run[own], start[own]
            content = (sums[cuts + run + LENGTH - 1] - sums[cuts]) * back[cuts]
            least = least[cuts]
            at = (least & np.uint64((1 << 20) - 1)).astype(np.int64) - cuts
            # The least of many hashes is a small number; mixed again, anchors fill their range.
            anchor = kernels.mixed(least >> np.uint64(20)) >> np.uint64(20)
            found.append((start, run, at.astype(np.int8), anchor, kernels.mixed(content)))
        empty = tuple(np.empty(0, kind) for kind in (np.int64, np.int64, np.int8, np.uint64, np.uint64))
        self.start, self.run, self.at, anchor, content = map(np.concatenate, zip(empty, *found, strict=True))
        self.doc = np.searchsorted(self.offsets, self.start, side="right") - 1
        self.key = (anchor << np.uint64(20)) | (content >> np.uint64(44))
        self.more = content
        # Distinct contexts, each with its first document here; positions are in that order.
        order, new = _in_order(self.key, self.more)
        self.first = np.minimum.reduceat(order, np.flatnonzero(new)) if len(order) else order
        self.entry = np.empty(len(order), dtype=np.int64)
        self.entry[order] = np.cumsum(new) - 1

    def dealt(self, buckets: int) -> tuple[np.ndarray, np.ndarray]:
        """Entries in the order of their buckets and documents, and where each bucket starts."""
        bucket = ((self.key[self.first] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        bucket = bucket.astype(np.int64)
        # Documents follow their places, of which no two are the same: any sort gives this order.
        order = np.argsort(bucket * np.int64(len(self.start) + 1) + self.first)
        return order, np.searchsorted(bucket, np.arange(buckets + 1))  # the order of keys is that of buckets


def _by_block(one):
    """Blocks are worked on one at a time, by a generator whose arrays go with it; workers are kept
    for later tasks, so what Arrow has set aside goes back to the system as well."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from one(batch.slice(i, 1).to_pylist()[0])
                pa.default_memory_pool().release_unused()

    return send


def _entries(id_column: str, buckets: int):
    def send(row: dict) -> Iterator[pa.RecordBatch]:
        block = _Block(row["text"], row["offsets"], row["rest"], id_column)
        block.contexts()
        order, cuts = block.dealt(buckets)
        at = block.first[order]
        there = np.flatnonzero(np.diff(cuts))
        if not len(there):
            return
        cuts = cuts[np.r_[there, -1]]
        # Only documents that have entries in a bucket: what is sent follows the entries.
        doc = block.doc[at]
        new = np.ones(len(doc), dtype=bool)
        new[1:] = doc[1:] != doc[:-1]
        new[cuts[:-1]] = True
        begin = np.flatnonzero(new)
        per_doc = np.diff(begin, append=len(doc)).astype(np.uint32)
        docs = np.searchsorted(begin, cuts)
        steps = np.diff(block.ids[doc[begin]], prepend=0)
        steps[docs[:-1]] = block.ids[doc[cuts[:-1]]]
        columns = [
            pa.array(there, pa.int32()), pa.array(np.full(len(there), row["block"]), pa.int64()),
            _parts(block.key[at], cuts), _parts(block.more[at], cuts), _parts(per_doc, docs), _parts(steps, docs),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "block", "key", "more", "per_doc", "steps"])

    return _by_block(send)


def _judge(common: int, group: pa.Table) -> pa.Table:
    """All entries of a bucket: which an earlier document has whole, and which need their text."""
    key, sizes = _joined(group.column("key"), np.uint64)
    more, _ = _joined(group.column("more"), np.uint64)
    steps, docs = _joined(group.column("steps"), np.int64)
    cuts = np.cumsum(docs) - docs
    ids = np.cumsum(steps)
    ids -= np.repeat(ids[cuts] - steps[cuts], docs)  # steps begin at zero in each row
    doc = np.repeat(ids, _joined(group.column("per_doc"), np.uint32)[0])
    order, new = _in_order(key, more)
    anchor, d = key[order] >> np.uint64(20), doc[order]
    del key, more, doc
    new_anchor = np.ones(len(order), dtype=bool)
    new_anchor[1:] = anchor[1:] != anchor[:-1]
    begin = np.flatnonzero(new)
    gone = d > np.repeat(np.minimum.reduceat(d, begin), np.diff(begin, append=len(d)))
    begin = np.flatnonzero(new_anchor)
    contexts = np.repeat(np.add.reduceat(new, begin, dtype=np.int64), np.diff(begin, append=len(d)))
    state = np.empty(len(d), dtype=np.uint8)
    state[order] = np.where(gone, 1, np.where(contexts < 2, 0, np.where(contexts <= common, 2, 3)))
    cuts = np.r_[0, np.cumsum(sizes)]
    pack = zstandard.ZstdCompressor(level=1).compress
    return pa.table(
        {
            "block": group.column("block"),
            "bucket": group.column("bucket"),
            "state": pa.array(
                [pack(state[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()
            ),
        }
    )


def _judged(common: int):
    return lambda group: _judge(common, group)


def _texts(id_column: str, buckets: int, routes: int):
    """What the blocks know now: runs of strings to remove, and texts that are to be compared.

    The runs are sent by the same shuffle, under numbers below zero.
    """

    def send(row: dict) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor().decompress
        block = _Block(row["text"], row["offsets"], row["rest"], id_column)
        block.contexts()
        order, cuts = block.dealt(buckets)
        state = np.zeros(len(order), dtype=np.uint8)
        for s in row["states"] or []:
            k = s["bucket"]
            state[order[cuts[k] : cuts[k + 1]]] = np.frombuffer(expand(s["state"]), np.uint8)
        later = block.doc > block.doc[block.first][block.entry]
        # A repeated id is one document, though it is two rows.
        later &= block.ids[block.doc] > block.ids[block.doc[block.first]][block.entry]
        remove = later | (state[block.entry] == 1)
        ask = np.flatnonzero(~remove & (state[block.entry] >= 2))
        common = state[block.entry[ask]] == 3
        start, size, by = _within(block, ask[common])
        start, size = np.r_[block.start[ask[~common]], start], np.r_[block.run[ask[~common]], size]
        by = np.r_[block.key[ask[~common]] >> np.uint64(20), by]
        route = (kernels.mixed(by) % np.uint64(routes)).astype(np.int64)
        past = kernels.mixed(np.array([row["block"]], dtype=np.uint64)) % np.uint64(routes)
        known, runs = block.start[remove], block.run[remove].astype(np.uint32)
        whole = np.array([0, len(known)])
        yield _text_rows(row["block"], [-1 - int(past[0])], block.data[:0], whole * 0, known, runs, known[:0], whole, whole * 0)
        order = np.argsort(route, kind="stable")
        start, size, route = start[order], size[order], route[order]
        doc = block.ids[np.searchsorted(block.offsets, start, side="right") - 1]
        edges = np.r_[np.flatnonzero(np.diff(route, prepend=-1)), len(route)]
        length = np.r_[0, np.cumsum(size + LENGTH - 1)][edges]
        for first, last in kernels.pieces(length):
            a, b = edges[first], edges[last]
            text = block.data[_each(start[a:b], size[a:b] + LENGTH - 1)]
            own = edges[first : last + 1] - a
            yield _text_rows(row["block"], route[edges[first:last]], text, length[first : last + 1] - length[first],
                             start[a:b], size[a:b].astype(np.uint32), doc[a:b], own, own)

    return _by_block(send)


def _within(block: _Block, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The runs of contexts whose anchor is common, cut where its place in the string reaches a
    multiple of ``STEP``, and a hash of the bytes that all strings have which are cut alike: those of the
    anchor and ``LENGTH - GRAM - STEP + 1`` more around it. Equal strings are cut alike."""
    anchor = block.start[which] + block.at[which]
    parts = []
    for place in range(0, WINDOW, STEP):
        last = np.minimum(block.start[which] + block.run[which] - 1, anchor - place)
        first = np.maximum(block.start[which], anchor - place - STEP + 1)
        some = first <= last
        parts.append((first[some], (last - first + 1)[some], (anchor - place)[some]))
    start, size, inside = map(np.concatenate, zip(*parts, strict=True))
    order = np.argsort(inside, kind="stable")
    return start[order], size[order], _string_hashes(block.data, inside[order], LENGTH - STEP + 1)


def _text_rows(block: int, routes, text, text_cuts, start, size, doc, cuts, doc_cuts) -> pa.RecordBatch:
    columns = [
        pa.array(np.full(len(routes), block), pa.int64()), pa.array(routes, pa.int32()),
        _parts(text, text_cuts), _parts(start, cuts), _parts(size, cuts), _parts(doc, doc_cuts),
    ]
    return pa.RecordBatch.from_arrays(columns, ["block", "route", "text", "start", "size", "doc"])


def _compare(group: pa.Table) -> pa.Table:
    """A suffix array over the texts of a route; the runs of strings to remove, by block.

    A string whose hash no second document has is in no other one. What is left of the texts without
    these strings gets into the array.
    """
    if group.column("route")[0].as_py() < 0:
        return group.select(["block", "start", "size"])
    data, _ = _joined(group.column("text"), np.uint8)
    start, _ = _joined(group.column("start"), np.int64)
    doc, _ = _joined(group.column("doc"), np.int64)
    size, runs = _joined(group.column("size"), np.uint32)
    size = size.astype(np.int64)
    block = np.repeat(group.column("block").to_numpy(), runs)
    place = _each(np.cumsum(size + LENGTH - 1) - (size + LENGTH - 1), size)
    left = np.flatnonzero(_shared(_string_hashes(data, place), np.repeat(doc, size)))
    run = np.searchsorted(np.cumsum(size), left, side="right")
    place, doc, block = place[left], doc[run], block[run]
    at = left - (np.cumsum(size) - size)[run] + start[run]
    cuts, size = _runs(place)
    data = data[_each(place[cuts], size + LENGTH - 1)]
    place = _each(np.cumsum(size + LENGTH - 1) - (size + LENGTH - 1), size)
    gone = longest_previous_factors(data, place, doc) >= LENGTH
    at, block = at[gone], block[gone]
    order = np.lexsort((at, block))
    at, block = at[order], block[order]
    new = np.flatnonzero(np.diff(block, prepend=-1))
    cuts = np.diff(at, prepend=-2) != 1
    cuts[new] = True
    cuts = np.flatnonzero(cuts)
    by_block = np.r_[np.searchsorted(cuts, new), len(cuts)]
    return pa.table(
        {
            "block": pa.array(block[new], pa.int64()),
            "start": _parts(at[cuts], by_block),
            "size": _parts(np.diff(cuts, append=len(at)).astype(np.uint32), by_block),
        }
    )


def _shared(key: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Whether another document has the key too."""
    order = np.argsort(key)
    k, d = key[order], doc[order]
    begin = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
    out = np.empty(len(key), dtype=bool)
    several = np.minimum.reduceat(d, begin) != np.maximum.reduceat(d, begin)
    out[order] = np.repeat(several, np.diff(begin, append=len(key)))
    return out


def _cut(id_column: str, with_text: bool):
    def cut(row: dict) -> Iterator[pa.RecordBatch]:
        block = _Block(row["text"], row["offsets"], row["rest"], id_column)
        edge = np.zeros(len(block.data) + 1, dtype=np.int32)
        for run in row["runs"] or []:
            start = np.frombuffer(run["start"], np.int64)
            size = np.frombuffer(run["size"], np.uint32).astype(np.int64)
            np.add.at(edge, start, 1)
            np.add.at(edge, start + size + LENGTH - 1, -1)
        gone = np.cumsum(edge, out=edge)[:-1] > 0
        del edge
        for first, last in kernels.pieces(block.offsets):
            kept, removed, spans, digest = [], [], [], []
            bounds = block.offsets[first : last + 1]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                mask = gone[a:b]
                text = block.data[a:b][~mask].tobytes() if mask.any() else block.data[a:b].tobytes()
                if with_text:
                    kept.append(text.decode(errors="ignore"))
                removed.append(int(mask.sum()))
                spans.append(int(mask[:1].sum() + (mask[1:] & ~mask[:-1]).sum()))
                digest.append(hashlib.sha256(text).hexdigest())
            out = block.rest.slice(first, last - first)
            columns = {
                "n_bytes": pa.array(np.diff(bounds), pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(spans, pa.int64()),
                "kept_sha256": pa.array(digest, pa.string()),
            }
            if with_text:
                columns["kept_text"] = pa.array(kept, pa.string())
            for name, values in columns.items():
                out = out.append_column(f"_{name}", values)
            yield from out.combine_chunks().to_batches()

    return _by_block(cut)


def remove_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", with_text: bool = False,
    block_bytes: int = BLOCK_BYTES, common: int = COMMON, bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """All columns but the text, and _n_bytes, _n_removed, _n_spans, _kept_sha256.

    Removed is each byte that lies in a string of 50 bytes which also starts in a document
    of a smaller id. Strings are those of the input, whatever else is removed, and lie in one
    text. The hash is that of the bytes that stay. ``with_text`` adds them as ``_kept_text``,
    without the rests of characters that were cut apart. A null text is an empty one. Rows with the same id are one document and don't take from each
    other; those without an id count as one document after all others. Texts shorter than 50
    bytes stay. Columns that have the names of new ones are replaced. An empty table gives an
    empty result.
    """
    new = ("_n_bytes", "_n_removed", "_n_spans", "_kept_sha256", "_kept_text")
    docs = docs.drop(*new)
    other = [f for f in docs.schema.fields if f.name != text_column]
    schema = "text binary, offsets binary, rest binary, size long"
    blocks = docs.mapInArrow(_packer(id_column, text_column, block_bytes), schema)
    blocks = blocks.withColumn("block", F.monotonically_increasing_id())
    blocks = written_by_key(blocks, "suffix_blocks", "block", tasks_for(docs))
    # As many buckets as the texts' entries need, and not fewer than there are tasks.
    total = blocks.agg(F.sum("size")).first()[0] or 0
    buckets = max(tasks_for(docs), -(-total // bucket_bytes))
    # Blocks send a row for each of these, so they follow the texts alone: tasks that grow too don't make more.
    routes = max(buckets, -(-total // ARRAY_BYTES))
    blocks = blocks.drop("size")

    schema = "bucket int, block long, key binary, more binary, per_doc binary, steps binary"
    entries = blocks.mapInArrow(_entries(id_column, buckets), schema)
    states = entries.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_judged(common), "block long, bucket int, state binary")
    states = states.groupBy("block").agg(F.collect_list(F.struct("bucket", "state")).alias("states"))

    schema = "block long, route int, text binary, start binary, size binary, doc binary"
    asked = blocks.join(states, "block", "left").select(*blocks.columns, "states")
    asked = asked.mapInArrow(_texts(id_column, buckets, routes), schema)
    runs = asked.repartition(buckets, "route").groupBy("route")
    runs = runs.applyInArrow(_compare, "block long, start binary, size binary")
    runs = runs.groupBy("block").agg(F.collect_list(F.struct("start", "size")).alias("runs"))

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in other)
    schema = f"{kinds}, _n_bytes long, _n_removed long, _n_spans long, _kept_sha256 string"
    schema += ", _kept_text string" if with_text else ""
    cut = blocks.join(runs, "block", "left").select(*blocks.columns, "runs")
    return cut.mapInArrow(_cut(id_column, with_text), schema)
