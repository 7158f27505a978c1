"""Words, shingles and hashes of whole Arrow columns of text, without a loop over rows.

An Arrow column holds all its texts as one run of bytes with offsets, so a batch is one
array to numpy. Work goes over the batch in pieces of about a megabyte, cut between texts,
which keeps arrays in the processor's caches and memory bounded by the longest text.

Hashes are 64 bits: a polynomial modulo 2**64 over a table of random values per byte, ended
by a mixing step. All constants come from fixed seeds, so every process gets the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PIECE = 1 << 20
WORDS_IN_SHINGLE = 5

# [^\x20\x09-\x0D]+ is a word.
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_RANDOM = np.random.default_rng(20240601)
BYTE = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_FOLDED = BYTE.copy()  # A-Z as a-z, and nothing for what separates words
_FOLDED[65:91] = BYTE[97:123]
_FOLDED[_IS_SPACE] = 0
_IN_SHINGLE = _RANDOM.integers(1, 1 << 63, WORDS_IN_SHINGLE, dtype=np.uint64) | np.uint64(1)

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers = {base: np.ones(1, dtype=np.uint64) for base in (_BASE, _INVERSE)}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 … base ** (n - 1) modulo 2**64."""
    have = _powers.get(base, np.ones(1, dtype=np.uint64))
    while len(have) < n:
        step = np.array([pow(base, len(have), 1 << 64)], dtype=np.uint64)
        have = np.concatenate([have, have * step])
    if len(have) <= 8 * PIECE:
        _powers[base] = have
    return have[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of x."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows``, for steps that make many rows of one.

    What Arrow has set aside and no longer uses goes back to the system now and then: Spark
    keeps workers for later tasks, and several share an executor's memory.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        pa.default_memory_pool().release_unused()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and the n + 1 offsets; null is the empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes together; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(n, max(last, first + 1))
        yield first, last
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where words start and end, and for each text the number of words before it (n + 1)."""
    inside = ~_IS_SPACE[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]  # a word does not go on in the next text
    starts[cuts] |= inside[cuts]
    ends[cuts - 1] |= inside[cuts - 1]
    at = np.flatnonzero(starts)
    return at, np.flatnonzero(ends) + 1, np.searchsorted(at, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for each word, A-Z in lower case, and for each text the number of words before it."""
    starts, ends, bounds = words(data, offsets)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), bounds
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_FOLDED[data] * powers(_BASE, len(data)), out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * powers(_INVERSE, len(data))[starts]), bounds


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's word shingles in order, repeats included, and their bounds (n + 1).

    A text of fewer words has one shingle, all of its words; a text without words has none.
    """
    hashes, bounds = word_hashes(data, offsets)
    k = WORDS_IN_SHINGLE
    count = np.diff(bounds)
    number = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    at = np.zeros(len(number) + 1, dtype=np.int64)
    np.cumsum(number, out=at[1:])
    out = np.empty(at[-1], dtype=np.uint64)
    long = count >= k
    if long.any():
        rows = len(hashes) - k + 1
        rolled = hashes[:rows] * _IN_SHINGLE[0]
        for j in range(1, k):
            rolled += hashes[j : j + rows] * _IN_SHINGLE[j]
        first = np.repeat(bounds[:-1][long] - at[:-1][long], number[long])
        into = np.repeat(at[:-1][long] - np.r_[0, np.cumsum(number[long])[:-1]], number[long])
        into = into + np.arange(len(first))
        out[into] = rolled[first + into]
    for n in range(1, k):
        short = count == n
        if short.any():
            start = bounds[:-1][short]
            out[at[:-1][short]] = sum(
                (hashes[start + j] * _IN_SHINGLE[j] for j in range(n)), np.full(len(start), n, np.uint64)
            )
    return mixed(out), at


def sets_of(hashes: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct hashes of each text."""
    return [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
