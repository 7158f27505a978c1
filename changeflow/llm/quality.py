"""A quality classifier: a factorisation machine over hashed words and counts of structure.

A text has one feature per hashed word, weighted by 1 + log(count) and scaled to length one,
and one for the interval each measure of its structure falls into (shares of kinds of
characters, repeated words and lines, lengths, given metadata). The score is

    sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j)

and the sum over pairs is half of sum_f ((sum_i v_if x_i)**2 - sum_i (v_if x_i)**2), so that
scoring is linear in the number of features.

The model has a fixed size. It is fitted on at most ``rows`` labelled rows, chosen by a hash
of their ids; every text is scored whole.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.llm import kernels
from changeflow.llm.scratch import free_name

WORD_BITS = 16
RANK = 8
BINS = 32
# Upper bound of labelled rows the model is fitted on.
FIT_ROWS = 12_000

_MEASURES = 11
_KINDS = np.zeros((256,), dtype=np.uint8)  # 1 letters, 2 digits, 3 white space, 4 the rest
_KINDS[:] = 4
_KINDS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = 1
_KINDS[48:58] = 2
_KINDS[[32, *range(9, 14)]] = 3


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _log_bin(x: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(x + 1.0) * 2, BINS - 2)


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def features(
    data: np.ndarray, offsets: np.ndarray, metadata: Sequence[np.ndarray] = ()
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature numbers, values, bounds) of each text; a text without words has its measures."""
    n = len(offsets) - 1
    hashes, bounds = kernels.word_hashes(data, offsets)
    count = np.diff(bounds)
    doc = np.repeat(np.arange(n), count)
    word = (hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    key, times = np.unique((doc << WORD_BITS) | word, return_counts=True)
    owner, number = key >> WORD_BITS, key & ((1 << WORD_BITS) - 1)
    value = 1.0 + np.log(times)
    value /= np.sqrt(np.maximum(np.bincount(owner, value * value, minlength=n), 1e-12))[owner]

    size = np.diff(offsets)
    kinds = _KINDS[data]
    shares = [_share(_per_text(kinds == k, offsets), size) for k in (1, 2, 3, 4)]
    upper = _share(_per_text((data >= 65) & (data <= 90), offsets), size)
    lines = _per_text(data == 10, offsets)
    again = np.zeros(len(hashes) + 1, dtype=np.int64)
    if len(hashes):
        same = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
        again[2:] = np.cumsum(same)
    repeats = again[bounds[1:]] - again[np.minimum(bounds[:-1] + 1, bounds[1:])]
    distinct = np.bincount(owner, minlength=n)
    top = np.zeros(n)
    np.maximum.at(top, owner, times)
    inner = _per_text(kinds != 3, offsets)
    measures = [
        *(np.sqrt(s) * (BINS - 2) for s in shares),
        np.sqrt(upper) * (BINS - 2),
        np.sqrt(_share(repeats, count)) * (BINS - 2),
        _share(distinct, count) * (BINS - 2),
        np.sqrt(_share(top, count)) * (BINS - 2),
        np.minimum(_share(inner, count) * 2, BINS - 2),
        _log_bin(count),
        np.sqrt(np.minimum(_share(lines, count), 1)) * (BINS - 2),
    ]
    for column in metadata:  # what is unknown has an interval of its own
        known = np.nan_to_num(column.astype(np.float64), nan=-1.0)
        measures.append(np.where(known < 0, BINS - 1, _log_bin(np.maximum(known, 0))))
    structure = np.stack([np.asarray(m).astype(np.int64) for m in measures], axis=1)
    structure += (1 << WORD_BITS) + BINS * np.arange(len(measures))

    owner = np.concatenate([owner, np.repeat(np.arange(n), len(measures))])
    number = np.concatenate([number, structure.ravel()])
    value = np.concatenate([value, np.full(structure.size, 0.5)])
    order = np.argsort(owner, kind="stable")
    return number[order], value[order], np.searchsorted(owner[order], np.arange(n + 1))


@dataclass
class FactorisationMachine:
    """bias, weights (d) and factors (d, RANK)."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, number: np.ndarray, value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Scores before the sigmoid. Every text has features, so no range is empty."""
        scaled = self.factors[number] * value[:, None]
        first = np.add.reduceat(scaled, bounds[:-1], axis=0)
        squares = np.add.reduceat(scaled * scaled, bounds[:-1], axis=0)
        linear = np.add.reduceat(self.weights[number] * value, bounds[:-1])
        return self.bias + linear + 0.5 * (first * first - squares).sum(axis=1)


def fit(
    number: np.ndarray, value: np.ndarray, bounds: np.ndarray, label: np.ndarray, dimensions: int,
    epochs: int = 6, steps: int = 600, batch: int = 128, rate: float = 0.08, decay: float = 1e-5, seed: int = 8,
) -> FactorisationMachine:
    """Adaptive gradient steps on the logistic loss; the same rows always give the same model.

    At least ``epochs`` times all rows, and as often as ``steps`` batches take where rows are few.
    """
    random = np.random.default_rng(seed)
    share = np.clip(label.mean(), 1e-3, 1 - 1e-3)
    model = FactorisationMachine(
        float(np.log(share / (1 - share))),
        np.zeros(dimensions),
        random.normal(0, 0.05, (dimensions, RANK)),
    )
    sum_w, sum_v = np.full(dimensions, 1e-6), np.full((dimensions, RANK), 1e-6)
    size = np.diff(bounds)
    for _ in range(max(epochs, -(-steps * batch // len(label)))):
        order = random.permutation(len(label))
        for start in range(0, len(order), batch):
            rows = order[start : start + batch]
            at = np.repeat(bounds[rows] - (np.cumsum(size[rows]) - size[rows]), size[rows])
            at = at + np.arange(len(at))
            k, x = number[at], value[at]
            own = np.r_[0, np.cumsum(size[rows])]
            scaled = model.factors[k] * x[:, None]
            total = np.add.reduceat(scaled, own[:-1], axis=0)
            error = 1 / (1 + np.exp(-np.clip(model.raw(k, x, own), -30, 30))) - label[rows]
            each = np.repeat(np.arange(len(rows)), size[rows])
            by_w = error[each] * x
            by_v = by_w[:, None] * (total[each] - scaled)
            sort = np.argsort(k, kind="stable")
            unique, first = np.unique(k[sort], return_index=True)
            grad_w = np.add.reduceat(by_w[sort], first) / len(rows) + decay * model.weights[unique]
            grad_v = np.add.reduceat(by_v[sort], first, axis=0) / len(rows) + decay * model.factors[unique]
            sum_w[unique] += grad_w**2
            sum_v[unique] += grad_v**2
            model.weights[unique] -= rate * grad_w / np.sqrt(sum_w[unique])
            model.factors[unique] -= 0.2 * rate * grad_v / np.sqrt(sum_v[unique])
            model.bias -= 0.05 * float(error.mean())
    model.weights, model.factors = model.weights.astype(np.float32), model.factors.astype(np.float32)
    return model


def _metadata(batch: pa.RecordBatch, first: int, rows: slice) -> list[np.ndarray]:
    columns = (batch.column(i).slice(rows.start, rows.stop - rows.start) for i in range(first, batch.num_columns))
    return [c.cast(pa.float64()).to_numpy(zero_copy_only=False) for c in columns]


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = kernels.text_bytes(batch.column(1))
        for a, b in kernels.pieces(offsets):
            part, own = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            number, value, bounds = features(part, own, _metadata(batch, 2, slice(a, b)))
            rows = list(zip(bounds[:-1], bounds[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(a, b - a),
                    pa.array([number[s:e].astype(np.int32).tobytes() for s, e in rows], pa.binary()),
                    pa.array([value[s:e].astype(np.float32).tobytes() for s, e in rows], pa.binary()),
                ],
                ["label", "number", "value"],
            )


def fit_quality(
    docs: DataFrame, labels: DataFrame, label: str = "quality", id_column: str = "doc_id",
    text_column: str = "text", metadata: Sequence[str] = ("n_chars",), rows: int = FIT_ROWS,
) -> FactorisationMachine:
    """Fit a model on at most ``rows`` of the labelled documents, those of the least hash.

    Labels and ids that are null are left out. Labels without a document, or none at all, do
    no harm: a model that knows nothing scores 0.5.
    """
    known = labels.select(F.col(id_column).alias("_id"), F.col(label).cast("int").alias("_label")).dropna()
    chosen = known.orderBy(F.xxhash64("_id"), "_id", "_label").limit(rows)
    texts = docs.select(
        F.col(id_column).alias("_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("_text"),
        *[F.col(m).cast("double").alias(f"_m{i}") for i, m in enumerate(metadata)],
    )
    # ``chosen`` has a proven bound of ``rows`` pairs of numbers. An id with several texts would
    # lift it, so each label takes one row.
    found = texts.join(F.broadcast(chosen), "_id")
    found = found.select("_label", "_text", *[f"_m{i}" for i in range(len(metadata))], "_id")
    sample = found.drop("_id").mapInArrow(_featured, "label int, number binary, value binary")
    sample = sample.orderBy(F.xxhash64("number"), "label").limit(rows).collect()
    dimensions = (1 << WORD_BITS) + BINS * (_MEASURES + len(metadata))
    if not sample:
        return FactorisationMachine(
            0.0, np.zeros(dimensions, np.float32), np.zeros((dimensions, RANK), np.float32)
        )
    number = np.concatenate([np.frombuffer(r["number"], np.int32) for r in sample]).astype(np.int64)
    value = np.concatenate([np.frombuffer(r["value"], np.float32) for r in sample])
    bounds = np.r_[0, np.cumsum([len(r["number"]) // 4 for r in sample])]
    return fit(number, value, bounds, np.array([r["label"] for r in sample], np.float64), dimensions)


def score_quality(
    docs: DataFrame, model: FactorisationMachine, text_column: str = "text",
    metadata: Sequence[str] = ("n_chars",), score: str = "score",
) -> DataFrame:
    """All columns of ``docs`` and a ``score`` between 0 and 1. Null texts count as empty ones,
    null metadata as unknown. A column that has the name of the score is replaced; all others stay,
    whatever their names.

    Texts go through in pieces of about a megabyte and nothing is shuffled.
    """
    docs = docs.drop(score)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    keep = [f.name for f in docs.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in batches:
            own = batch.select(keep)
            data, offsets = kernels.text_bytes(batch.column(len(keep)))
            out = np.empty(batch.num_rows)
            for a, b in kernels.pieces(offsets):
                part, bounds = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                raw = machine.raw(*features(part, bounds, _metadata(batch, len(keep) + 1, slice(a, b))))
                out[a:b] = 1 / (1 + np.exp(-np.clip(raw.astype(np.float64), -30, 30)))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(out)], [*names, score])

    given = docs.select(
        *[F.col(f"`{c}`") for c in names],
        F.col(f"`{text_column}`").alias(free_name(docs, "_scored_text")),
        *[F.col(f"`{m}`").cast("double").alias(free_name(docs, f"_scored_{i}")) for i, m in enumerate(metadata)],
    )
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return given.mapInArrow(run, f"{kinds}, `{score}` double")


def held_out(id_column: str = "doc_id") -> Column:
    """Rows never learned from: those whose checksum of the id leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string")) % 3 == 1, F.lit(False))
