"""Which tokens of two tokenizers cover the same bytes of a text.

Both tokenizers cut the same bytes, so a token is known by where it ends. Dictionaries from ends to
indices of either side are intersected as sets; the sorted common ends slice both lists of ids into
groups, and in a group each token is linked to those of the other side that it overlaps.

Both tokenizers also cut at every single space between two other characters, so the words between
such spaces are tokenized and aligned one by one, and the words a task has met lately are kept with
their alignment. A text is then a run of words, whatever its length. Whether a tokenizer cuts there
is read from its vocabulary; if one does not, a word is the whole text.

A text is written as its links in order: the ids of both sides, and which side moved on. How often a
pair of ids is linked anywhere is counted from the different pairs of each piece of text.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.kernels import pieces, text_bytes
from changeflow.llm.scratch import written

VOCABULARY_A = "/opt/tokenizers/byte_bpe_50k.json"
VOCABULARY_B = "/opt/tokenizers/piece_bpe_32k.model"
PIECE = 4 << 20
# Words a task keeps with their alignment: so many of them and of their characters besides those of
# the texts at hand.
KEPT_WORDS = 1 << 18
KEPT_CHARS = 4 << 20
# New words are tokenized in runs of so many characters.
RUN_CHARS = 1 << 14
# Counts of pairs are sent to all tasks up to so many pairs (17 bytes each), and joined beyond.
BROADCAST_PAIRS = 4 << 20

# What moved on to reach a link: the token of A, that of B, or both, where a group begins.
NEXT_A, NEXT_B, NEXT_GROUP = 1, 2, 3

# Splits words of a byte-level vocabulary before pairs are merged. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WORDS = re.compile(r"(?<=\S) (?=\S)")
_SPACE = "▁"


def byte_of_char() -> dict[str, int]:
    """The character a byte-level vocabulary writes for each byte: itself where it can be printed,
    and the others in order from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _by_id(token_bytes: dict[int, bytes]) -> list[bytes]:
    return [token_bytes.get(i, b"") for i in range(max(token_bytes, default=-1) + 1)]


class ByteLevel:
    """Ids and bytes of a byte-level vocabulary, given as the JSON of the tokenizers library.

    Where ids number the merges in their order, ranks are all there is to know, and the engine for
    ranks gives the same ids in a quarter of the time. Any other file is left to its own library.
    """

    def __init__(self, content: bytes):
        found = json.loads(content)
        byte = byte_of_char()
        special = {t["id"] for t in found.get("added_tokens", ())}
        vocabulary = {t: i for t, i in found["model"]["vocab"].items() if i not in special}
        self.token_bytes = _by_id({i: bytes(byte[c] for c in t) for t, i in vocabulary.items()})
        pre, merges = found.get("pre_tokenizer") or {}, [m if isinstance(m, list) else m.split(" ") for m in found["model"]["merges"]]
        ranked = [vocabulary.get(a + b) for a, b in merges]
        # The words of a text are its cuts, and a space goes with the word after it.
        self.cuts_words = found.get("normalizer") is None and pre == {**pre, "type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if self.cuts_words and ranked == list(range(256, 256 + len(merges))):
            import tiktoken

            ranks = {v: k for k, v in enumerate(self.token_bytes) if v}
            self.encode = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        else:
            from tokenizers import Tokenizer

            engine = Tokenizer.from_str(content.decode())
            engine.encode_special_tokens = True
            self.encode = lambda text: engine.encode(text, add_special_tokens=False).ids


class Pieces:
    """Ids and bytes of a sentencepiece model, which puts a space before the text."""

    def __init__(self, content: bytes):
        import sentencepiece

        engine = sentencepiece.SentencePieceProcessor(model_proto=content)
        ids = range(engine.get_piece_size())
        names = [engine.id_to_piece(i) for i in ids]
        self.token_bytes = [
            bytes([int(t[3:5], 16)]) if engine.is_byte(i) else t.replace(_SPACE, " ").encode() for i, t in zip(ids, names, strict=True)
        ]
        # No piece goes on from another character to a space, so none crosses a single space.
        self.cuts_words = not any(re.search(f"[^{_SPACE}]{_SPACE}", t) for t in names) and (
            engine.encode("a b") == engine.encode("a") + engine.encode("b")
        )
        self.encode = lambda text: engine.encode(text)


# A text or a word of it: its links in order (64-bit numbers, the id of A above that of B), what moved on
# to reach each (a byte), and the groups as text.
Aligned = tuple[bytes, bytes, str]


def _grouped(a: list[str], b: list[str], cuts_a: list[int], cuts_b: list[int]) -> list[str]:
    """Both lists of ids cut at the common ends, each group as text."""
    out, i, j = [], 0, 0
    for last_a, last_b in zip(cuts_a, cuts_b, strict=True):
        if last_a - i == 1 == last_b - j:
            out.append(a[i] + "|" + b[j])
        else:
            out.append(",".join(a[i:last_a]) + "|" + ",".join(b[j:last_b]))
        i, j = last_a, last_b
    return out


class Aligner:
    """Both tokenizers, and the words met lately."""

    def __init__(self, vocabulary_a: bytes, vocabulary_b: bytes):
        self.a, self.b = ByteLevel(vocabulary_a), Pieces(vocabulary_b)
        self.size_a, self.size_b = (np.array([*map(len, side.token_bytes)]) for side in (self.a, self.b))
        self.name_a, self.name_b = ([*map(str, range(len(side.token_bytes)))] for side in (self.a, self.b))
        self.by_words = self.a.cuts_words and self.b.cuts_words
        self.kept: dict[str, Aligned | None] = {}
        self.chars = 0

    def _run(self, words: list[str]) -> list[Aligned] | None:
        """Words with single spaces between, each aligned with the space before it; nothing if a
        tokenizer does not give back the bytes, or does not cut between words."""
        text = " ".join(words)
        a, b = self.a.encode(" " + text), self.b.encode(text)
        want = b" " + text.encode()
        for ids, token_bytes in ((a, self.a.token_bytes), (b, self.b.token_bytes)):
            if b"".join(map(token_bytes.__getitem__, ids)) != want:
                return None
        return self.align_ids(a, b, np.cumsum([len(w.encode()) + 1 for w in words]))

    def align_ids(self, a: list[int], b: list[int], words: np.ndarray) -> list[Aligned] | None:
        """Groups and links of two lists of ids whose tokens have the same bytes in all, for each of
        the words that end at the given bytes; nothing if a token crosses words."""
        ids_a, ids_b = np.array(a), np.array(b)
        ends_a, ends_b = np.cumsum(self.size_a[ids_a]), np.cumsum(self.size_b[ids_b])
        at_a = dict(zip(ends_a.tolist(), range(1, len(a) + 1), strict=True))
        at_b = dict(zip(ends_b.tolist(), range(1, len(b) + 1), strict=True))
        both = at_a.keys() & at_b.keys()
        if not both.issuperset(words.tolist()):
            return None
        common = sorted(both)
        names = list(map(self.name_a.__getitem__, a)), list(map(self.name_b.__getitem__, b))
        groups = _grouped(*names, list(map(at_a.__getitem__, common)), list(map(at_b.__getitem__, common)))
        # Within a slice a link ends where either of its tokens does.
        ends_here = np.zeros((2, int(ends_a[-1]) + 1), np.int8)
        ends_here[0, ends_a], ends_here[1, ends_b] = 1, 1
        ends = np.flatnonzero(ends_here[0] | ends_here[1])
        left, right = (np.cumsum(side, dtype=np.int32)[ends] - side[ends] for side in ends_here)
        links = ((ids_a[left] << 32) | ids_b[right]).tobytes()
        moved = np.full(len(ends), NEXT_GROUP, np.uint8)
        moved[1:] = np.diff(left) * NEXT_A + np.diff(right) * NEXT_B
        moved = moved.tobytes()
        at = [0, *np.searchsorted(ends, words, side="right").tolist()]
        cut = [0, *np.searchsorted(np.array(common), words, side="right").tolist()]
        return [
            (links[8 * i : 8 * j], moved[i:j], ";".join(groups[g:h]) if h - g > 1 else groups[g])
            for i, j, g, h in zip(at[:-1], at[1:], cut[:-1], cut[1:], strict=True)
        ]

    def whole(self, text: str) -> Aligned | None:
        """A text without a look at its words."""
        found = self._run([text])
        return found[0] if found else None

    def _learn(self, words: list[str]) -> None:
        """Align words nobody has met, some thousand characters of them at a time."""
        first, size = 0, 0
        for i, word in enumerate(words, 1):
            size += len(word) + 1
            if size >= RUN_CHARS or i == len(words):
                own = words[first:i]
                found = self._run(own) if len(own) > 1 else None
                self.kept.update(zip(own, found if found else map(self.whole, own), strict=True))
                self.chars, first, size = self.chars + size, i, 0

    def texts(self, texts: list[str]) -> list[list[Aligned]]:
        """The aligned words of each text; none for a text that has no tokens."""
        if not self.by_words:
            return [[found] if (found := text and self.whole(text)) else [] for text in texts]
        words = [_WORDS.split(text) if text else [] for text in texts]
        met = set().union(*words)
        if len(self.kept) + len(met) > KEPT_WORDS or self.chars > KEPT_CHARS:  # only what is met again stays
            self.kept = {w: self.kept[w] for w in met if w in self.kept}
            self.chars = sum(map(len, self.kept))
        self._learn([w for w in met if w not in self.kept])
        out = []
        for text, own in zip(texts, words, strict=True):
            found = [self.kept[w] for w in own]
            if None in found:  # a word differs; whether the text does is seen from the whole
                whole = self.whole(text)
                found = [] if whole is None else [whole]
            out.append(found)
        return out


@dataclass(frozen=True)
class Alignment:
    """``texts`` has a row for each row of the input, ``pairs`` how often ids are linked."""

    texts: DataFrame
    pairs: DataFrame
    uses: DataFrame  # the different pairs of each block of texts


def _aligned(vocabularies, names: list[str]) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(*vocabularies.value)
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            _, offsets = text_bytes(batch.column(1))
            for first, last in pieces(offsets, PIECE):
                part = batch.slice(first, last - first)
                links, moved, digests = [], [], []
                for found in aligner.texts([text or "" for text in part.column(1).to_pylist()]):
                    own = tuple(zip(*found, strict=True)) or ((), (), ())
                    links.append(b"".join(own[0]))
                    moved.append(b"".join(own[1]))
                    digests.append(hashlib.sha256(";".join(own[2]).encode()).hexdigest() if found else "")
                yield _texts(block, part.column(0), links, moved, digests)
                yield _uses(block, part.column(0).type, links)
                block += 1

    def _texts(block: int, ids: pa.Array, links: list[bytes], moved: list[bytes], digests: list[str]) -> pa.RecordBatch:
        n = len(ids)
        flat, bounds = np.frombuffer(b"".join(moved), np.uint8), np.cumsum([0, *map(len, moved)])
        counts = []
        for step in ((flat & NEXT_A) > 0, (flat & NEXT_B) > 0, flat == NEXT_GROUP):
            before = np.concatenate([[0], np.cumsum(step)])[bounds]
            counts.append(pa.array(np.diff(before)))
        own = [pa.array(links, pa.binary()), pa.array(moved, pa.binary()), *counts, pa.array(np.diff(bounds)), pa.array(digests, pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), ids, *own, *[pa.nulls(n, pa.int64())] * 2], names)

    def _uses(block: int, kind: pa.DataType, links: list[bytes]) -> pa.RecordBatch:
        pairs, counts = np.unique(np.frombuffer(b"".join(links), np.int64), return_counts=True)
        n = len(pairs)
        nothing = [pa.nulls(n, kind), *[pa.nulls(n, pa.binary())] * 2, *[pa.nulls(n, pa.int64())] * 4, pa.nulls(n, pa.string())]
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), *nothing, pa.array(pairs), pa.array(counts)], names)

    return run


def align(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B,
) -> Alignment:
    """The alignment of every text, and how often each pair of ids is linked in all of them.

    ``texts`` has block, id, the links in order (``links``: 64-bit numbers, the id of A above that of
    B, ``moved``: a byte), n_a, n_b, n_groups, n_links and groups_sha256 (of ``a1,a2|b1;a3|b2,b3``). Null and empty texts, and
    those of which a tokenizer does not give back a space and the text, have no tokens: zeros and
    an empty string. Texts are aligned whole; special tokens inside them are plain text. Equal rows
    and null ids keep their rows, and count each. Other columns are not read. Files of the
    vocabularies are read on the driver, a few megabytes, and sent along.
    """
    contents = []
    for path in (vocabulary_a, vocabulary_b):
        with open(path, "rb") as file:
            contents.append(file.read())
    sent = docs.sparkSession.sparkContext.broadcast(tuple(contents))
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    schema = T.StructType().add("block", T.LongType()).add("id", rows.schema["id"].dataType)
    for name in ("links", "moved"):
        schema = schema.add(name, T.BinaryType())
    for name in ("n_a", "n_b", "n_groups", "n_links"):
        schema = schema.add(name, T.LongType())
    schema = schema.add("groups_sha256", T.StringType()).add("pair", T.LongType()).add("uses", T.LongType())
    found = written(rows.mapInArrow(_aligned(sent, schema.names), schema), "alignment")
    texts = found.filter("pair IS NULL").drop("pair", "uses")
    uses = found.filter("pair IS NOT NULL").select("block", "pair", "uses")
    counts = uses.groupBy("pair").agg(F.sum("uses").alias("links"))
    # All pairs of an id of B meet; there are at most as many as A has ids.
    most = F.max("links").over(Window.partitionBy(F.col("pair").bitwiseAND(0xFFFFFFFF)))
    return Alignment(texts, written(counts.withColumn("best", F.col("links") == most), "pair-counts"), uses)


_SCORED = ("id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def _scored(known) -> Callable:
    """For each text: the sum of the counts of its links, and how many are the best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, links, best = known.value
        for batch in batches:
            flat, bounds = text_bytes(batch.column("links"))
            at = np.searchsorted(keys, np.frombuffer(flat.tobytes(), np.int64))
            sums = []
            for values in (best, links):
                total = np.concatenate([[0], np.cumsum(values[at])])
                sums.append(pa.array(total[bounds[1:] // 8] - total[bounds[:-1] // 8]))
            own = [batch.column(n) for n in _SCORED]
            yield pa.RecordBatch.from_arrays([*own, *sums], [*_SCORED, "n_best", "count_sum"])

    return run


def _scored_block(texts: pa.Table, known: pa.Table) -> pa.Table:
    """The same for a block of texts beside the counts of its pairs."""
    keys, links, best = (known.column(n).combine_chunks().to_numpy(zero_copy_only=False) for n in ("pair", "links", "best"))
    order = np.argsort(keys)
    sent = type("Known", (), {"value": (keys[order], links[order], best[order].astype(np.int64))})
    return pa.Table.from_batches(_scored(sent)(iter(texts.combine_chunks().to_batches())))


def score(found: Alignment, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, groups_sha256, n_best and count_sum of each text.

    ``count_sum`` adds up, over the links of a text, how often their pair is linked anywhere, and
    ``n_best`` counts those whose pair is the most frequent of its id of B, ties included.
    """
    texts, spark = found.texts, found.texts.sparkSession
    fields = [texts.schema[n] for n in _SCORED] + [T.StructField(n, T.LongType()) for n in ("n_best", "count_sum")]
    schema = T.StructType(fields)
    if found.pairs.count() <= broadcast_pairs:
        rows = found.pairs.toArrow().sort_by("pair")
        keys, links, best = (rows.column(n).to_numpy() for n in ("pair", "links", "best"))
        sent = spark.sparkContext.broadcast((keys, links, best.astype(np.int64)))
        return texts.select(*_SCORED, "links").mapInArrow(_scored(sent), schema)
    own = found.uses.join(found.pairs, "pair").select(F.col("block").alias("of"), "pair", "links", "best")
    return texts.groupBy("block").cogroup(own.groupBy("of")).applyInArrow(_scored_block, schema)
