"""Counting the tokens of documents in flat token files that have no index.

A token file is one run of 16-bit token ids in which each document ends with a separator.
It is read in blocks of fixed size that start and end anywhere. Each block is searched for
separators as an array, and says how many tokens it has, how many come before its first
separator, how many after its last, and the lengths in between. A prefix scan over the blocks of
a file then gives each block the number of documents that ended before it and the number of
tokens of the document it starts within; only that stitches the first length.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changeflow.llm.scratch import written

SEPARATOR = 50256
BLOCK_TOKENS = 1 << 18
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def load_encoder(ranks: bytes, pattern: str):
    import tiktoken

    pairs = (line.split() for line in ranks.splitlines() if line)
    return tiktoken.Encoding(
        "own", pat_str=pattern, mergeable_ranks={base64.b64decode(t): int(n) for t, n in pairs}, special_tokens={}
    )


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _tokenized(ranks, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(ranks.value, pattern)
        shard = TaskContext.get().partitionId()
        block, first, held, size = 0, 0, [], 0

        def cut(part: np.ndarray) -> pa.RecordBatch:
            return _row(shard, block, part.tobytes(), b"")

        for batch in batches:
            names = batch.column(0).cast(pa.int64())
            for i, name in enumerate(names.to_pylist()):
                text = batch.column(1)[i].as_py() or ""
                held.append(np.array(encoder.encode_ordinary(text), dtype=np.uint16))
                held.append(np.array([SEPARATOR], dtype=np.uint16))
                size += len(held[-2]) + 1
                if size >= BLOCK_TOKENS:
                    flat = np.concatenate(held)
                    while len(flat) >= BLOCK_TOKENS:
                        yield cut(flat[:BLOCK_TOKENS])
                        block, flat = block + 1, flat[BLOCK_TOKENS:]
                    held, size = [flat], len(flat)
            yield _names(shard, first, names)
            first += len(names)
        if size:
            yield cut(np.concatenate(held))

    return run


def _row(shard: int, block: int, ids: bytes, names: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([shard], pa.int32()), pa.array([block], pa.int64()), pa.array([ids], pa.binary()), pa.array([None], pa.list_(pa.int64()))],
        ["shard", "block", "tokens", "names"],
    )


def _names(shard: int, first: int, names: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([shard], pa.int32()),
            pa.array([first], pa.int64()),
            pa.array([None], pa.binary()),
            pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names),
        ],
        ["shard", "block", "tokens", "names"],
    )


def write_token_files(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = VOCABULARY
) -> tuple[DataFrame, DataFrame]:
    """(blocks, names): the token files cut into blocks, and the ids of their documents in order.

    A file for each partition of ``docs``. The vocabulary is read on the driver (it has some
    hundred kilobytes) and sent to the executors; ids of 16 bits below the separator are all a file
    can hold, and a vocabulary with others is an error. A null text has no tokens. Writing ends the
    lineage, so files and names stay those of one run.
    """
    with open(vocabulary, "rb") as file:
        content = file.read()
    most = max((int(line.split()[1]) for line in content.splitlines() if line), default=0)
    if most >= SEPARATOR:
        raise ValueError(f"the vocabulary has the id {most}, but files hold ids below {SEPARATOR}, the separator")
    ranks = docs.sparkSession.sparkContext.broadcast(content)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    schema = "shard int, block long, tokens binary, names array<long>"
    rows = written(rows.mapInArrow(_tokenized(ranks, split_pattern()), schema), "token-files")
    names = rows.filter("names IS NOT NULL")
    names = names.select("shard", F.col("block").alias("first"), F.posexplode("names").alias("at", "id"))
    names = names.select("shard", (F.col("first") + F.col("at")).alias("document"), "id")
    return rows.filter("tokens IS NOT NULL").select("shard", "block", "tokens"), names


def read_token_files(spark: SparkSession, path: str, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Blocks of flat files of 16-bit ids below ``path``; the shard is the file's path.

    Spark hands over a binary file as one value of up to 2 GB, from which blocks are cut.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1), strict=True):
                data, step = content.as_buffer(), 2 * block_tokens
                for n, at in enumerate(range(0, data.size, step)):
                    part = data.slice(at, min(step, data.size - at)).to_pybytes()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([path.as_py()]), pa.array([n], pa.int64()), pa.array([part], pa.binary())],
                        ["shard", "block", "tokens"],
                    )

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(cut, "shard string, block long, tokens binary")


def _scanned(separator: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for ids in batch.column(2):
                tokens = np.frombuffer(ids.as_buffer(), dtype=np.uint16)
                at = np.flatnonzero(tokens == separator)
                head = int(at[0]) if len(at) else len(tokens)
                tail = len(tokens) - int(at[-1]) - 1 if len(at) else 0
                out.append((len(tokens), len(at), head, tail, (np.diff(at) - 1).tolist()))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [*[pa.int64()] * 4, pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                ["shard", "block", "n", "ends", "head", "tail", "between"],
            )

    return scan


def count_tokens(blocks: DataFrame, separator: int = SEPARATOR) -> DataFrame:
    """shard, document (from 0, in the order of the file) and n_tokens, separators not counted.

    ``blocks`` has shard, block and tokens, all blocks of a shard in the order of their numbers.
    A document without tokens has 0. What follows the last separator of a file is a document
    too, unless it is nothing. The scan sorts six numbers for each block, those of a file in one
    group; the lengths found in a block meet its results by a join on both numbers.
    """
    kind = {f.name: f.dataType.simpleString() for f in blocks.schema}["shard"]
    schema = f"shard {kind}, block long, n long, ends long, head long, tail long, between array<long>"
    found = blocks.select("shard", "block", "tokens").mapInArrow(_scanned(separator), schema)
    found = written(found, "token-scan")
    order = Window.partitionBy("shard").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    scan = found.select("shard", "block", "n", "ends", "head", "tail")
    scan = scan.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    # Where, in the file, the document that is open at the end of a block starts.
    opened = F.when(F.col("ends") > 0, F.col("start") + F.col("n") - F.col("tail"))
    scan = scan.withColumn("opened", opened)
    scan = scan.withColumn("carry", F.col("start") - F.coalesce(F.max("opened").over(before), F.lit(0)))
    scan = scan.withColumn("first", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    last = F.lead("block").over(order).isNull()
    rest = F.when(F.col("ends") > 0, F.col("tail")).otherwise(F.col("carry") + F.col("n"))
    scan = scan.withColumn("rest", F.when(last & (rest > 0), rest))
    scan = scan.select("shard", "block", "first", "ends", (F.col("carry") + F.col("head")).alias("stitched"), "rest")
    found = scan.join(found.select("shard", "block", "between"), ["shard", "block"])
    lengths = F.when(F.col("ends") > 0, F.concat(F.array("stitched"), "between"))
    lengths = F.coalesce(lengths, F.array().cast("array<long>"))
    open_end = F.when(F.col("rest").isNotNull(), F.array("rest")).otherwise(F.array().cast("array<long>"))
    out = found.select("shard", "first", F.concat(lengths, open_end).alias("lengths"))
    out = out.select("shard", "first", F.posexplode("lengths").alias("at", "n_tokens"))
    return out.select("shard", (F.col("first") + F.col("at")).alias("document"), "n_tokens")


def document_tokens(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """id and n_tokens of each row: written to token files, counted there, named by their order.

    Null and empty texts have 0 tokens; repeated rows and null ids each keep their row.
    """
    blocks, names = write_token_files(docs, id_column, text_column, vocabulary)
    counted = count_tokens(blocks).join(names, ["shard", "document"])
    return counted.select(F.col("id").alias(id_column), "n_tokens")
