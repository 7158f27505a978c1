"""Chat logs to training text: fold events into messages, render, mark what is trained on.

A conversation is logged as events in the order of ``seq``, each about one message:

    message     the message has this text
    delta       the text is appended to the message (streaming)
    edit        the message has this text from now on; messages after it are void
    regenerate  the message starts again from this text (mostly none); messages after it are void

An event is void if a message before its own was edited or regenerated later on. The others
are folded in order. A message none of whose events are left is gone.

Folding is by message and not by conversation, so a conversation with a third of all rows is
spread over the tasks. Only the small rows that carry the sequence numbers of edits are
sorted by conversation.

The template writes ``<|turn|>role``, a line end, the text and ``<|end|>`` with a line end. In
roles and texts a backslash is doubled, and one is put behind the first character of anything
that reads like the start of a control string, so none survives and all can be undone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeflow.llm.scratch import tasks_for

TURN, END = "<|turn|>", "<|end|>"
# How control strings of common templates start.
CONTROL = r"<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])"
TRAINED_ROLE = "assistant"

_CHUNK = re.compile(r"<\|turn\|>([^\n]*)\n(.*)<\|end\|>\n", re.DOTALL)
_ESCAPE = re.compile(r"\\(.)", re.DOTALL)


def escape(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, CONTROL, r"$0\\")


def escape_role(role: Column) -> Column:
    """As :func:`escape`; line ends too, since one ends the role."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\n" if m[1] == "n" else m[1], text)


def fold_events(events: DataFrame) -> DataFrame:
    """conv_id, message, role and text of each message that is left.

    ``events`` has conv_id, message (anything with an order), seq, op, role and text. Events of
    equal seq go in the order of op, role and text. A null text is empty, a null role is the
    one given before, or empty; an unknown op counts as ``delta``. Conversations and messages
    may be null: that is a value like others, the first in order.
    """
    key = ["conv_id", "message"]
    voids = F.col("op").isin("edit", "regenerate")
    marks = events.groupBy(*key).agg(F.max(F.when(voids, F.col("seq"))).alias("branch"))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    marks = marks.withColumn("cut", F.max("branch").over(before)).filter("cut IS NOT NULL")
    marks = marks.select(F.col("conv_id").alias("_c"), F.col("message").alias("_m"), "cut")

    entry = F.struct("seq", "op", "role", F.coalesce("text", F.lit("")).alias("text"))
    logs = events.groupBy(*key).agg(F.sort_array(F.collect_list(entry)).alias("log"))
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("message").eqNullSafe(F.col("_m"))
    logs = logs.join(marks, same, "left")
    live = F.filter("log", lambda e: F.col("cut").isNull() | (e["seq"] >= F.col("cut")))
    logs = logs.withColumn("log", live).filter(F.size("log") > 0)

    def step(so_far: Column, event: Column) -> Column:
        starts = event["op"].isin("message", "edit", "regenerate")
        return F.struct(
            F.coalesce(event["role"], so_far["role"]).alias("role"),
            F.when(starts, event["text"]).otherwise(F.concat(so_far["text"], event["text"])).alias("text"),
        )

    nothing = F.struct(F.lit("").alias("role"), F.lit("").alias("text"))
    return logs.withColumn("now", F.aggregate("log", nothing, step)).select(*key, "now.role", "now.text")


def render(messages: DataFrame) -> DataFrame:
    """conv_id, message, chunk, loss_start and loss_chars: a conversation is its chunks in order.

    What is trained on is ``loss_chars`` characters of the chunk from ``loss_start``: the text of
    each message of the assistant and nothing else.
    """
    role, text = escape_role(F.coalesce("role", F.lit(""))), escape(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(TURN), role, F.lit("\n"))
    trained = F.col("role") == TRAINED_ROLE
    return messages.select(
        "conv_id",
        "message",
        F.concat(head, text, F.lit(END + "\n")).alias("chunk"),
        F.length(head).alias("loss_start"),
        F.when(trained, F.length(text)).otherwise(0).alias("loss_chars"),
    )


def format_chats(events: DataFrame) -> DataFrame:
    """Events to rendered chunks with their loss spans; see the functions it is made of."""
    return render(fold_events(events))


def table_events(conversations: DataFrame) -> DataFrame:
    """The rows of a table of turns as events: each row is one whole message.

    Rows of one turn, repeated ones too, are messages in the order of role and text.
    """
    row = ("conv_id", "turn", "role", "text")
    order = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    rows = conversations.select(*row).withColumn("_n", F.row_number().over(order))
    return rows.select(
        "conv_id",
        F.struct("turn", "_n").alias("message"),
        F.col("turn").alias("seq"),
        F.lit("message").alias("op"),
        "role",
        "text",
    )


class _Digest:
    """One conversation, read back chunk by chunk."""

    def __init__(self, conv):
        self.conv, self.turns, self.chars, self.loss = conv, 0, 0, 0
        self.all, self.trained = hashlib.sha256(), hashlib.sha256()

    def add(self, chunk: str, start: int, length: int) -> None:
        role, text = (unescape(x) for x in _CHUNK.fullmatch(chunk).groups())
        trained = unescape(chunk[start : start + length])
        self.turns += 1
        self.chars += len(chunk)
        self.loss += len(trained)
        self.all.update(f"{role}\n{text}\n".encode())
        self.trained.update(trained.encode())

    def row(self) -> tuple:
        return (self.conv, self.turns, self.all.hexdigest(), self.loss, self.trained.hexdigest(), self.chars)


def _digests(kind: pa.DataType):
    kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            done = []
            for conv, chunk, start, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(conv)
                now.add(chunk, start, length)
            if done:
                columns = zip(zip(*done, strict=True), kinds, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names)
        if now is not None:
            columns = zip(zip(now.row(), strict=True), kinds, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in columns], names)

    return run


def digests(chunks: DataFrame) -> DataFrame:
    """Per conversation its turns, hashes and lengths, read back from the rendered chunks.

    A hash runs over a conversation in order, so its chunks go through one task, but as a
    stream: of a conversation only the state of the hashes is held.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    kind = chunks.schema["conv_id"].dataType
    rows = chunks.repartition(tasks_for(chunks), "conv_id").sortWithinPartitions("conv_id", "message")
    schema = (
        f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long,"
        " loss_sha256 string, formatted_chars long"
    )
    rows = rows.select("conv_id", "chunk", "loss_start", "loss_chars")
    return rows.mapInArrow(_digests(to_arrow_type(kind)), schema)
