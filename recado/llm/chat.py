"""Chat formatting on token ids: segments are encoded one by one, reserved ids are put between them, masks are places.

A turn is <|im_start|> role newline text <|im_end|> newline. The marks are ids beyond the vocabulary, so no text can make
them; control strings in a text are escaped besides, so the format holds as plain text too. Every turn is encoded by itself.
Where its ids stand in the conversation, and which of them are learnt from, follows from prefix sums of lengths.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recado.llm import tokens
from recado.llm.words import by_batch

VOCABULARY = tokens.VOCABULARY
START, END = 50257, 50258  # the first ids that the vocabulary leaves free
MARKS = {START: "<|im_start|>", END: "<|im_end|>"}
LEARNT = "assistant"

_OPEN = re.compile(r"<(\\*)\|")
_CLOSED = re.compile(r"<\\(\\*)\|")


def escape(text: str) -> str:
    """``<|`` gets a backslash inside, ``<\\|`` one more, and so on: no control string is left, and nothing is lost."""
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _CLOSED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """A role besides may not hold the newline that ends it."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role), flags=re.S)


class Coder:
    """Ids of ordinary text, and back to bytes; the reserved ids give their marks."""

    def __init__(self, vocabulary: str) -> None:
        encoder = tokens.encoder(vocabulary)
        self.ids = encoder.ids  # no text holds the vocabulary's own control string: it is escaped
        self.bytes = encoder.bytes | {i: m.encode() for i, m in MARKS.items()}

    def text(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode()


@lru_cache(maxsize=2)
def coder(vocabulary: str) -> Coder:
    """A coder, made once by each Python worker."""
    return Coder(vocabulary)


def format_turns(conversations: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """A row for each turn: ``conv_id``, ``turn``, ``ids``, ``start`` (place of its first id in the conversation), and
    ``loss_start``, ``loss_end`` (places of the ids that are learnt from, the same for other roles than ``LEARNT``).

    Turns are in the order of ``turn`` (NULL first), then role and text. NULL roles and texts are empty; rows without a
    conversation id are one conversation. A repeated row is a turn of its own; an empty table gives no rows. A text
    of any length is encoded whole, long runs of one character included, and held by one task.
    """
    used = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    schema = (T.StructType([used.schema["conv_id"], used.schema["turn"], used.schema["role"]]).add("order", "string")
              .add("ids", T.ArrayType(T.IntegerType())).add("head", "integer").add("body", "integer"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = coder(vocabulary).ids
        newline = encode("\n")
        for batch in batches:
            heads = [[START, *encode(escape_role(r)), *newline] for r in batch.column("role").to_pylist()]
            texts = batch.column("text").to_pylist()
            bodies = [encode(escape(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:3], pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts], pa.string()),
                pa.array([[*h, *b, END, *newline] for h, b in zip(heads, bodies, strict=True)], pa.list_(pa.int32())),
                pa.array([len(h) for h in heads], pa.int32()), pa.array([len(b) for b in bodies], pa.int32())], names=schema.names)

    # One exchange puts a conversation's turns together, in order; they are summed and later read as a stream.
    turns = by_batch(used, run, schema)
    before = W.partitionBy("conv_id").orderBy("turn", "role", "order").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.size("ids")).over(before), F.lit(0))
    learnt = F.when(F.col("role") == LEARNT, F.col("body")).otherwise(0)
    return turns.withColumn("start", start).select(
        "conv_id", "turn", "role", "order", "ids", "start", (F.col("start") + F.col("head")).alias("loss_start"),
        (F.col("start") + F.col("head") + learnt).alias("loss_end"))


def conversations_of(turns: DataFrame) -> DataFrame:
    """``conv_id``, ``ids`` and ``mask`` (1 where learnt from) of each conversation, for training; a row holds all of one."""
    mask = F.flatten(F.transform("parts", lambda p: F.transform(p["ids"], lambda _, i: F.when(
        (p["start"] + i >= p["loss_start"]) & (p["start"] + i < p["loss_end"]), 1).otherwise(0).cast("tinyint"))))
    return turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("start", "loss_start", "loss_end", "ids"))).alias("parts")).select(
        "conv_id", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"), mask.alias("mask"))


def read_back(turns: DataFrame, vocabulary: str = VOCABULARY, together: bool = False) -> DataFrame:
    """What the ids of ``format_turns`` say, a row for each conversation: ``n_turns``, ``turns_sha256`` (role, newline, text,
    newline of each turn), ``loss_chars`` and ``loss_sha256`` (all that the masks cover, unescaped), ``formatted_chars``.

    A conversation's turns arrive as a stream, so a task holds one batch of them and running digests, not a conversation.
    ``together``: the turns come straight from ``format_turns``, whose exchange has put each conversation in one partition.
    """
    schema = T.StructType([turns.schema["conv_id"]]).add("n_turns", "long").add("turns_sha256", "string").add("loss_chars", "long").add(
        "loss_sha256", "string").add("formatted_chars", "long")
    ordered = (turns if together else turns.repartition("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "order").select(
        "conv_id", "ids", "start", "loss_start", "loss_end")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = coder(vocabulary).text
        none = object()
        key, state, done = none, None, []

        def rows(items: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*items, strict=True), arrow, strict=True)], schema=arrow)

        def ended() -> tuple:
            n, turn_hash, chars, loss_hash, formatted = state
            return key, n, turn_hash.hexdigest(), chars, loss_hash.hexdigest(), formatted

        arrow = None
        for batch in batches:
            if arrow is None:
                arrow = pa.schema([("conv_id", batch.schema.field("conv_id").type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                                   ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for conv, ids, start, low, high in zip(*columns, strict=True):
                if key is none or conv != key:
                    if key is not none:
                        done.append(ended())
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                whole = decode(ids)
                inside = whole[len(MARKS[START]):whole.rindex(MARKS[END])]
                role, _, text = inside.partition("\n")
                state[0] += 1
                state[1].update(f"{unescape_role(role)}\n{unescape(text)}\n".encode())
                loss = unescape(decode(ids[low - start:high - start]))
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += len(whole)
            if done:
                yield rows(done)
                done = []
        if key is not none:
            yield rows([ended()])

    return by_batch(ordered, run, schema)
