r"""Chat formatting from an event log: partition by conversation, sort by sequence, fold, render.

An event is (conv_id, seq, message_id, kind, role, text). Kinds, in the order of `seq` within a message:

* ``start`` opens the message with a role; ``delta`` appends its text; ``edit`` replaces all text so far;
* ``regenerate`` drops all text so far (further deltas build the new answer); ``delete`` removes the message, which a
  later ``start`` or ``edit`` brings back (deltas alone don't). Other kinds are ignored. A message stands where its
  first event stands; without a start its role is empty.

The fold needs the events of one message only, so events are dealt out by (conversation, message) and streamed in
order: a conversation with a third of all events is spread over its messages, and superseded deltas are let go as they
pass. Each message is then rendered by itself into a segment:

    <|turn|>ROLE\n TEXT <|end|>\n      (without the blanks)

Inside roles and texts every backslash is doubled and every control string of this or another known template gets ``\-``
after its first character, so that none is left in a text and :func:`unescape` restores it; a line break in a role is
written as ``\n``. The loss mask covers the
text of assistant turns, between the markers.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# How control strings of known chat templates begin, or whole where short.
CONTROLS = ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TURN, END = "<|turn|>", "<|end|>\n"

_CONTROL = "(?=" + "|".join(map(re.escape, CONTROLS)) + ")(.)"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _CONTROL, r"$1\\-")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"-": "", "n": "\n"}.get(m[1], m[1]), text, flags=re.DOTALL)


def parse(segment: str) -> tuple[str, str]:
    """(role, text) of one rendered turn."""
    role, _, rest = segment.removeprefix(TURN).partition("\n")
    return unescape(role), unescape(rest.removesuffix(END))


def rows_as_events(turns: DataFrame) -> DataFrame:
    """Finished turns (conv_id, turn, role, text) as an event log: a start and a delta each.

    Turns of a conversation are ordered by (turn, role, text), nulls first; repeated rows are turns of their own.
    """
    place = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = turns.select("conv_id", "role", "text", F.row_number().over(place).cast("long").alias("message_id"))
    event = lambda step, kind, role, text: F.struct(
        (F.col("message_id") * 2 + step).alias("seq"), F.lit(kind).alias("kind"), role.alias("role"), text.alias("text")
    )
    none = F.lit(None).cast("string")
    both = F.array(event(0, "start", F.col("role"), none), event(1, "delta", none, F.col("text")))
    return numbered.select("conv_id", "message_id", F.explode(both).alias("e")).select("conv_id", "message_id", "e.*")


def fold(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, message_id, seq (of the first event), role, text.

    Null texts and roles are empty. Events that tie on `seq` are taken in the order of kind, role, text; repeated
    events take effect each. A null conversation, message or sequence is a value like any other (first in order).
    """
    key = events.schema["conv_id"].dataType.simpleString(), events.schema["message_id"].dataType.simpleString()
    ordered = (
        events.select("conv_id", "message_id", F.col("seq").cast("long").alias("seq"), "kind", "role", "text")
        .repartition("conv_id", "message_id")
        .sortWithinPartitions("conv_id", "message_id", "seq", F.desc("kind"), "role", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, now, state, out = None, None, None, []

        def done():
            if state and state["shown"]:
                out.append((*now, state["seq"], state["role"], "".join(state["text"])))

        def flush():
            columns = zip(*out) if out else [[]] * 5
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            out.clear()
            return batch

        for batch in batches:
            schema = schema or pa.schema(
                [*(batch.schema.field(c) for c in ("conv_id", "message_id", "seq")), ("role", pa.string()), ("text", pa.string())]
            )
            for conv, message, seq, kind, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or (conv, message) != now:
                    done()
                    now, state = (conv, message), {"seq": seq, "role": "", "text": [], "shown": None}
                if kind == "start":
                    state["shown"], state["role"] = True, role or ""
                elif kind == "delta" and state["shown"] is not False:
                    state["shown"] = True
                    state["text"].append(text or "")
                elif kind == "edit":
                    state["shown"], state["text"] = True, [text or ""]
                elif kind == "regenerate":
                    state["text"] = []
                elif kind == "delete":
                    state["shown"], state["text"] = False, []
            if out:
                yield flush()
        if state is not None:
            done()
            if out:
                yield flush()

    return ordered.mapInArrow(run, f"conv_id {key[0]}, message_id {key[1]}, seq long, role string, text string")


def render(messages: DataFrame) -> DataFrame:
    """Messages with `segment` and the part of it under the loss mask, `loss_start` and `loss_length` in code points."""
    head = F.concat(F.lit(TURN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    body = escape(F.col("text"))
    return messages.select(
        "conv_id",
        "seq",
        F.concat(head, body, F.lit(END)).alias("segment"),
        F.length(head).alias("loss_start"),
        F.when(F.col("role") == "assistant", F.length(body)).otherwise(0).alias("loss_length"),
    )


def read_back(segments: DataFrame) -> DataFrame:
    """Per conversation, from its segments alone: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The segments of a conversation are streamed in order with two running digests, so a long one takes no more memory.
    A SHA-256 over a conversation can't be split: its segments pass one task.
    """
    kind = segments.schema["conv_id"].dataType.simpleString()
    ordered = (
        segments.select("conv_id", "seq", "segment", "loss_start", "loss_length")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "seq")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, now, state = None, None, None
        for batch in batches:
            schema = schema or pa.schema(
                [batch.schema.field("conv_id"), ("n_turns", pa.int64()), ("turns_sha256", pa.string())]
                + [("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]
            )
            out = []
            for conv, _, segment, start, length in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv != now:
                    if state is not None:
                        out.append(row(now, state))
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse(segment)
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                masked = unescape(segment[start : start + length])
                state[2] += len(masked)
                state[3].update(masked.encode())
                state[4] += len(segment)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if state is not None:
            out = [row(now, state)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    def row(conv, state):
        return conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]

    return ordered.mapInArrow(
        run, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def format_log(events: DataFrame) -> DataFrame:
    """Segments of all conversations of an event log; strung together by `seq` they are the formatted conversations."""
    return render(fold(events))
