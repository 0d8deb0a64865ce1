"""Chat formatting with prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are
its context, and only that reply is under the loss mask. Examples of a
conversation are prefixes of one another, so the formatted conversation is
stored once, as one segment a turn, and an example is a row that says how far
its prefix reaches and where its reply lies. The output grows with the input,
not with its square; ``render`` joins whole example texts where they are
wanted as strings.

Template: ``<|im_start|>role`` + newline + text + ``<|im_end|>`` + newline. The
control strings below are escaped inside roles and texts by one backslash
behind their first character (one more than there were), so ``unescape`` gives
back exactly what came in.

A conversation is one ordered stream: it is read turn by turn in one task with
constant memory, however long it is. Defined results: a null text or role
counts as empty; rows of the same turn go by role, then text; a null turn comes
last; rows with a null conv_id form one conversation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
TARGET_ROLE = "assistant"

# Control strings of public chat templates.
CONTROL = ("<|im_start|>", "<|im_end|>", "<s>", "</s>", "<unk>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
           "<|user|>", "<|assistant|>", "<|system|>", "<|endoftext|>", "<|eot_id|>")

_REST = "|".join(sorted((re.escape(c[1:]) for c in CONTROL), key=len, reverse=True))
_PLAIN = re.compile(rf"([<\[])(\\*)(?={_REST})")
_MARKED = re.compile(rf"([<\[])\\(\\*)(?={_REST})")
_SEGMENT = re.compile(rf"{re.escape(BEGIN)}([^\n]*)\n(.*){re.escape(END)}", re.DOTALL)


def escape(text: str) -> str:
    return _PLAIN.sub(r"\1\2\\", text)


def unescape(text: str) -> str:
    return _MARKED.sub(r"\1\2", text)


def _role_out(role: str) -> str:
    return escape(role.replace("%", "%25").replace("\n", "%0A"))


def _role_in(role: str) -> str:
    return unescape(role).replace("%0A", "\n").replace("%25", "%")


def segment(role: str, text: str) -> tuple[str, int, int]:
    """A formatted turn, and where the text lies in it."""
    head, body = f"{BEGIN}{_role_out(role)}\n", escape(text)
    return head + body + END, len(head), len(head) + len(body)


def parse(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    role, text = _SEGMENT.fullmatch(formatted).groups()
    return _role_in(role), unescape(text)


SEGMENTS = (("seq", T.LongType()), ("segment", T.StringType()), ("offset", T.LongType()),
            ("text_start", T.LongType()), ("text_end", T.LongType()), ("trained", T.BooleanType()))


def _streamed(rows: DataFrame, outputs, start: Callable[[], Callable]) -> DataFrame:
    """Runs over the sorted rows of ``rows`` (first column: the conversation).

    ``start()`` begins a task and returns a function of (new conversation?, row)
    that yields output rows; a last call with row None ends the stream.
    """
    schema = T.StructType([rows.schema.fields[0], *(T.StructField(n, t) for n, t in outputs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, before, seen = start(), None, False
        kinds = None
        for batch in batches:
            if kinds is None:
                kinds = pa.schema([pa.field(schema.fieldNames()[0], batch.schema.field(0).type),
                                   *(pa.field(n, _ARROW[t.typeName()]) for n, t in outputs)])
            out: list[tuple] = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out.extend(step(not seen or row[0] != before, row))
                before, seen = row[0], True
                if len(out) >= 2000:
                    yield _batch(out, kinds)
                    out = []
            if out:
                yield _batch(out, kinds)
        if seen and (out := list(step(True, None))):
            yield _batch(out, kinds)

    return rows.mapInArrow(run, schema)


_ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                                      schema=schema)


def format_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", target_role: str = TARGET_ROLE) -> DataFrame:
    """One segment per turn, in order: conv_id, seq, segment, its offset in the
    conversation, and where its text begins and ends in the conversation (code
    points); ``trained`` marks the targets."""
    empty = F.lit("")
    rows = conversations.select(F.col(f"`{conv_col}`").alias(conv_col), F.col(f"`{turn_col}`").alias("_turn"),
                                F.coalesce(F.col(f"`{role_col}`"), empty).alias("_role"),
                                F.coalesce(F.col(f"`{text_col}`"), empty).alias("_text"))
    rows = rows.repartition(F.col(conv_col)).sortWithinPartitions(
        F.col(conv_col), F.col("_turn").asc_nulls_last(), "_role", "_text")

    def start():
        seq = offset = 0

        def step(new, row):
            nonlocal seq, offset
            if row is None:
                return
            if new:
                seq = offset = 0
            conv, _, role, text = row
            whole, a, b = segment(role, text)
            yield conv, seq, whole, offset, offset + a, offset + b, role == target_role
            seq, offset = seq + 1, offset + len(whole)
        return step

    return _streamed(rows, SEGMENTS, start)


def expand_replies(segments: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One example per target turn: its context is the conversation's first
    ``context_chars`` code points, its loss mask the text from ``loss_start`` to
    ``loss_end`` and nothing else; the example ends with that turn."""
    return segments.where("trained").select(conv_col, *_example())


def _example() -> list[Column]:
    return [F.col("seq").alias("target_seq"), F.col("offset").alias("context_chars"),
            F.col("text_start").alias("loss_start"), F.col("text_end").alias("loss_end"),
            (F.col("offset") + F.char_length("segment")).cast("long").alias("example_chars")]


def with_examples(segments: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """The segments in order, each target's followed by its example: a row with the
    columns of ``expand_replies`` and no segment; a segment's row has none of them."""
    columns = [F.col(n) for n, _ in SEGMENTS]
    names = ["target_seq", "context_chars", "loss_start", "loss_end", "example_chars"]
    turn = F.struct(*columns, *(F.lit(None).cast("long").alias(n) for n in names))
    example = F.struct(*(F.lit(None).cast(t).alias(n) for n, t in SEGMENTS), *_example())
    both = F.when(F.col("trained"), F.array(turn, example)).otherwise(F.array(turn))
    return segments.select(F.col(f"`{conv_col}`"), F.explode(both).alias("_row")).select(F.col(f"`{conv_col}`"), "_row.*")


def render(segments: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Whole example texts: conv_id, target_seq, text, loss_start, loss_end.

    ``segments`` as ``format_turns`` made them (in order). The size of the output
    is quadratic in a conversation's turns.
    """
    rows = segments.select(conv_col, *(n for n, _ in SEGMENTS))
    outputs = (("target_seq", T.LongType()), ("text", T.StringType()), ("loss_start", T.LongType()),
               ("loss_end", T.LongType()))

    def start():
        parts: list[str] = []

        def step(new, row):
            if new:
                parts.clear()
            if row is not None:
                conv, seq, text, _, a, b, trained = row
                parts.append(text)
                if trained:
                    yield conv, seq, "".join(parts), a, b
        return step

    return _streamed(rows, outputs, start)


def read_back(segments: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation: n_turns, turns_sha256 and formatted_chars, parsed from
    its formatted turns; n_examples, loss_chars and loss_sha256, from its examples.

    An example must reach as far as the turns up to its reply; its loss span is cut
    from the stored segment.
    """
    rows = with_examples(segments.select(conv_col, *(n for n, _ in SEGMENTS)), conv_col)
    outputs = (("n_turns", T.LongType()), ("turns_sha256", T.StringType()), ("n_examples", T.LongType()),
               ("loss_chars", T.LongType()), ("loss_sha256", T.StringType()), ("formatted_chars", T.LongType()))

    def start():
        state: list = []
        last: list = []  # seq, segment and begin of the turn before

        def step(new, row):
            if new:
                if state:
                    conv, turns, all_turns, examples, chars, loss, formatted = state
                    yield conv, turns, all_turns.hexdigest(), examples, chars, loss.hexdigest(), formatted
                state[:] = [row[0], 0, hashlib.sha256(), 0, 0, hashlib.sha256(), 0] if row is not None else []
            if row is None:
                return
            _, seq, whole, _, _, _, _, target, context, a, b, chars = row
            if target is None:
                role, text = parse(whole)
                last[:] = seq, whole, state[6]
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
                state[6] += len(whole)
                return
            own, whole, begin = last
            if (target, context, chars) != (own, begin, state[6]):
                raise ValueError(f"example {target} of conversation {row[0]} doesn't end with its reply")
            reply = unescape(whole[a - begin: b - begin])
            state[3] += 1
            state[4] += len(reply)
            state[5].update(reply.encode())
        return step

    return _streamed(rows, outputs, start)
