"""Chat formatting from event logs: reconstruct messages, then render them.

An event row has conv_id, msg (the message's number in its conversation), seq, kind,
role and text. Kinds: ``open`` starts a message with its role, ``delta`` appends
text, ``edit`` replaces the text, ``regenerate`` empties it for a new stream of
deltas. Events of a message apply in order of seq and never touch another message,
so the log is dealt by (conv_id, msg) and sorted there: a conversation of any length
spreads over tasks, and a task holds one message at a time.

Rendering writes one segment per message, ``<|im_start|>role\\ntext<|im_end|>\\n``;
a conversation's formatted text is its segments in order of msg, and the loss mask
is the span of each assistant text inside its segment. Inside texts and roles,
``<`` followed by backslashes and ``|`` gets one more backslash, so ``<|`` marks
control strings only and reading back removes exactly what was added. A line feed in
a role is written ``<|nl|>``.

Edge cases: null texts and roles are empty; null conversation ids are one
conversation, null turns come first; repeated turns stay as turns of their own,
ordered by role and text; an event delivered twice (all fields equal) applies once;
unknown kinds raise; empty tables give empty results; other columns don't matter.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qbank.llm.common import named

#: Fixed values of the template.
START, END, LINE = "<|im_start|>", "<|im_end|>", "<|nl|>"
LEARNED_ROLE = "assistant"
#: Code points of one streamed delta.
DELTA_CHARS = 256


def turn_events(turns: DataFrame) -> DataFrame:
    """The event log of finished turns (conv_id, turn, role, text): every turn opens
    and streams its text in deltas. Assistant turns first stream a draft that is
    regenerated; user turns are sent as a first part and then edited to the whole."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = turns.select("conv_id", "turn", F.coalesce(named("role"), F.lit("")).alias("role"),
                        F.coalesce(named("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("msg", F.row_number().over(order).cast("bigint"))
    event = lambda kind, text: F.struct(F.lit(kind).alias("kind"), text.alias("text"))
    none = F.lit(None).cast("string")
    n = F.ceil(F.length("text") / F.lit(DELTA_CHARS)).cast("int")
    parts = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: event(
        "delta", F.substr("text", i * DELTA_CHARS + 1, F.lit(DELTA_CHARS))))).otherwise(
            F.array().cast("array<struct<kind:string,text:string>>"))
    draft = event("delta", F.substring("text", 1, DELTA_CHARS))
    log = (F.when(F.col("role") == LEARNED_ROLE,
                  F.concat(F.array(event("open", none), draft, event("regenerate", none)), parts))
           .when(F.col("role") == "user", F.array(event("open", none), draft, event("edit", F.col("text"))))
           .otherwise(F.concat(F.array(event("open", none)), parts)))
    return rows.select("conv_id", "msg", "role", F.posexplode(log).alias("seq", "e")).select(
        "conv_id", "msg", F.col("seq").cast("bigint"), "e.kind", "role", "e.text")


def _fold(batches):
    """Sorted events in, one row per finished message out."""
    names = ["conv_id", "msg", "role", "text"]
    state, last, parts, role = None, None, [], ""
    for b in batches:
        done = []
        for conv, msg, seq, kind, who, text in zip(*(c.to_pylist() for c in b.columns)):
            if state != (conv, msg):
                if state is not None:
                    done.append((*state, role, "".join(parts)))
                state, last, parts, role = (conv, msg), None, [], ""
            event = (seq, kind, who, text)
            if event == last:
                continue
            last = event
            if kind == "open":
                role = who or ""
            elif kind == "delta":
                parts.append(text or "")
            elif kind == "edit":
                parts = [text or ""]
            elif kind == "regenerate":
                parts = []
            else:
                raise ValueError(f"unknown kind of event: {kind}")
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*done), (pa.int64(), pa.int64(), pa.string(), pa.string()))],
                names=names)
    if state is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(names, (*state, role, "".join(parts))))], schema=pa.schema(
            [("conv_id", pa.int64()), ("msg", pa.int64()), ("role", pa.string()), ("text", pa.string())]))


def messages(events: DataFrame) -> DataFrame:
    """conv_id, msg, role, text of the final messages of an event log."""
    log = events.select(named("conv_id").cast("bigint"), named("msg").cast("bigint"),
                        named("seq").cast("bigint"), "kind", "role", "text")
    return (log.repartition("conv_id", "msg").sortWithinPartitions("conv_id", "msg", "seq", "kind", "text")
            .mapInArrow(_fold, "conv_id bigint, msg bigint, role string, text string"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def render(msgs: DataFrame) -> DataFrame:
    """conv_id, msg, segment, mask_start, mask_end (the span of the segment, in code
    points, that a loss counts; empty for other roles)."""
    head = F.concat(F.lit(START), F.replace(escape(F.col("role")), F.lit("\n"), F.lit(LINE)), F.lit("\n"))
    body = escape(F.col("text"))
    rows = msgs.select("conv_id", "msg", "role", head.alias("head"), body.alias("body"))
    learned = F.col("role") == LEARNED_ROLE
    end = F.length("head") + F.when(learned, F.length("body")).otherwise(0)
    return rows.select("conv_id", "msg", F.concat("head", "body", F.lit(END + "\n")).alias("segment"),
                       F.length("head").cast("bigint").alias("mask_start"), end.cast("bigint").alias("mask_end"))


def parse_segment(segment: str) -> tuple[str, str]:
    """The role and text of a rendered message."""
    found = re.fullmatch(r"<\|im_start\|>(.*?)\n(.*)<\|im_end\|>\n", segment, re.S)
    if found is None:
        raise ValueError("not a rendered message")
    return unescape(found[1].replace(LINE, "\n")), unescape(found[2])


def _digest(batches):
    """Sorted segments in, one row of digests per conversation out; a conversation's
    text passes through the hashes and is never held."""
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                        ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
    some, conv = False, None
    n = loss_n = chars = 0
    turns, loss = hashlib.sha256(), hashlib.sha256()

    def row():
        return {"conv_id": conv, "n_turns": n, "turns_sha256": turns.hexdigest(), "loss_chars": loss_n,
                "loss_sha256": loss.hexdigest(), "formatted_chars": chars}
    for b in batches:
        done = []
        for c, segment, a, z in zip(*(x.to_pylist() for x in b.columns)):
            if some and c != conv:
                done.append(row())
            if not some or c != conv:
                some, conv, n, loss_n, chars = True, c, 0, 0, 0
                turns, loss = hashlib.sha256(), hashlib.sha256()
            role, text = parse_segment(segment)
            turns.update(f"{role}\n{text}\n".encode())
            learned = unescape(segment[a:z])
            loss.update(learned.encode())
            n, loss_n, chars = n + 1, loss_n + len(learned), chars + len(segment)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)
    if some:
        yield pa.RecordBatch.from_pylist([row()], schema=schema)


def read_back(rendered: DataFrame) -> DataFrame:
    """Per conversation of rendered segments: n_turns, turns_sha256, loss_chars,
    loss_sha256 and formatted_chars. The hashes need a conversation's messages in
    order, so one task streams them; it holds one message at a time."""
    rows = rendered.repartition("conv_id").sortWithinPartitions("conv_id", "msg")
    return rows.select("conv_id", "segment", "mask_start", "mask_end").mapInArrow(
        _digest, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
                 "loss_sha256 string, formatted_chars bigint")
