"""Chat formatting by event sourcing.

A log of events is partitioned by conversation and sorted by sequence; a fold over the
sorted rows rebuilds the final messages from streamed deltas, edits and regenerations, and
renders them. The fold reads rows as they come: a task holds one conversation's messages,
never a partition.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from mediamix.llm.common import map_batches, type_of, whole_text

START, END = "<|im_start|>", "<|im_end|>\n"
#: Control strings of common chat templates, and the escape sign itself.
CONTROL = re.compile(r"\\|<\||</?s>|\[/?INST\]|<</?SYS>>")
ESCAPED = re.compile(r"\\(.)", re.DOTALL)
HEADER = re.compile(r"((?:\\.|[^\\\n])*)\n", re.DOTALL)
#: Characters of formatted text that a task hands on at a time.
HANDED = 1 << 22


def escape(text: str) -> str:
    """``text`` without control strings: a backslash splits each, backslashes double."""
    return CONTROL.sub(lambda m: m[0] * 2 if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text) if "\\" in text else text


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\\n")


def fold(events: Iterable[tuple[str, object, str, str]]) -> list[list]:
    """Final [role, text] messages of one conversation's events (kind, message, role, text).

    ``message`` opens a message; ``delta`` appends to it (and opens it if need be); ``edit``
    replaces its text; ``regenerate`` empties it for the deltas to come; ``retract`` takes
    it out. A message is named by ``message``; a name that is opened again, or null, is a
    new message, and later events mean the newest of a name. Edits, regenerations and
    retractions of an unknown message change nothing. Unknown kinds are an error.
    """
    messages: list[list | None] = []
    place: dict = {}
    for kind, message, role, text in events:
        if kind == "message" or kind == "delta" and message not in place:
            place[message] = len(messages)
            messages.append([role or "", [text or ""]])
        elif kind not in ("delta", "edit", "regenerate", "retract"):
            raise ValueError(f"unknown event {kind!r}")
        elif message in place and messages[place[message]] is not None:
            if kind == "retract":
                messages[place.pop(message)] = None
            elif kind == "delta":
                messages[place[message]][1].append(text or "")
            else:
                messages[place[message]][1] = [text or ""] if kind == "edit" else []
    return [[m[0], "".join(m[1])] for m in messages if m is not None]


def render(messages: list[list], learned: frozenset[str] = frozenset({"assistant"})) -> tuple[str, list[tuple[int, int]]]:
    """Formatted text, and the spans of it that count for the loss."""
    out, spans, at = [], [], 0
    for role, text in messages:
        head = f"{START}{escape_role(role)}\n"
        body = escape(text)
        if role in learned:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, END]
        at += len(head) + len(body) + len(END)
    return "".join(out), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of every turn of a formatted text."""
    turns = []
    for part in formatted.split(END)[:-1]:
        head = HEADER.match(part, len(START))
        turns.append((unescape(head[1]), unescape(part[head.end() :])))
    return turns


def format_log(log: DataFrame, conv: str = "conv_id", order: tuple[str, ...] = ("seq",), learned: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """Final formatted conversations of an event log.

    ``log`` has ``conv``, ``kind``, ``message``, ``role``, ``text`` and the columns of
    ``order``; other columns are not read. Returns per conversation: ``conv``,
    ``n_turns``, ``formatted``, ``loss_spans`` (start and end of each learned text in it).
    Null roles and texts are empty; a null conversation id is a conversation of its own;
    events with a null sequence come first. Events that tie in ``order`` have no defined
    order among them, so ``order`` must tell apart what differs. Repeated rows are repeated
    events. An empty log gives no conversations.
    """
    schema = StructType.fromDDL(f"conv {type_of(log, conv)}, n_turns bigint, formatted string, loss_spans array<struct<start:bigint,end:bigint>>")
    arrow, roles = to_arrow_schema(schema), frozenset(learned)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        size, current, events = 0, None, []

        def close() -> int:
            messages = fold(events)
            formatted, spans = render(messages, roles)
            done.append((current, len(messages), formatted, [{"start": a, "end": b} for a, b in spans]))
            return len(formatted)

        def handed() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(dict(zip(arrow.names, zip(*done))), schema=arrow)

        for batch in batches:
            for key, *event in zip(*(c.to_pylist() for c in batch.columns)):
                if events and key != current:
                    size += close()
                    events = []
                    if size > HANDED:
                        yield handed()
                        done, size = [], 0
                current = key
                events.append(event)
        if events:
            close()
        if done:
            yield handed()

    event = ("kind", "message", "role", "text")
    more = {c: f"__{c}" for c in order if c not in event}
    keyed = log.select(F.col(conv).alias("conv"), *event, *(F.col(c).alias(a) for c, a in more.items()))
    sort = ["conv", *(more.get(c, c) for c in order)]
    dealt = keyed.repartition("conv").sortWithinPartitions(*sort).select("conv", *event)
    return dealt.mapInArrow(run, schema).withColumnRenamed("conv", conv)


def digests(formatted: DataFrame, conv: str = "conv_id") -> DataFrame:
    """What can be read back from ``format_log``'s output: turns and learned text."""

    def make():
        def run(columns: dict) -> dict:
            turns = [parse(f) for f in columns["formatted"]]
            learned = ["".join(unescape(f[s["start"] : s["end"]]) for s in spans) for f, spans in zip(columns["formatted"], columns["loss_spans"])]
            return {
                "conv": columns["conv"],
                "n_turns": [len(t) for t in turns],
                "turns_sha256": [hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest() for t in turns],
                "loss_chars": [len(t) for t in learned],
                "loss_sha256": [hashlib.sha256(t.encode()).hexdigest() for t in learned],
                "formatted_chars": [len(f) for f in columns["formatted"]],
            }

        return run

    ddl = f"conv {type_of(formatted, conv)}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
    plain = formatted.select(F.col(conv).alias("conv"), "formatted", "loss_spans")
    return map_batches(plain, make, ddl).withColumnRenamed("conv", conv)


def log_of_rows(rows: DataFrame) -> DataFrame:
    """Event log of a table with one row per turn: each row opens its message."""
    return rows.select(
        "conv_id",
        F.lit("message").alias("kind"),
        F.col("turn").alias("message"),
        F.coalesce("role", F.lit("")).alias("role"),
        whole_text().alias("text"),
        F.col("turn").alias("seq"),
    )


#: Columns that put the events of ``history_of_rows`` in order.
HISTORY_ORDER = ("seq", "role", "whole", "row", "part")


def history_of_rows(rows: DataFrame) -> DataFrame:
    """Event log that ends in a table with one row per turn, as a client would have streamed it.

    By crc32(``conv_id:turn``) % 4 a turn is opened and completed by a delta (0), drafted and
    edited (1), drafted, regenerated and streamed anew (2), or streamed after another message
    was retracted (3). Rows of one turn follow each other by role and text, each with events
    of its own, repeated rows too. Null roles and texts are empty.
    """
    text, role = whole_text(), F.coalesce("role", F.lit(""))
    half = F.ceil(F.length(text) / 2).cast("int")
    head, rest, draft = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.length(text)), F.reverse(F.substring(text, F.lit(1), half))
    parts = {"role": role, "whole": text, "head": head, "rest": rest, "draft": draft}
    key = F.crc32(F.concat_ws(":", "conv_id", "turn").cast("binary"))
    named = rows.select("conv_id", F.col("turn").alias("seq"), F.monotonically_increasing_id().alias("row"), key.alias("hash"), *(c.alias(n) for n, c in parts.items()))

    def event(kind: str, text: Column | str, other: int = 0) -> Column:
        value = F.col(text) if isinstance(text, str) else text
        return F.struct(F.lit(kind).alias("kind"), (F.col("row") * 2 + other).alias("message"), value.alias("text"))

    nothing = F.lit("")
    events = (
        F.when(F.col("hash") % 4 == 0, F.array(event("message", "head"), event("delta", "rest")))
        .when(F.col("hash") % 4 == 1, F.array(event("message", "draft"), event("edit", "whole")))
        .when(F.col("hash") % 4 == 2, F.array(event("message", "draft"), event("regenerate", nothing), event("delta", "head"), event("delta", "rest")))
        .otherwise(F.array(event("message", "draft", 1), event("retract", nothing, 1), event("delta", "head"), event("delta", "rest")))
    )
    each = named.select("conv_id", "seq", "role", "whole", "row", F.posexplode(events).alias("part", "event"))
    return each.select("conv_id", "event.kind", "event.message", "role", "event.text", "seq", "whole", "row", "part")


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -1: two turns whose texts look like another template's control strings."""
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    return spark.range(2).select(F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
