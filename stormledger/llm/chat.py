"""Chat formatting: rebuild conversations from an event log and render them.

Events: ``conv_id``, ``message_id`` (orders the messages of a conversation), ``seq`` (orders the events of
a message), ``kind``, ``role``, ``text``. Kinds: ``message`` (whole text), ``delta`` (appended),
``edit`` (replaces the text so far), ``regenerate`` (drops the text so far; deltas rebuild
it), ``delete``. A message is the fold of its own events, so a conversation that holds a
third of all events is folded by many tasks. Rendering gives one row per message; a
conversation's text is its rows in order, never one long string in memory.

Defined cases: null text and null role are empty; a null conv_id is a conversation of its own; deltas
without an opening event open their message; events of equal seq fold in order of kind and text; an empty
log gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPENING = ("message", "edit", "regenerate", "delete")
START, END = "### ", "</turn>\n"
RENDERED = re.compile(r"### ((?:[^\\\n]|\\.)*)\n((?:[^\\<]|\\.)*)</turn>\n", re.DOTALL)
DIGEST_SCHEMA = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
)


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, message_id, role, text) of the messages that remain."""
    text = F.coalesce(F.col("text"), F.lit(""))
    opens = F.col("kind").isin(*OPENING)
    event = F.struct(F.col("seq"), F.col("kind"), text.alias("text"))
    folded = events.groupBy("conv_id", "message_id").agg(
        F.max(F.when(opens, event)).alias("opened"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "delta", event))).alias("deltas"),
        F.max(F.struct(F.col("seq"), F.coalesce("role", F.lit("")).alias("role"))).alias("last"),
    )
    later = F.filter("deltas", lambda d: F.col("opened").isNull() | (d["seq"] > F.col("opened")["seq"]))
    base = F.when(F.col("opened.kind").isin("message", "edit"), F.col("opened.text")).otherwise("")
    return folded.where("opened IS NULL OR opened.kind <> 'delete'").select(
        "conv_id",
        "message_id",
        F.col("last.role").alias("role"),
        F.concat(base, F.array_join(F.transform(later, lambda d: d["text"]), "")).alias("text"),
    )


def escape(column, also: str = ""):
    """A backslash before every character that a control string starts with."""
    return F.regexp_replace(column, rf"([\\#<{also}])", r"\\$1")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


def render(messages: DataFrame) -> DataFrame:
    """Adds ``formatted`` and the loss mask as character offsets in it (null: nothing to learn)."""
    head = F.concat(F.lit(START), escape(F.coalesce("role", F.lit("")), "\\n"), F.lit("\n"))
    body = escape(F.coalesce("text", F.lit("")))
    learns = F.col("role") == "assistant"
    return messages.withColumns(
        {
            "formatted": F.concat(head, body, F.lit(END)),
            "loss_start": F.when(learns, F.length(head).cast("long")),
            "loss_end": F.when(learns, (F.length(head) + F.length(body)).cast("long")),
        }
    )


def parse_formatted(formatted: str) -> tuple[str, str]:
    """Role and text of one rendered message."""
    m = RENDERED.fullmatch(formatted)
    if not m:
        raise ValueError("not a rendered message")
    return unescape(m[1]), unescape(m[2])


def digests(rendered: DataFrame) -> DataFrame:
    """One row per conversation, read back from the rendered messages.

    SHA-256 of a conversation is sequential by nature: its rows stream through one task in
    order, with only the running digests in memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv: object = ...
        state: list = []

        def row() -> dict:
            n, turns, chars, loss, size = state
            return {
                "conv_id": conv,
                "n_turns": n,
                "turns_sha256": turns.hexdigest(),
                "loss_chars": chars,
                "loss_sha256": loss.hexdigest(),
                "formatted_chars": size,
            }

        for batch in batches:
            done = []
            for r in batch.to_pylist():
                if r["conv_id"] != conv or conv is ...:
                    if conv is not ...:
                        done.append(row())
                    conv, state = r["conv_id"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text = parse_formatted(r["formatted"])
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if r["loss_start"] is not None:
                    learned = unescape(r["formatted"][r["loss_start"] : r["loss_end"]])
                    state[2] += len(learned)
                    state[3].update(learned.encode())
                state[4] += len(r["formatted"])
            if done:
                yield pa.RecordBatch.from_pylist(done, out)
        if conv is not ...:
            yield pa.RecordBatch.from_pylist([row()], out)

    out = pa.schema(
        [
            ("conv_id", pa.int64()),
            ("n_turns", pa.int64()),
            ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()),
            ("loss_sha256", pa.string()),
            ("formatted_chars", pa.int64()),
        ]
    )
    ordered = (
        rendered.select("conv_id", "message_id", "formatted", "loss_start", "loss_end")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "message_id")
        .drop("message_id")
    )
    return ordered.mapInArrow(run, DIGEST_SCHEMA)


def events_of_turns(turns: DataFrame) -> DataFrame:
    """A log with one ``message`` event per row of (conv_id, turn, role, text).

    Rows that repeat each other are counted before they are dealt out, then get numbers, so that each stays
    a message. Turns of equal number follow each other by role and text.
    """
    key = [
        F.col("conv_id"),
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ]
    counted = turns.select(*key).groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    one = counted.select(
        "conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy")
    )
    message = F.struct("turn", "role", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "copy")
    return one.select(
        "conv_id",
        message.alias("message_id"),
        F.lit(0).cast("long").alias("seq"),
        F.lit("message").alias("kind"),
        "role",
        "text",
    )
