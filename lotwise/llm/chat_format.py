"""Chat formatting by event-sourced reconstruction.

A log has one event a row: conv_id, seq, op, msg_id, role, text. The ops are
  message     a new message, or a full replacement, with a role and a whole text
  delta       more text at the end of the message
  edit        the text so far is replaced
  regenerate  the text so far is thrown away; deltas begin anew
A message stands where its first event stood. Events of one message are folded in seq
order, then messages are put in order and rendered.

Template, one turn: '### ' role ': ' text '</turn>' and a newline. Inside role and text a
backslash becomes two, '##' becomes '#\\#' and '</turn>' becomes '<\\/turn>'; in roles
':' and a newline also get a backslash before them. So control strings are never in a
text, and taking away the backslashes gives the text back.
"""

from __future__ import annotations

import hashlib
import re

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import sliced, table

TURN = re.compile(r"### ((?:[^:\\\n]|\\.)*): (.*?)</turn>\n", re.S)


def escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("##", "#\\#").replace("</turn>", "<\\/turn>")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def escape_role(role: str) -> str:
    return escape(role).replace(":", "\\:").replace("\n", "\\\n")


def render(role: str, text: str) -> str:
    return f"### {escape_role(role)}: {escape(text)}</turn>\n"


def parse(formatted: str) -> list[tuple[str, str]]:
    """Read turns back; fails if anything is left between them."""
    turns, at = [], 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return turns


def folded_messages(events: DataFrame) -> DataFrame:
    """One row per message: conv_id, msg_id, pos (seq of its first event), role, text.

    The log is partitioned by conversation and message, so a conversation with most of it
    is dealt over all tasks, and sorted by seq; keys and seq may have any type that sorts.
    Ties of seq are ordered by op, role, text, nulls first. Null text counts as empty, a
    null role leaves the role as it is (empty if there is none), an unknown or null op is
    a message. A message whose last reset has no deltas is empty.
    """
    keys, names = ["conv_id", "msg_id"], ["conv_id", "msg_id", "pos", "role", "text"]

    def fold(batches):
        state = None

        def row(s):
            return *s["key"], s["pos"], s["role"], "".join(s["parts"])

        def rows(found):
            columns = list(zip(*found)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in sliced(batches):
            out = []
            types = [batch.schema.field(c).type for c in ("conv_id", "msg_id", "seq")] + [pa.string()] * 2
            for e in batch.to_pylist():
                key = (e["conv_id"], e["msg_id"])
                if state is None or state["key"] != key:
                    if state is not None:
                        out.append(row(state))
                    state = {"key": key, "pos": e["seq"], "role": "", "parts": []}
                state["role"] = e["role"] if e["role"] is not None else state["role"]
                if e["op"] != "delta":
                    state["parts"] = []
                if e["op"] != "regenerate":
                    state["parts"].append(e["text"] or "")
            yield rows(out)
        if state is not None:
            yield rows([row(state)])

    kind = {f.name: f.dataType.simpleString() for f in events.schema}
    return (
        events.select(*keys, "seq", "op", "role", "text")
        .repartition(*keys)
        .sortWithinPartitions(*keys, "seq", "op", "role", "text")
        .mapInArrow(fold, f"conv_id {kind['conv_id']}, msg_id {kind['msg_id']}, pos {kind['seq']}, role string, text string")
    )


#: What orders a conversation's messages: rows of one position by role and text, nulls first.
ORDER = ("pos", "role", "text", "msg_id")


def ordered_messages(messages: DataFrame) -> DataFrame:
    """Messages partitioned by conversation and in order there."""
    return messages.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER)


def rendered_turns(messages: DataFrame) -> DataFrame:
    """conv_id, pos, role, text, msg_id, formatted: each message as the template writes it."""

    @F.pandas_udf("string")
    def turn(role: pd.Series, text: pd.Series) -> pd.Series:
        return role.combine(text, render)

    return messages.select("conv_id", *ORDER, turn("role", "text").alias("formatted"))


def formatted_conversations(messages: DataFrame) -> DataFrame:
    """conv_id, formatted: whole conversations, for those that fit in one string."""
    turns = rendered_turns(messages).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(*ORDER, "formatted"))).alias("t"))
    return turns.select("conv_id", F.array_join("t.formatted", "").alias("formatted"))


def read_back(ordered: DataFrame) -> DataFrame:
    """Digests of every conversation, read from its rendered turns.

    Turns arrive partitioned and sorted (ordered_messages) and are hashed as they pass, so
    memory holds one slice of them only, however long a conversation is. What is under the
    loss mask is the text between the markers of assistant turns, unescaped.
    """
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

    def digest(batches):
        state = None

        def begin(conv):
            return {"conv": conv, "n": 0, "all": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}

        def row(s):
            return s["conv"], s["n"], s["all"].hexdigest(), s["loss_chars"], s["loss"].hexdigest(), s["chars"]

        def rows(found):
            columns = list(zip(*found)) or [[]] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in sliced(batches):
            out = []
            types = [batch.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            for conv, formatted in zip(batch.column("conv_id").to_pylist(), batch.column("formatted").to_pylist()):
                if state is None or state["conv"] != conv:
                    if state is not None:
                        out.append(row(state))
                    state = begin(conv)
                state["chars"] += len(formatted)
                for role, text in parse(formatted):
                    state["n"] += 1
                    state["all"].update(f"{role}\n{text}\n".encode())
                    if role == "assistant":
                        state["loss"].update(text.encode())
                        state["loss_chars"] += len(text)
            yield rows(out)
        if state is not None:
            yield rows([row(state)])

    kind = ordered.schema["conv_id"].dataType.simpleString()
    return rendered_turns(ordered).select("conv_id", "formatted").mapInArrow(
        digest, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def conversation_events(conversations: DataFrame) -> DataFrame:
    """A log that folds to a table of turns, one message a row; null text is empty.

    By a hash of the row, a message comes whole, streamed in deltas, edited after a draft,
    or regenerated after a first answer. Its seq is (turn, step).
    """
    text = F.coalesce("text", F.lit(""))
    half = F.floor(F.length(text) / 2).cast("int")
    first, rest = F.substring(text, F.lit(1), half), F.substring(text, half + 1, F.length(text))

    def log(*events):
        return F.array(*[
            F.struct(F.lit(step).alias("step"), F.lit(op).alias("op"), (F.col("role") if step == 0 else F.lit(None).cast("string")).alias("role"), x.alias("text"))
            for step, (op, x) in enumerate(events)
        ])

    logs = [
        log(("message", text)),
        log(("message", F.lit("")), ("delta", first), ("delta", rest)),
        log(("message", first), ("delta", first), ("edit", text)),
        log(("message", rest), ("regenerate", F.lit(None).cast("string")), ("delta", first), ("delta", rest)),
    ]
    kind = F.pmod(F.xxhash64("conv_id", "turn", "role", "text"), F.lit(len(logs)))
    chosen = F.when(kind == 0, logs[0]).when(kind == 1, logs[1]).when(kind == 2, logs[2]).otherwise(logs[3])
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.monotonically_increasing_id().alias("msg_id"), chosen.alias("log"))
    return rows.select("conv_id", "turn", "msg_id", F.explode("log").alias("e")).select("conv_id", F.struct("turn", "e.step").alias("seq"), "e.op", "msg_id", "e.role", "e.text")


TRICKY = "\\### Assistant: </turn> ok"


def op5_event_sourced_chat(spark, sf_dir):
    """Digests of all conversations and of conversation -7, read back from what the template wrote.

    Turns of one number are ordered by role and text, a null turn comes first; null role
    and text are empty.
    """
    extra = spark.createDataFrame([(-7, 0, "user", TRICKY), (-7, 1, "assistant", TRICKY)], "conv_id long, turn long, role string, text string")
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return read_back(ordered_messages(folded_messages(conversation_events(conversations))))


#: Lengths are counted from what escaping adds: one for each backslash, '##' and '</turn>'.
SQL = {
    "op5_event_sourced_chat": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, CASE WHEN role = 'assistant' THEN text END AS loss,
         4 + length(role) + 2 + length(text) + 8
         + length(text) - length(replace(text, '\', ''))
         + (length(text) - length(replace(text, '##', ''))) // 2
         + (length(text) - length(replace(text, '</turn>', ''))) // 7 AS chars
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(loss)), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(loss, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""
}
