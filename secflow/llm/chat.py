"""Chat formatting from event-sourced logs.

A log holds events of messages: ``start`` (its role), ``delta`` (text to append), ``edit`` (text that replaces all so
far), ``regenerate`` (all so far is void) and ``retract`` (the message goes). Events are partitioned by conversation and
message, sorted by sequence and folded into the final message. Messages are rendered one by one, so that a conversation
of any length is spread over many tasks; only its running digest is sequential, and that reads sorted rows as a stream.

A turn is written as ``<|im_start|>role<|im_sep|>text<|im_end|>``. Control strings in roles and texts, these and those of
other common templates, get a backslash behind their first character, and backslashes are doubled; that is undone by
taking each character behind a backslash as it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
#: What no text may hold unescaped.
CONTROL = ("<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_RESETS = ("edit", "regenerate")


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def reconstruct(events: DataFrame) -> DataFrame:
    """conv_id, message, place, role, text: the final message of each event log.

    ``events`` has conv_id, message (unique in its conversation), place (its order there), seq, kind, role and text.
    Events of a message are folded by seq (null first), ties by kind and then by text; a null text counts as empty, a
    kind that is not known changes nothing, and repeated events count as often as they occur. The role is the last one
    given; none at all is empty. A null conversation or message is a key like any other. An empty log gives no row.
    """
    event = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"), "role", "place")
    folded = events.groupBy("conv_id", "message").agg(F.array_sort(F.collect_list(event)).alias("e"))
    last = F.array_max(F.transform("e", lambda e, i: F.when(e["kind"].isin(*_RESETS), i).otherwise(-1)))
    alive = F.filter("e", lambda e, i: (i >= F.col("last")) & e["kind"].isin("delta", "edit"))
    roles = F.filter(F.transform("e", lambda e: e["role"]), lambda r: r.isNotNull())
    return (
        folded.withColumn("last", last)
        .filter(~F.exists("e", lambda e: F.coalesce(e["kind"] == "retract", F.lit(False))))
        .select(
            "conv_id", "message", F.array_min(F.transform("e", lambda e: e["place"])).alias("place"),
            F.coalesce(F.try_element_at(roles, F.lit(-1)), F.lit("")).alias("role"),
            F.array_join(F.transform(alive, lambda e: e["text"]), "").alias("text"),
        )
    )


def render(messages: DataFrame) -> DataFrame:
    """``messages`` with ``formatted`` and its loss mask ``loss_start``, ``loss_stop`` (code points, null if none).

    The conversation is what its turns give one after the other, by place, then role, text and message. The mask is on
    the texts of assistants.
    """
    role, text = escape(F.col("role")), escape(F.col("text"))
    begin = F.length(F.concat(F.lit(START), role, F.lit(SEP)))
    learned = F.col("role") == "assistant"
    return messages.withColumn("formatted", F.concat(F.lit(START), role, F.lit(SEP), text, F.lit(END))).withColumns({
        "loss_start": F.when(learned, begin), "loss_stop": F.when(learned, begin + F.length(text)),
    })


def read_back(rendered: DataFrame) -> DataFrame:
    """What a reader finds in each formatted turn: its role, its text, and the text under the mask (null if none)."""
    whole = r"(?s)^<\|im_start\|>(.*?)<\|im_sep\|>(.*)<\|im_end\|>$"
    found = F.col("formatted")
    masked = F.substring(found, F.col("loss_start") + 1, F.col("loss_stop") - F.col("loss_start"))
    return rendered.select(
        "conv_id", "place", "message", unescape(F.regexp_extract(found, whole, 1)).alias("role"),
        unescape(F.regexp_extract(found, whole, 2)).alias("text"), unescape(masked).alias("loss"),
        F.length(found).alias("formatted_chars"),
    )


def digest(turns: DataFrame) -> DataFrame:
    """One row for each conversation, from turns that were read back.

    Turns stream by in order; what a task holds is the state of two digests. A null conversation gives a row too.
    """
    order = ["conv_id", "place", "role", "text", "message"]

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None

        def row() -> tuple:
            return (None if now is pd.NA else now, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        for batch in batches:
            out = []
            for conv, role, text, loss, chars in zip(batch["conv_id"], batch["role"], batch["text"], batch["loss"], batch["formatted_chars"], strict=True):
                conv = pd.NA if pd.isna(conv) else int(conv)
                if state is None or (conv is pd.NA) != (now is pd.NA) or (conv is not pd.NA and conv != now):
                    if state is not None:
                        out.append(row())
                    now, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                if loss is not None:
                    state[2] += len(loss)
                    state[3].update(loss.encode())
                state[4] += chars
            yield pd.DataFrame(out, columns=names).astype({"conv_id": "Int64"})
        if state is not None:
            yield pd.DataFrame([row()], columns=names).astype({"conv_id": "Int64"})

    return turns.repartition("conv_id").sortWithinPartitions(*order).mapInPandas(
        stream, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )


def as_log(conversations: DataFrame) -> DataFrame:
    """The event log of a table of turns (conv_id, turn, role, text): each text arrives in two deltas.

    Each row is a message of its own, repeated rows too.
    """
    half = F.floor(F.length("text") / 2).cast("int")
    event = lambda seq, kind, text: F.struct(F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))
    events = F.array(
        event(0, "start", F.lit(None).cast("string")),
        event(1, "delta", F.substring("text", F.lit(1), half)),
        event(2, "delta", F.substr(F.col("text"), half + 1)),
    )
    rows = conversations.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("message"))
    return rows.select("conv_id", "message", F.col("turn").alias("place"), "role", F.explode(events).alias("e")).select("conv_id", "message", "place", "role", "e.*")


#: The query's rows in DuckDB's SQL.
SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped as (select *, length(""" + "".join(["replace("] * (len(CONTROL) + 1)) + "role || chr(10) || text, '\\', '\\\\')" + "".join(f", '{m}', '{m[0]}\\{m[1:]}')" for m in CONTROL) + r""") - 1 as chars from turns)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(chars + """ + str(len(START + SEP + END)) + r""") as bigint) as formatted_chars
from escaped group by conv_id
"""
