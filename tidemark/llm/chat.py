"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events: ``open`` (a message begins at a turn), ``delta`` (text is appended), ``edit``
(the text becomes this), ``regenerate`` (the message of that turn and all later ones are taken back, as of then).
The log is partitioned by conversation and sorted by sequence; what was valid last is folded into messages and
rendered. A message is folded on its own, so a conversation with a third of all events is as many groups as it
has messages; only the small numbers that regenerations leave behind are ordered within a conversation.

Rendering marks turns as ``<|im_start|>role``, newline, text, ``<|im_end|>``, newline. Control strings inside of
texts and roles get one backslash behind their first character, and those that have backslashes there one more, so
taking one away gives back the text; other texts stay as they are. The loss mask is the text of assistants.

Null texts and roles count as empty. Null turns come first; rows with the same turn are messages of their own,
ordered by role and text, equal rows too. A null conversation id is a conversation of its own. Events of unknown
kinds, without a sequence, or after whose last regeneration nothing was said leave no message. Empty tables give
empty results. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN, MIDDLE, END = "<|im_start|>", "\n", "<|im_end|>\n"
LOSS_ROLE = "assistant"
#: Control strings of this and other common templates, without their first character.
CONTROL_TAILS = ("|im_start|>", "|im_end|>", "|endoftext|>", "s>", "/s>", "INST]", "/INST]", "<SYS>>", "</SYS>>")
TAILS = "(" + "|".join(re.escape(t) for t in CONTROL_TAILS) + ")"
PLAIN, ESCAPED = r"([<\[])(\\*)" + TAILS, r"([<\[])\\(\\*)" + TAILS
TURN = re.compile(re.escape(BEGIN) + r"([^\n]*)\n(.*?)" + re.escape(END), re.DOTALL)
UNESCAPE = re.compile(ESCAPED)
#: Letters of one streamed piece, in the logs made from finished conversations.
PIECE = 1000
KINDS = ("open", "delta", "edit", "regenerate")


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, PLAIN, r"$1\\$2$3")


def escaped_role(role: Column) -> Column:
    """A role in one line: backslashes are doubled and line ends written as ``\\n`` first."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped(text: str) -> str:
    return UNESCAPE.sub(r"\1\2\3", text)


def unescaped_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescaped(role))


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a rendered conversation."""
    return [(unescaped_role(role), unescaped(text)) for role, text in TURN.findall(formatted)]


def event_log(rows: DataFrame) -> DataFrame:
    """The log that leads to finished conversations (conv_id, turn, role, text).

    Every message is opened and streamed in pieces. Assistants' messages are first streamed in part and then
    regenerated; the others are sent empty and edited at the end.
    """
    text = F.coalesce("text", F.lit(""))
    order = Window.partitionBy("conv_id").orderBy("turn", F.coalesce("role", F.lit("")), text)
    placed = rows.select(
        "conv_id", F.row_number().over(order).cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        text.alias("_text"),
    )
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.length("_text") / PIECE).cast("int") - 1)),
        lambda i: F.substring(F.col("_text"), i * PIECE + 1, F.lit(PIECE)),
    )

    def event(kind: str, said: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), said.alias("text"))

    streamed = F.transform(F.col("_pieces"), lambda piece: event("delta", piece))
    answer = F.concat(
        F.array(
            event("open", F.lit("")), event("delta", F.element_at("_pieces", 1)), event("delta", F.lit(" ...")),
            event("regenerate", F.lit(None).cast("string")),
        ),
        streamed,
    )
    question = F.concat(
        F.array(event("open", F.lit(""))), streamed, F.array(event("edit", F.col("_text"))),
    )
    logged = placed.withColumn("_pieces", pieces).select(
        "conv_id", "turn", "role",
        F.posexplode(F.when(F.col("role") == LOSS_ROLE, answer).otherwise(question)).alias("_at", "_event"),
    )
    role = F.when(F.col("_event.kind") == "open", F.col("role"))
    return logged.select(
        "conv_id", (F.col("turn") * (1 << 24) + F.col("_at")).alias("seq"), F.col("_event.kind").alias("kind"),
        "turn", role.alias("role"), F.col("_event.text").alias("text"),
    )


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of the messages that a log (conv_id, seq, kind, turn, role, text) leads to."""
    known = events.filter(F.col("kind").isin(*KINDS) & F.col("seq").isNotNull())
    regenerated = known.groupBy("conv_id", "turn").agg(
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("_again")
    )
    up_to = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    cuts = regenerated.select(
        F.col("conv_id").alias("_c"), F.col("turn").alias("_t"), F.max("_again").over(up_to).alias("_cut")
    )
    said = F.when(
        F.col("kind") != "regenerate",
        F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text")),
    )
    messages = known.groupBy("conv_id", "turn").agg(
        F.sort_array(F.collect_list(said)).alias("_said"),
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).alias("role"),
    )
    valid = messages.join(
        cuts, F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t"))
    ).withColumn("_said", F.filter("_said", lambda e: F.col("_cut").isNull() | (e["seq"] > F.col("_cut"))))
    edits = F.transform(F.filter("_said", lambda e: e["kind"] == "edit"), lambda e: e["seq"])
    valid = valid.filter(F.size("_said") > 0).withColumn("_edit", F.array_max(edits))
    kept = F.filter("_said", lambda e: F.col("_edit").isNull() | (e["seq"] >= F.col("_edit")))
    return valid.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.array_join(F.transform(kept, lambda e: e["text"]), "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, segment, loss_start, loss_end) per message.

    A conversation is its segments in order of turns; the part of a segment from loss_start to loss_end, in
    code points, is under the loss mask (both null: nothing is).
    """
    head = F.concat(F.lit(BEGIN), escaped_role(F.col("role")), F.lit(MIDDLE))
    body = escaped(F.col("text"))
    start = F.when(F.col("role") == LOSS_ROLE, F.length(head))
    return messages.select(
        "conv_id", "turn", F.concat(head, body, F.lit(END)).alias("segment"), start.alias("loss_start"),
        (start + F.length(body)).alias("loss_end"),
    )


def conversations(segments: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss) with whole conversations as one text each and their masks as spans."""
    listed = segments.groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "segment", "loss_start", "loss_end"))).alias("_s")
    )
    spans = F.aggregate(
        "_s",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda state, s: F.struct(
            (state["at"] + F.length(s["segment"])).alias("at"),
            F.when(s["loss_start"].isNull(), state["spans"]).otherwise(
                F.array_append(state["spans"], F.struct(
                    (state["at"] + s["loss_start"]).alias("start"), (state["at"] + s["loss_end"]).alias("end")
                ))
            ).alias("spans"),
        ),
    )
    return listed.select(
        "conv_id", F.array_join(F.transform("_s", lambda s: s["segment"]), "").alias("formatted"),
        spans["spans"].alias("loss"),
    )


def _read_back(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests of each conversation, from its segments in order; nothing of a conversation is kept but its sums."""
    current, sums = None, None

    def row() -> tuple:
        turns, turn_hash, loss, loss_hash, chars = sums
        return current, turns, turn_hash.hexdigest(), loss, loss_hash.hexdigest(), chars

    for batch in batches:
        done = []
        for conv, segment, start, end in zip(batch["_conv"], batch["segment"], batch["loss_start"], batch["loss_end"]):
            if sums is None or conv != current:
                if sums is not None:
                    done.append(row())
                current, sums = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in parse(segment):
                sums[0] += 1
                sums[1].update(f"{role}\n{text}\n".encode("utf-8", "replace"))
            if start == start and start is not None:
                masked = unescaped(segment[int(start):int(end)])
                sums[2] += len(masked)
                sums[3].update(masked.encode("utf-8", "replace"))
            sums[4] += len(segment)
        if done:
            yield _frame(done)
    if sums is not None:
        yield _frame([row()])


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = ("_conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    return pd.DataFrame(rows, columns=list(names))


def digests(segments: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256 and formatted_chars, read back from segments."""
    ordered = segments.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("_conv"), "turn", "segment", "loss_start",
        "loss_end",
    ).repartition("_conv").sortWithinPartitions("_conv", "turn")
    read = ordered.mapInPandas(
        _read_back,
        "_conv string, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
    conv = F.when(F.col("_conv") != "", F.col("_conv").cast("long")).alias("conv_id")
    return read.select(conv, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
