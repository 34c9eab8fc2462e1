"""Chat formatting: event logs folded to final messages, rendered with a template.

A log has the columns ``conv_id``, ``seq``, ``kind``, ``msg_id``, ``role`` and ``text``:

* ``message`` starts a message (or starts it anew) with ``text``,
* ``delta`` appends ``text`` to the message's present version,
* ``edit`` replaces the message's text by ``text``; later deltas append to that,
* ``regenerate`` drops the present version; ``text`` (often empty) starts the next,
* ``delete`` takes the message out.

A message stands where its first event stands. Everything is built from DataFrame
functions. Deltas are folded by (conversation, message), so that one long conversation
is spread over tasks; only rendered messages meet in the conversation's one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
TURN_END = END + "\n"


def escape(text: Column) -> Column:
    r"""Make control strings impossible in ``text``: ``\`` becomes ``\b``, then ``<|`` becomes ``<\p``."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("<\\p"))


def unescape(text: Column) -> Column:
    r"""Undo :func:`escape`: every ``\`` of an escaped text stands before ``b`` or ``p``."""
    return F.replace(F.replace(text, F.lit("\\p"), F.lit("|")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    r"""Roles end at a line feed, which is written as ``\n`` inside them."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def events_of_turns(conversations: DataFrame) -> DataFrame:
    """One ``message`` event for each row of (conv_id, turn, role, text).

    Nulls in role or text are empty strings; a null conv_id is a conversation of its own;
    ties and repeated rows of a turn are messages of their own, ordered by role and text.
    """
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return rows.select(
        "conv_id",
        F.row_number().over(order).cast("long").alias("seq"),
        F.lit("message").alias("kind"),
        F.row_number().over(order).cast("string").alias("msg_id"),
        "role",
        "text",
    )


def streamed(messages: DataFrame) -> DataFrame:
    """A log that folds to the same messages as ``message`` events do, by all kinds of events, as a chat service would write it.

    By ``seq`` modulo three a text comes in two deltas, as an edit of another text, or after a regeneration of one. A
    message's events keep its place among the others; each ``seq`` becomes five numbers.
    """
    half = (F.length("text") / 2).cast("int")
    event = lambda at, kind, text, role=F.lit(None): F.struct((F.col("seq") * 5 + at).alias("seq"), F.lit(kind).alias("kind"), role.cast("string").alias("role"), text.cast("string").alias("text"))
    own, none, draft = F.col("role"), F.lit(None), F.lit("a draft")
    deltas = F.array(event(0, "message", F.lit(""), own), event(1, "delta", F.substring(F.col("text"), F.lit(1), half)), event(2, "delta", F.substring(F.col("text"), half + 1, F.length("text"))))
    edited = F.array(event(0, "message", draft, own), event(1, "delta", draft), event(2, "edit", F.col("text")))
    again = F.array(event(0, "message", draft, own), event(1, "regenerate", none), event(2, "delta", F.col("text")))
    turn = F.pmod("seq", F.lit(3))
    return messages.select("conv_id", "msg_id", F.explode(F.when(turn == 0, deltas).when(turn == 1, edited).otherwise(again)).alias("e")).select("conv_id", "e.seq", "e.kind", "msg_id", "e.role", "e.text")


def fold_events(events: DataFrame) -> DataFrame:
    """The final messages of event logs: (conv_id, position, msg_id, role, text).

    Null texts are empty; a null kind counts as ``message``; events before a message's first
    ``message`` event belong to it too; ties of ``seq`` inside a message are taken by kind, then text; messages
    that begin at one ``seq`` stand in order of msg_id; an empty log has no messages. The role is the last
    non-null role given, the greatest of a tie.
    """
    starts = F.col("kind").isin("message", "edit", "regenerate", "delete")
    rows = events.select(
        "conv_id",
        "seq",
        F.coalesce("kind", F.lit("message")).alias("kind"),
        "msg_id",
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    log = F.array_sort(F.collect_list(F.struct("seq", "kind", "text", "role")))
    folded = rows.groupBy("conv_id", "msg_id").agg(
        log.alias("log"),
        F.max(F.when(starts, F.struct("seq", "kind", "text", "role"))).alias("base"),
        F.max(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).alias("last_role"),
        F.min("seq").alias("position"),
    )
    later = F.filter("log", lambda e: F.col("base").isNull() | (F.struct(e["seq"], e["kind"], e["text"], e["role"]) > F.col("base")))
    return folded.where(F.col("base").isNull() | (F.col("base.kind") != "delete")).select(
        "conv_id",
        "position",
        "msg_id",
        F.coalesce("last_role.role", F.lit("")).alias("role"),
        F.concat(F.coalesce("base.text", F.lit("")), F.array_join(F.transform(later, lambda e: e["text"]), "")).alias("text"),
    )


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation of messages (conv_id, position, msg_id, role, text): conv_id, formatted, loss_spans (start, length in code points of ``formatted``).

    A turn is ``<|im_start|>`` role, line feed, text, ``<|im_end|>``, line feed, with role and
    text escaped. A span covers the escaped text of a turn of ``loss_role``.
    """
    role, text = escape_role(F.col("role")), escape(F.col("text"))
    turns = messages.select(
        "conv_id",
        "position",
        "msg_id",
        (F.col("role") == loss_role).alias("loss"),
        F.concat(F.lit(START), role, F.lit("\n")).alias("head"),
        text.alias("body"),
    ).withColumn("turn_length", F.length("head") + F.length("body") + len(TURN_END))
    before = Window.partitionBy("conv_id").orderBy("position", "msg_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.withColumn("at", F.coalesce(F.sum("turn_length").over(before), F.lit(0)) + F.length("head"))
    whole = placed.groupBy("conv_id").agg(
        F.array_sort(
            F.collect_list(F.struct("position", "msg_id", F.concat("head", "body", F.lit(TURN_END)).alias("turn"), "loss", F.col("at").alias("start"), F.length("body").cast("long").alias("length")))
        ).alias("turns")
    )
    return whole.select(
        "conv_id",
        F.array_join("turns.turn", "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"))).alias("loss_spans"),
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def read_back(formatted: Column) -> Column:
    """Parse a formatted conversation into an array of (role, text), unescaped."""
    parts = F.filter(F.split(formatted, r"\Q" + TURN_END + r"\E"), lambda p: p != "")
    body = lambda p: F.substring(p, len(START) + 1, F.length(p))
    return F.transform(
        parts,
        lambda p: F.struct(
            unescape_role(F.substring_index(body(p), "\n", 1)).alias("role"),
            unescape(F.substring(body(p), F.instr(body(p), "\n") + 1, F.length(body(p)))).alias("text"),
        ),
    )
