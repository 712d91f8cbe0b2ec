"""Conversations as training strings with a loss mask, by Spark expressions only.

The turns of a conversation are collected as structs and sorted, neighbours of one role become one block, and
the blocks are joined to one string:

    <s>[INST role] text[TURN]text[/INST]</s> ...

Square brackets and ``<`` stand only in the template: in texts and roles they and ``&`` are written as entities, so no
text can close a turn or open another, and what is read back equals what came in. ``[TURN]`` keeps the border between
merged turns of one role. Queries: `registered queries <queries.py>`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, NAMED, NEXT, CLOSE = "<s>[INST ", "] ", "[TURN]", "[/INST]</s>"
LEARNED = "assistant"
_ENTITIES = {"&": "&amp;", "[": "&#91;", "]": "&#93;", "<": "&lt;"}


def escaped(text: Column) -> Column:
    for raw, entity in _ENTITIES.items():
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def unescaped(text: Column) -> Column:
    for raw, entity in reversed(_ENTITIES.items()):
        text = F.replace(text, F.lit(entity), F.lit(raw))
    return text


def _blocks(said: Column) -> Column:
    """Sorted turns as blocks (role, texts): a block starts where the role differs from the turn before."""
    starts = F.filter(
        F.sequence(F.lit(1), F.size(said)),
        lambda i: (i == 1) | (F.get(said, i - 1)["role"] != F.get(said, i - 2)["role"]),
    )
    ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(said) + 1))
    return F.zip_with(
        starts,
        ends,
        lambda a, b: F.struct(
            F.get(said, a - 1)["role"].alias("role"), F.transform(F.slice(said, a, b - a), lambda t: t["text"]).alias("texts")
        ),
    )


def _pieces(block: Column) -> Column:
    """A block's strings in order, each with the mark whether it is learned."""

    def piece(text: Column, learned: Column) -> Column:
        return F.struct(text.alias("text"), learned.alias("learned"))

    no = F.lit(False)
    head = F.array(piece(F.concat(F.lit(OPEN), block["role"], F.lit(NAMED)), no))
    body = F.transform(
        block["texts"],
        lambda t, i: F.array(
            piece(F.when(i == 0, "").otherwise(NEXT), no), piece(t, block["role"] == LEARNED)
        ),
    )
    return F.concat(head, F.flatten(body), F.array(piece(F.lit(CLOSE), no)))


def _mask(pieces: Column) -> Column:
    """Spans (start, length) in characters of the learned pieces."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def step(state: Column, piece: Column) -> Column:
        size = F.char_length(piece["text"]).cast("long")
        span = F.struct(state["at"].alias("start"), size.alias("length"))
        spans = F.when(piece["learned"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + size).alias("at"), spans.alias("spans"))

    return F.aggregate(pieces, start, step, lambda state: state["spans"])


def format_chats(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, and loss_mask, an array of (start, length) over its characters.

    Turns are ordered by turn (NULL first), then role, then text, so repeated rows and ties have one order. A NULL text
    or role is empty. Rows with NULL conv_id make one conversation. Other columns are ignored; no rows, no conversations.
    """
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"),
        escaped(F.coalesce(F.col("role"), F.lit(""))).alias("role"),
        escaped(F.coalesce(F.col("text"), F.lit(""))).alias("text"),
    )
    chats = rows.select("conv_id", turn.alias("said")).groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("said"))
    chats = chats.select("conv_id", F.flatten(F.transform(_blocks(F.col("said")), _pieces)).alias("pieces"))
    return chats.select(
        "conv_id",
        F.array_join(F.transform("pieces", lambda p: p["text"]), "").alias("formatted"),
        _mask(F.col("pieces")).alias("loss_mask"),
    )


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, merged ones apart again."""

    def turns(block: Column) -> Column:
        opened = F.substr(block, F.lit(len(OPEN) + 1))
        role = F.substring_index(opened, NAMED, 1)
        texts = F.split(F.substr(opened, F.char_length(role) + len(NAMED) + 1), r"\[TURN\]")
        return F.transform(texts, lambda t: F.struct(unescaped(role).alias("role"), unescaped(t).alias("text")))

    closed = F.split(formatted, r"\[/INST\]</s>")
    return F.flatten(F.transform(F.slice(closed, 1, F.size(closed) - 1), turns))


def learned_text(formatted: Column, mask: Column) -> Column:
    """All text under the mask, unescaped, nothing between."""
    return F.array_join(
        F.transform(mask, lambda m: unescaped(F.substr(formatted, (m["start"] + 1).cast("int"), m["length"].cast("int")))), ""
    )
