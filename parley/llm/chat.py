"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes one training example: all turns before it as
context, and its own text as the only trainable span.  A conversation that
does not end with an assistant turn gets one more example, without a
trainable span, so that the output still holds all of its turns.

A turn is written as ``### role:`` and a line end, its text, and ``</turn>``
and a line end.  ``&``, ``<`` and ``#`` (and ``:`` in a role) inside roles
and texts are written as entities, so no control string can occur there and
reading back is exact whatever a text holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, HEAD_END, TURN_END = "### ", ":\n", "</turn>\n"
TRAINED_ROLE = "assistant"
# Character and its entity; & is escaped first and read back last.
_ENTITIES = (("&", "&amp;"), ("<", "&lt;"), ("#", "&num;"), (":", "&colon;"))


def _escape(text: Column, entities=_ENTITIES) -> Column:
    for char, entity in entities:
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def escape_text(text: Column) -> Column:
    """A turn's text as it is written; null is written as empty."""
    return _escape(F.coalesce(text, F.lit("")), _ENTITIES[:3])


def escape_role(role: Column) -> Column:
    return _escape(F.coalesce(role, F.lit("")))


def unescape(text: Column) -> Column:
    for char, entity in reversed(_ENTITIES):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def prefix_examples(turns: DataFrame, conv: str = "conv_id", turn: str = "turn",
                    role: str = "role", text: str = "text") -> DataFrame:
    """One row for each example: conv_id, example, text, loss_start, loss_length, whole.

    ``example`` is the place (from 1) of the example's last turn,
    ``loss_start`` counts code points from 0, and ``whole`` marks the
    example that holds all turns of its conversation.  Turns are ordered by
    turn, then role and text (nulls first), so ties and repeated rows have a
    fixed place; a null conversation id is a conversation of its own.  Null
    texts and roles count as empty.  Other columns are not read; an empty
    table has no examples.  A conversation must fit one row, as its last
    example is one string; contexts are made one example at a time.
    """
    written = turns.select(
        F.col(conv).alias("conv_id"),
        F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"),
                 F.concat(F.lit(HEAD), escape_role(F.col(role)), F.lit(HEAD_END)).alias("head"),
                 escape_text(F.col(text)).alias("body")).alias("t"))
    gathered = written.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    targets = F.filter(
        F.sequence(F.lit(1), F.size("t")),
        lambda n: (F.element_at("t", n)["role"] == TRAINED_ROLE) | (n == F.size("t")))
    chosen = gathered.select(
        "conv_id", "t",
        F.transform("t", lambda x: F.concat(x["head"], x["body"], F.lit(TURN_END))).alias("written"),
        F.explode(targets).alias("example"))
    last = F.element_at("t", F.col("example"))
    parts = chosen.select(
        "conv_id", "example", (F.col("example") == F.size("t")).alias("whole"),
        F.array_join(F.slice("written", F.lit(1), F.col("example") - 1), "").alias("context"),
        last["head"].alias("head"), last["body"].alias("body"),
        F.coalesce(last["role"] == TRAINED_ROLE, F.lit(False)).alias("trained"))
    return parts.select(
        "conv_id", "example",
        F.concat("context", "head", "body", F.lit(TURN_END)).alias("text"),
        (F.length("context") + F.length("head")).cast("long").alias("loss_start"),
        F.when(F.col("trained"), F.length("body")).otherwise(0).cast("long").alias("loss_length"),
        "whole")


def read_turns(text: Column) -> Column:
    """The turns of an example's text: array of (role, text), unescaped."""
    pieces = F.filter(F.split(text, TURN_END), lambda p: p != "")

    def turn(piece: Column) -> Column:
        at = F.instr(piece, HEAD_END)
        return F.struct(
            unescape(F.substring(piece, F.lit(len(HEAD) + 1), at - 1 - len(HEAD))).alias("role"),
            unescape(F.substring(piece, at + len(HEAD_END), F.length(piece))).alias("text"))
    return F.transform(pieces, turn)


def loss_text(text: Column, start: Column, length: Column) -> Column:
    """The trainable text of an example, unescaped."""
    return unescape(F.substring(text, (start + 1).cast("int"), length.cast("int")))


def digests(examples: DataFrame) -> DataFrame:
    """One row for each conversation, read back from its examples."""
    turns = read_turns(F.col("text"))
    told = F.array_join(F.transform(
        turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = examples.select(
        "conv_id", F.length("text").cast("long").alias("chars"),
        F.when(F.col("whole"), F.size(turns)).alias("n_turns"),
        F.when(F.col("whole"), F.sha2(told, 256)).alias("turns_sha256"),
        F.struct("example", loss_text(F.col("text"), F.col("loss_start"), F.col("loss_length"))
                 .alias("text")).alias("loss"))
    joined = read.groupBy("conv_id").agg(
        F.max("n_turns").cast("long").alias("n_turns"), F.max("turns_sha256").alias("turns_sha256"),
        F.array_join(F.sort_array(F.collect_list("loss"))["text"], "").alias("loss"),
        F.sum("chars").alias("formatted_chars"))
    return joined.select("conv_id", "n_turns", "turns_sha256",
                         F.length("loss").cast("long").alias("loss_chars"),
                         F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")
