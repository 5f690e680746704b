"""Conversations as training text: escaped, merged by role, with a loss mask. Spark expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed marks of the template. A run of turns of one role is one block; ``[TURN]`` parts its turns.
USER = ("[INST]", "[/INST]")
ASSISTANT = ("<s>", "</s>")
OTHER = ("[ROLE]", "[/ROLE]")
TURN = "[TURN]"

SEGMENTS = "array<struct<text:string,loss:boolean>>"


def escape(text: Column) -> Column:
    """Put one more backslash after the first character of every mark, escaped or not."""
    text = F.regexp_replace(text, r"<(\\*/?s>)", r"<\\$1")
    return F.regexp_replace(text, r"\[(\\*(?:/?INST|/?ROLE|TURN)\])", r"[\\$1")


def unescape(text: Column) -> Column:
    """Undo ``escape``: every mark in an escaped text has a backslash to take away."""
    text = F.regexp_replace(text, r"<\\(\\*/?s>)", "<$1")
    return F.regexp_replace(text, r"\[\\(\\*(?:/?INST|/?ROLE|TURN)\])", "[$1")


def _segment(text: Column, loss: Column | None = None) -> Column:
    return F.struct(text.alias("text"), (F.lit(False) if loss is None else loss).alias("loss"))


def _opening(role: Column) -> Column:
    named = F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]))
    return F.when(role == "user", USER[0]).when(role == "assistant", ASSISTANT[0]).otherwise(named)


def _closing(role: Column) -> Column:
    return F.when(role == "user", USER[1]).when(role == "assistant", ASSISTANT[1]).otherwise("")


def format_chats(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and its ``segments`` with the loss mask.

    Turns go by ``turn`` (null first), then role, then text, so ties and repeated rows
    have one order; a null role or text counts as empty, and rows without a conversation
    id form the conversation null. Neighbouring turns of one role are merged into a
    block. ``segments`` are the pieces whose concatenation is ``formatted``; ``loss`` is
    true for the texts of assistant turns and nothing else. An empty table gives no rows.

    The collected turns of one conversation are bounded by its own output row.
    """
    turns = df.select(
        df[conv].alias("conv_id"),
        F.struct(df[turn].alias("turn"),
                 F.coalesce(df[role].cast("string"), F.lit("")).alias("role"),
                 F.coalesce(df[text].cast("string"), F.lit("")).alias("text")).alias("t"))
    turns = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))

    # Where a run of one role starts; its turns are the slice up to the next start.
    roles = turns.select("conv_id", "turns", F.transform("turns", lambda t: t["role"]).alias("roles"))
    changes = F.zip_with(
        "roles", F.concat(F.array(F.lit(None).cast("string")), F.slice("roles", 1, F.size("roles") - 1)),
        lambda own, before: ~own.eqNullSafe(before))
    starts = roles.select("conv_id", "turns", F.filter(
        F.transform(changes, lambda new, i: F.when(new, i)), lambda i: i.isNotNull()).alias("starts"))
    blocks = starts.select("conv_id", F.zip_with(
        "starts", F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size("turns"))),
        lambda start, stop: F.struct(
            F.element_at("turns", start + 1)["role"].alias("role"),
            F.transform(F.slice("turns", start + 1, stop - start), lambda t: t["text"]).alias("texts")),
    ).alias("blocks"))

    def pieces(block: Column) -> Column:
        spoken = F.transform(block["texts"], lambda x, i: F.array(
            _segment(F.when(i > 0, F.lit(TURN)).otherwise(_opening(block["role"]))),
            _segment(escape(x), block["role"] == "assistant")))
        return F.concat(F.flatten(spoken), F.array(_segment(_closing(block["role"]))))

    segments = blocks.select("conv_id", F.flatten(F.transform("blocks", pieces)).cast(SEGMENTS)
                             .alias("segments"))
    return segments.select(
        "conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        "segments")


def read_chats(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""
    blocks = F.filter(F.split(formatted, r"(?=\[INST\]|<s>|\[ROLE\])"), lambda b: F.length(b) > 0)

    def turns(block: Column) -> Column:
        name = unescape(F.regexp_extract(block, r"^\[ROLE\]([\s\S]*?)\[/ROLE\]", 1))
        role = (F.when(block.startswith(USER[0]), F.lit("user"))
                .when(block.startswith(ASSISTANT[0]), F.lit("assistant")).otherwise(name))
        body = F.regexp_replace(
            block, r"^(?:\[INST\]|<s>|\[ROLE\][\s\S]*?\[/ROLE\])|(?:\[/INST\]|</s>)\z", "")
        return F.transform(F.split(body, r"\[TURN\]"), lambda x: F.struct(
            role.alias("role"), unescape(x).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: unescape(s["text"])), "")
