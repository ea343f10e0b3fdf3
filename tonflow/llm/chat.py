"""Chat formatting with Spark expressions only.

Turns of a conversation are collected and sorted; adjacent turns of one role share a block::

    <|im_start|>role
    text<|im_sep|>text<|im_end|>

``<|im_sep|>`` keeps the border between merged turns, so that every turn can be read back.
Inside texts a backslash becomes two and ``<|`` becomes ``<\\|``, so no text can hold a
control string; roles are URL-encoded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, BETWEEN = "<|im_start|>", "<|im_end|>\n", "<|im_sep|>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _split(text: Column, marker: str) -> Column:
    return F.split(text, rf"\Q{marker}\E", -1)


def format_chats(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    learn: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per conversation: ``segments`` and ``formatted``.

    ``segments`` is an array of (text, loss): the pieces of the formatted text in order, with
    ``loss`` true on texts of the roles to learn and false on everything around them.
    ``formatted`` is the pieces joined.  A null text or role counts as empty; turns that
    tie are ordered by role and text; a null turn comes first; rows with a null
    conversation form one conversation.  Other columns are left out.  A conversation becomes
    one string, so its turns meet in one row.
    """
    rows = turns.select(
        F.col(conversation).alias("__conv"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias("__turn"),
    )
    sorted_turns = rows.groupBy("__conv").agg(F.array_sort(F.collect_list("__turn")).alias("__turns"))

    def segment(x: Column, i: Column) -> Column:
        before = F.get(F.col("__turns"), i - 1)["role"]
        opening = F.concat(F.lit(START), F.url_encode(x["role"]), F.lit("\n"))
        lead = (
            F.when(i == 0, opening)
            .when(before == x["role"], F.lit(BETWEEN))
            .otherwise(F.concat(F.lit(END), opening))
        )
        return F.array(
            F.struct(lead.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(x["text"]).alias("text"), x["role"].isin(*learn).alias("loss")),
        )

    last = F.array(F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))
    segments = F.concat(F.flatten(F.transform("__turns", segment)), last)
    return sorted_turns.select(F.col("__conv").alias(conversation), segments.alias("segments")).withColumn(
        "formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")
    )


def read_back(formatted: Column) -> Column:
    """Turns of a formatted text as an array of (role, text), merged turns apart again."""
    blocks = _split(formatted, END)

    def turns_of(block: Column) -> Column:
        head = F.length(F.lit(START))
        line = F.instr(block, "\n")
        role = F.url_decode(F.substring(block, head + 1, line - head - 1))
        texts = _split(F.substring(block, line + 1, F.length(block)), BETWEEN)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    whole = F.slice(blocks, F.lit(1), F.size(blocks) - 1)  # behind the last end mark is nothing
    return F.flatten(F.transform(whole, turns_of))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, as it was before escaping."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: unescape(s["text"])), "")
