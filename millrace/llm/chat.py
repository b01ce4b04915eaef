"""Chat formatting with typed content parts, by DataFrame functions only.

A visitor turns the parts of a turn (text, image, audio, document) into one string: texts are
escaped, other parts become numbered placeholders, and each of them is recorded with its
reference and the number of tokens that it expands to. A turn is ``<turn>role<body>...</turn>``,
and ``<loss>`` instead of ``<body>`` marks a turn that is learned from. In texts and roles ``&``
is written ``&amp;`` and ``<`` is written ``&lt;``, so control strings never occur in them and
``read_back`` gives the exact texts.

Turns are in order of ``turn``, then role, then text, nulls first; repeated rows are turns of
their own. A null text, role or part counts as empty; parts of an unknown kind are placeholders
that expand to their ``units``. Further columns are ignored. A conversation is one row of the
result, so it has to fit in a row, as it has to fit in a context.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSISTANT = "assistant"
# Tokens for each unit: an image tile, a second of audio, a page of a document.
TOKENS = {"image": 576, "audio": 25, "document": 800}
ATTACHED = "array<struct<number: int, kind: string, ref: string, tokens: bigint>>"
PART = "array<struct<kind: string, text: string, ref: string, units: bigint>>"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;"), F.lit("<")), F.lit("&amp;"), F.lit("&"))


def text_parts(text: Column) -> Column:
    """A plain text as parts."""
    return F.array(
        F.struct(
            F.lit("text").alias("kind"),
            text.alias("text"),
            F.lit(None).cast("string").alias("ref"),
            F.lit(None).cast("bigint").alias("units"),
        )
    )


def expanded(part: Column) -> Column:
    units = F.coalesce(part["units"], F.lit(1).cast("bigint"))
    tokens = F.lit(1)
    for kind, each in TOKENS.items():
        tokens = F.when(part["kind"] == kind, F.lit(each)).otherwise(tokens)
    return units * tokens


def is_text(part: Column) -> Column:
    return F.coalesce(part["kind"], F.lit("text")) == "text"


def attachments(parts: Column) -> Column:
    """What the placeholders of a turn stand for, in order."""
    found = F.transform(
        F.filter(parts, lambda p: p.isNotNull() & ~is_text(p)),
        lambda p, k: F.struct(
            k.alias("number"), p["kind"].alias("kind"), p["ref"].alias("ref"), expanded(p).alias("tokens")
        ),
    )
    return F.coalesce(found, F.array().cast(ATTACHED))


def flatten(parts: Column) -> Column:
    """One string for the parts of a turn. A placeholder's number counts within its turn."""

    def visit(part: Column, place: Column) -> Column:
        number = F.size(F.filter(F.slice(parts, F.lit(1), place), lambda p: p.isNotNull() & ~is_text(p)))
        holder = F.concat(
            F.lit("<part "), number.cast("string"), F.lit(" "), escape(part["kind"]), F.lit(">")
        )
        text = escape(F.coalesce(part["text"], F.lit("")))
        return F.coalesce(F.when(is_text(part), text).otherwise(holder), F.lit(""))

    return F.coalesce(F.array_join(F.transform(parts, visit), ""), F.lit(""))


def format_chats(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
    parts: str = "parts",
) -> DataFrame:
    """``formatted``, ``loss_spans`` and ``attachments`` for each conversation.

    Spans are (start, end) in code points of ``formatted``, the end exclusive; they cover the
    escaped text of the turns that are learned from.
    """
    said = F.coalesce(F.col(role), F.lit(""))
    learned = said == ASSISTANT
    head = F.concat(F.lit("<turn>"), escape(said), F.when(learned, F.lit("<loss>")).otherwise(F.lit("<body>")))
    rows = turns.select(
        F.col(conversation).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            said.alias("role"),
            flatten(F.col(parts)).alias("body"),
            head.alias("head"),
            learned.alias("learned"),
            attachments(F.col(parts)).alias("attached"),
        ).alias("t"),
    )
    tail = "</turn>"
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    pieces = F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(tail)))
    return whole.select(
        "conv_id",
        F.array_join(pieces, "").alias("formatted"),
        loss_spans(F.col("turns"), len(tail)).alias("loss_spans"),
        F.flatten(
            F.transform(
                "turns",
                lambda t, k: F.transform(
                    t["attached"], lambda a: F.struct(k.alias("turn"), a["number"], a["kind"], a["ref"], a["tokens"])
                ),
            )
        ).alias("attachments"),
    )


def loss_spans(turns: Column, tail: int) -> Column:
    """Where the learned texts lie. Only learned turns add to the list."""
    start = F.struct(
        F.lit(0).cast("bigint").alias("at"),
        F.array().cast("array<struct<start: bigint, end: bigint>>").alias("spans"),
    )

    def step(state: Column, t: Column) -> Column:
        first = state["at"] + F.length(t["head"])
        last = first + F.length(t["body"])
        span = F.array(F.struct(first.alias("start"), last.alias("end")))
        return F.struct(
            (last + tail).alias("at"),
            F.when(t["learned"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    return F.aggregate(turns, start, step, lambda s: s["spans"])


def read_back(formatted: Column) -> Column:
    """(role, text, learned) of each turn of a formatted conversation. Placeholders stay."""
    raw = F.split(formatted, "</turn>")
    turns = F.slice(raw, F.lit(1), F.size(raw) - 1)

    def parse(one: Column) -> Column:
        inner = F.substr(one, F.lit(len("<turn>") + 1))
        role = F.substring_index(inner, "<", 1)
        rest = F.substr(inner, F.length(role) + 1)
        mark = len("<body>")
        return F.struct(
            unescape(role).alias("role"),
            unescape(F.substr(rest, F.lit(mark + 1))).alias("text"),
            rest.startswith("<loss>").alias("learned"),
        )

    return F.transform(turns, parse)
