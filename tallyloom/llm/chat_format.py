"""Chat formatting: turns of typed content parts as one text per conversation.

A visitor goes over the parts of a turn: text is escaped, and images, audio and documents become
placeholders in their place, with a record of what they refer to and of the tokens they stand for.
All of it is column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: The template's own marks, and other control strings that texts must not smuggle in.
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
CONTROL = ("<|", "</s>", "<s>", "[/INST]", "[INST]")
ATTACHMENTS = ("image", "audio", "document")
PARTS = "array<struct<type:string,text:string,ref:string,n_tokens:bigint>>"


def escaped(text: Column) -> Column:
    """Backslashes are doubled, and one is put after the first character of a control string."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        text = F.replace(text, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return text


def unescaped(text: Column) -> Column:
    """The inverse of ``escaped``: a backslash only ever stands before what it protects."""
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def text_parts(text: Column) -> Column:
    """One text part; null counts as empty."""
    part = F.struct(
        F.lit("text").alias("type"),
        F.coalesce(text.cast("string"), F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"),
        F.lit(None).cast("long").alias("n_tokens"),
    )
    return F.array(part).cast(PARTS)


def placeholder(kind: Column) -> Column:
    return F.concat(F.lit("<|"), kind, F.lit("|>"))


def _is_text(part: Column) -> Column:
    return F.coalesce(part["type"], F.lit("text")) == "text"


def _visited(rows: DataFrame) -> DataFrame:
    """Add ``_cuts``, the numbers of the parts that are no texts, and ``_pieces``, what the parts become:
    a run of texts and a placeholder in turns, beginning and ending with a run, which may be empty.

    Neighbouring texts are joined before they are escaped, so no control string forms where they meet.
    """
    texts = F.transform("_parts", lambda p: F.when(_is_text(p), F.coalesce(p["text"], F.lit(""))).otherwise(""))
    cuts = F.filter(F.transform("_parts", lambda p, i: F.when(~_is_text(p), i)), F.isnotnull)
    rows = rows.withColumns({"_texts": texts, "_cuts": cuts})
    behind = F.concat(F.array(F.lit(-1)), "_cuts")
    rows = rows.withColumns({"_behind": behind, "_ends": F.concat("_cuts", F.array(F.size("_parts")))})

    def pieces(end: Column, run: Column) -> Column:
        start = F.get("_behind", run)
        text = escaped(F.concat_ws("", F.slice("_texts", start + 2, end - start - 1)))
        kind = F.get("_parts", end)["type"]
        shown = placeholder(F.when(kind.isin(*ATTACHMENTS), kind).otherwise(F.lit("unknown")))
        return F.when(end < F.size("_parts"), F.array(text, shown)).otherwise(F.array(text))

    return rows.withColumn("_pieces", F.flatten(F.transform("_ends", pieces))).drop("_texts", "_behind", "_ends")


def format_chats(
    turns: DataFrame,
    parts: Column,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    learn_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """Per conversation: its id, ``formatted``, ``turns``, ``attachments``, ``n_turns``, ``n_expanded``.

    ``parts`` is an array as in ``PARTS``. Rows are ordered by turn, then by role and content;
    repeated rows are turns of their own. ``turns`` has for each, in code points of ``formatted``:
    ``start``, and ``a`` to ``b`` of its body, with ``learn`` true under the loss mask. An
    attachment has its ``turn`` number, ``part`` number, ``type``, ``ref``, where its placeholder
    begins, and ``n_tokens``; ``n_expanded`` is the sum of these.

    A null role or text is empty; a null array of parts has none; a part of type null is text and
    one of an unknown type gets the placeholder "unknown"; a null or negative token count is 0.
    Null ids form a conversation of their own; an empty table gives none; other columns are not
    looked at. A conversation is one value: its whole text has to fit into a row (2 GB).
    """
    rows = turns.select(
        turns[conv_col].alias("_conv"),
        turns[turn_col].alias("_turn"),
        F.coalesce(turns[role_col].cast("string"), F.lit("")).alias("_role"),
        F.coalesce(parts.cast(PARTS), F.array().cast(PARTS)).alias("_parts"),
    )
    pieces = _visited(rows)
    head = F.concat(F.lit(TURN), escaped(F.col("_role")), F.lit(BODY))
    body = F.concat_ws("", "_pieces")
    pieces = pieces.withColumns({"_head": F.length(head), "_body": F.length(body), "_text": F.concat(head, body, F.lit(END))})
    order = W.partitionBy("_conv").orderBy("_turn", "_role", "_text", F.to_json("_parts"))
    before = order.rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.withColumns(
        {
            "_at": F.row_number().over(order),
            "_start": F.coalesce(F.sum(F.length("_text")).over(before), F.lit(0)),
        }
    )
    body_start = F.col("_start") + F.col("_head")
    lengths = F.transform("_pieces", lambda p: F.length(p))
    # The placeholder of the n-th cut stands behind n + 1 runs and n placeholders.
    marks = F.transform(
        "_cuts",
        lambda i, n: F.struct(
            F.col("_at").alias("turn"),
            (i + 1).alias("part"),
            F.get("_parts", i)["type"].alias("type"),
            F.get("_parts", i)["ref"].alias("ref"),
            (body_start + F.aggregate(F.slice(lengths, F.lit(1), 2 * n + 1), F.lit(0), lambda n, x: n + x)).alias("start"),
            F.greatest(F.coalesce(F.get("_parts", i)["n_tokens"], F.lit(0)), F.lit(0)).alias("n_tokens"),
        ),
    )
    pieces = pieces.withColumn("_marks", marks)
    turn = F.struct(
        F.col("_at").alias("turn"),
        F.col("_start").alias("start"),
        body_start.alias("a"),
        (body_start + F.col("_body")).alias("b"),
        F.col("_role").isin(*learn_roles).alias("learn"),
    )
    chat = F.array_sort(F.collect_list(F.struct("_at", "_text", turn.alias("turn"), "_marks")))
    chats = pieces.groupBy("_conv").agg(chat.alias("chat"))
    attachments = F.flatten(F.col("chat._marks"))
    return chats.select(
        F.col("_conv").alias(conv_col),
        F.concat_ws("", F.col("chat._text")).alias("formatted"),
        F.col("chat.turn").alias("turns"),
        attachments.alias("attachments"),
        F.size("chat").cast("long").alias("n_turns"),
        F.aggregate(attachments, F.lit(0).cast("long"), lambda n, m: n + m["n_tokens"]).alias("n_expanded"),
    )


def _segments(formatted: Column) -> Column:
    """The turns of a formatted text without their mark."""
    return F.slice(F.split(formatted, r"<\|turn\|>"), 2, 2**31 - 2)


def read_turns(formatted: Column) -> Column:
    """Back from the text: ``array<struct<role, parts array<struct<type, text>>>>``.

    Text parts that stood side by side come back as one; a turn without parts has none.
    """

    def part(piece: Column) -> Column:
        kind = F.regexp_extract(piece, r"^<\|(\w+)\|>$", 1)
        is_text = kind == ""
        return F.struct(
            F.when(is_text, F.lit("text")).otherwise(kind).alias("type"),
            F.when(is_text, unescaped(piece)).alias("text"),
        )

    def turn(segment: Column) -> Column:
        fields = F.split(segment, r"<\|body\|>|<\|end\|>")
        pieces = F.split(fields[1], r"(?=<\|)|(?<=\|>)")
        # "|>" may end a piece of plain text as well: only what opens with "<|" is a placeholder.
        joined = F.filter(pieces, lambda p: p != "")
        return F.struct(unescaped(fields[0]).alias("role"), F.transform(joined, part).alias("parts"))

    return F.transform(_segments(formatted), turn)


def turn_texts(formatted: Column) -> Column:
    """Back from the text: ``array<struct<role, text>>``, the texts of each turn's text parts."""
    return F.transform(
        read_turns(formatted),
        lambda t: F.struct(t["role"].alias("role"), F.concat_ws("", F.transform(t["parts"], lambda p: p["text"])).alias("text")),
    )


def learned_text(formatted: Column, turns: Column) -> Column:
    """All text under the loss mask, unescaped. Each turn is cut from its own segment."""
    cut = F.zip_with(
        _segments(formatted),
        turns,
        lambda s, t: F.when(
            t["learn"],
            unescaped(s.substr((t["a"] - t["start"] - len(TURN) + 1).cast("int"), (t["b"] - t["a"]).cast("int"))),
        ),
    )
    return F.concat_ws("", cut)
