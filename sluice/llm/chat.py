"""Chat formatting with typed content parts, in built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Template. Fixed values.
TURN, BODY, END = "<|turn|>", "<|body|>", "<|end|>"
PLACEHOLDER = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>"}
#: What may not stand in a text as it is: the marks above and those of other common templates.
_HEAD, _TAIL = r"([<\[])", r"(\|[a-z_]+\|>|/?s>|/?INST\]|</?SYS>>)"
#: Content of a message part. ``size`` has width and height of an image in pixels, the seconds
#: of an audio part, or the pages of a document.
PART = "struct<type:string,text:string,ref:string,size:array<double>>"


def escape(text: Column) -> Column:
    """Put one tilde more behind the first character of every control string.

    A control string that already has tildes there gets another, so that ``unescape`` takes
    back exactly what was added and no text can forge a mark.
    """
    return F.regexp_replace(text, _HEAD + "(~*)" + _TAIL, "$1~$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _HEAD + "~(~*)" + _TAIL, "$1$2$3")


def text_parts(text: Column) -> Column:
    """Content with one text part; a null text is an empty one."""
    part = F.struct(
        F.lit("text").alias("type"), F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("string").alias("ref"), F.lit(None).cast("array<double>").alias("size"))
    return F.array(part).cast(f"array<{PART}>")


def _expanded(part: Column, patch: int, audio_rate: float, page_tokens: int) -> Column:
    """Tokens that an attachment takes in place of its mark, 1 at least; a text part has 0."""
    def at(i: int) -> Column:
        return F.coalesce(F.get(part["size"], F.lit(i)), F.lit(0.0))

    patches = F.ceil(at(0) / patch) * F.ceil(at(1) / patch)
    size = F.when(part["type"] == "image", patches).when(
        part["type"] == "audio", F.ceil(at(0) * audio_rate)).when(
        part["type"] == "document", F.ceil(at(0)) * page_tokens)
    known = F.coalesce(part["type"], F.lit("text")).isin(*PLACEHOLDER)
    return F.when(known, F.greatest(F.lit(1), F.coalesce(size, F.lit(1)))).otherwise(0).cast("long")


def visit(parts: Column, patch: int = 14, audio_rate: float = 25.0, page_tokens: int = 256) -> Column:
    """Flatten typed parts: struct(body, attachments) in the order of the parts.

    Neighbouring texts are joined without a gap and then escaped, so that no control string can
    come about where two of them meet; image, audio and document parts leave their mark, and an attachment (type, ref, tokens) is recorded for each. A part of another or no type
    counts as text.
    """
    def kind(p: Column) -> Column:
        return F.coalesce(p["type"], F.lit("text"))

    def take(acc: Column, p: Column) -> Column:
        mark = F.lit(None)
        for name, placeholder in PLACEHOLDER.items():
            mark = F.when(kind(p) == name, F.lit(placeholder)).otherwise(mark)
        return F.when(
            kind(p).isin(*PLACEHOLDER),
            F.struct(F.concat(acc["done"], escape(acc["open"]), mark).alias("done"), F.lit("").alias("open")),
        ).otherwise(F.struct(
            acc["done"].alias("done"),
            F.concat(acc["open"], F.coalesce(p["text"], F.lit(""))).alias("open")))

    parts = F.coalesce(parts, F.array().cast(f"array<{PART}>"))
    attached = F.filter(parts, lambda p: kind(p).isin(*PLACEHOLDER))
    empty = F.struct(F.lit("").alias("done"), F.lit("").alias("open"))
    return F.struct(
        F.aggregate(parts, empty, take, lambda acc: F.concat(acc["done"], escape(acc["open"]))).alias("body"),
        F.transform(attached, lambda p: F.struct(
            p["type"].alias("type"), p["ref"].alias("ref"),
            _expanded(p, patch, audio_rate, page_tokens).alias("tokens"))).alias("attachments"))


def format_chats(messages: DataFrame, conversation: str = "conv_id", turn: str = "turn",
                 role: str = "role", parts: str = "parts", learn: str = "assistant",
                 **sizes: float) -> DataFrame:
    """One row per conversation: formatted text, attachments in order, and the loss mask.

    Columns: the conversation, ``formatted``, ``attachments`` (array of type, ref, tokens),
    ``expanded_tokens`` (all attachments' tokens) and ``loss_spans`` (array of start, length in
    code points of ``formatted``: the bodies of the learnt role). A conversation is one training
    example and becomes one row, so that its own messages, and no other's, meet in a task.

    Cases: null parts and null texts are empty; a null role is written as an empty one; turns
    come in order of ``turn``, null first, ties by role, then by content; repeated rows are
    repeated turns; rows without conversation are one conversation with a null id; an empty
    table gives no rows; other columns are not read.
    """
    told = messages.select(
        F.col(conversation), F.col(turn).alias("_turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("_role"),
        visit(F.col(parts), **sizes).alias("_said"))
    grouped = told.groupBy(conversation).agg(F.sort_array(F.collect_list(
        F.struct("_turn", "_role", "_said"))).alias("_turns"))
    opened = F.transform("_turns", lambda t: F.struct(
        F.concat(F.lit(TURN), escape(t["_role"]), F.lit(BODY)).alias("head"),
        t["_said"]["body"].alias("body"), (t["_role"] == learn).alias("learnt"),
        t["_said"]["attachments"].alias("attachments")))
    laid = grouped.select(conversation, opened.alias("_t"))
    # Places of the bodies: each turn adds its head, its body and the closing mark.
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(acc: Column, t: Column) -> Column:
        body_at = acc["at"] + F.length(t["head"])
        span = F.array(F.struct(body_at.alias("start"), F.length(t["body"]).alias("length")))
        return F.struct(
            (body_at + F.length(t["body"]) + len(END)).alias("at"),
            F.when(t["learnt"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    attachments = F.flatten(F.transform("_t", lambda t: t["attachments"]))
    return laid.select(
        conversation,
        F.array_join(F.transform("_t", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("formatted"),
        attachments.alias("attachments"),
        F.aggregate("_t", start, step, lambda acc: acc["spans"]).alias("loss_spans"),
    ).withColumn("expanded_tokens", F.aggregate(
        "attachments", F.lit(0).cast("long"), lambda n, a: n + a["tokens"]))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation as array of (role, body), still escaped."""
    pieces = F.slice(F.split(formatted, r"<\|turn\|>"), 2, 1 << 30)
    return F.transform(pieces, lambda p: F.struct(
        F.substring_index(p, BODY, 1).alias("role"),
        F.split(F.split(p, r"<\|body\|>")[1], r"<\|end\|>")[0].alias("body")))


def masked(formatted: Column, spans: Column) -> Column:
    """All text under the mask, unescaped, nothing between the spans."""
    return F.array_join(F.transform(spans, lambda s: unescape(
        F.substring(formatted, s["start"] + 1, s["length"]))), "")
