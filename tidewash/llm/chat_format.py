"""Operator 13, chat formatting: typed content parts into one string a conversation (DataFrame only).

A turn's content is an array of parts (``PART``).  A visitor (``PartVisitor``) has one
method a part type and flattens them in order: text stays, escaped; an image, audio or
document part becomes a placeholder ``<|image 2.0|>`` that names its turn and its place in
the turn, and an attachment record with its reference and the tokens that the placeholder
expands to.  A turn reads ``<|start|>role<|body|>parts<|end|>`` and a line feed.

Escaping: a backslash becomes ``\\s`` and ``<`` becomes ``\\l``, so no text holds the
beginning of a control string, also not where two parts meet; ``unescape`` gives the text
back.  The loss mask is a list of spans (start, length in code points, counted from the
start of their turn), one for each text part of a trained role; placeholders and control
strings are never under it.  ``read_turns`` and ``read_loss`` read the formatted string.

Only one shuffle: turns are numbered and given their offsets by windows over the
conversation, which spill, and gathered on the same partitioning.  A conversation comes
out as one cell, so it must fit in one (2 GB); ``format_turns`` gives one row a turn and
has no such bound.

Defined cases: turns go by (turn, role, parts), nulls first, repeated rows are turns of
their own; a null role or text is empty; a null or empty array of parts gives a turn
without text; a part without a type is text, one of an unknown type an attachment of 0
tokens; measures that are null or not positive count as 0; a null id is a conversation
like any other; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART = "struct<type:string,text:string,ref:string,width:int,height:int,seconds:double,pages:int>"
START, BODY, END = "<|start|>", "<|body|>", "<|end|>\n"
ESCAPES = [("\\", "\\s"), ("<", "\\l")]  # in this order; back in the other


def escape(c: Column) -> Column:
    for plain, mark in ESCAPES:
        c = F.replace(c, F.lit(plain), F.lit(mark))
    return c


def unescape(c: Column) -> Column:
    for plain, mark in reversed(ESCAPES):
        c = F.replace(c, F.lit(mark), F.lit(plain))
    return c


class PartVisitor:
    """One method a part type.  Each takes a part and gives the kind of its placeholder
    (null: none, the text itself is shown) and the tokens that it expands to.

    ``patch``: pixels of an image patch's side, one token each; ``per_second`` and
    ``per_page``: tokens of a second of audio and of a page.  Text counts its words;
    give a subclass with another ``text`` for a tokenizer's own count."""

    def __init__(self, patch: int = 28, per_second: float = 25.0, per_page: int = 1024) -> None:
        self.patch, self.per_second, self.per_page = patch, per_second, per_page

    def text(self, p: Column) -> tuple[Column, Column]:
        return F.lit(None).cast("string"), F.regexp_count(F.coalesce(p["text"], F.lit("")), F.lit("[^\\x20\\x09-\\x0D]+"))

    def image(self, p: Column) -> tuple[Column, Column]:
        side = lambda c: F.ceil(F.greatest(F.coalesce(c, F.lit(0)), F.lit(0)) / F.lit(self.patch))
        return F.lit("image"), side(p["width"]) * side(p["height"])

    def audio(self, p: Column) -> tuple[Column, Column]:
        return F.lit("audio"), F.ceil(F.greatest(F.coalesce(p["seconds"], F.lit(0.0)), F.lit(0.0)) * F.lit(self.per_second))

    def document(self, p: Column) -> tuple[Column, Column]:
        return F.lit("document"), F.greatest(F.coalesce(p["pages"], F.lit(0)), F.lit(0)) * F.lit(self.per_page)

    def other(self, p: Column) -> tuple[Column, Column]:
        return F.lit("file"), F.lit(0)

    def visit(self, p: Column) -> Column:
        """struct(kind, shown, chars, type, ref, tokens) of a part."""
        kind, tokens = self.other(p)
        for name in ("document", "audio", "image", "text"):
            mine = p["type"].isNull() | (p["type"] == name) if name == "text" else p["type"] == name
            k, n = getattr(self, name)(p)
            kind, tokens = F.when(mine, k).otherwise(kind), F.when(mine, n.cast("long")).otherwise(tokens)
        shown = F.when(kind.isNull(), escape(F.coalesce(p["text"], F.lit(""))))
        return F.struct(kind.alias("kind"), shown.alias("shown"), p["type"].alias("type"), p["ref"].alias("ref"),
                        tokens.cast("long").alias("tokens"))


def text_part(text: Column) -> Column:
    """The parts of a turn that is plain text."""
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"),
                            *[F.lit(None).cast(t).alias(n) for n, t in
                              [("ref", "string"), ("width", "int"), ("height", "int"),
                               ("seconds", "double"), ("pages", "int")]]))


def format_turns(rows: DataFrame, id_col: str, turn_col: str, role_col: str, parts_col: str,
                 trained: tuple[str, ...] = ("assistant",), visitor: PartVisitor | None = None) -> DataFrame:
    """(id, nth, turn, role, formatted, start, loss, attachments, tokens): one row a turn.

    ``start`` is the turn's offset in the conversation's string."""
    visitor = visitor or PartVisitor()
    visited = rows.select(
        F.col(id_col).alias("id"), F.col(turn_col).alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.transform(parts_col, visitor.visit), F.array().cast(
            "array<struct<kind:string,shown:string,type:string,ref:string,tokens:bigint>>")).alias("parts"))
    in_turns = Window.partitionBy("id").orderBy("turn", "role", "parts")
    nth = visited.withColumn("nth", F.row_number().over(in_turns) - F.lit(1))
    place = lambda j: F.concat(F.col("nth").cast("string"), F.lit("."), j.cast("string"))
    shown = nth.withColumn("pieces", F.transform("parts", lambda p, j: F.when(p["kind"].isNull(), p["shown"]).otherwise(
        F.concat(F.lit("<|"), p["kind"], F.lit(" "), place(j), F.lit("|>")))))
    head = F.concat(F.lit(START), escape(F.col("role")), F.lit(BODY))
    shown = shown.select(
        "id", "turn", "role", "nth", "parts", F.char_length(head).alias("head"),
        F.concat(head, F.array_join("pieces", ""), F.lit(END)).alias("formatted"),
        F.transform("pieces", lambda x: F.char_length(x)).alias("lengths"))
    before = lambda j: F.aggregate(F.slice("lengths", F.lit(1), j), F.lit(0), lambda a, b: a + b)
    spans = F.transform("parts", lambda p, j: F.when(p["kind"].isNull(), F.struct(
        (F.col("head") + before(j)).alias("start"), F.get("lengths", j).alias("length"))))
    files = F.transform("parts", lambda p, j: F.when(p["kind"].isNotNull(), F.struct(
        F.col("nth").alias("turn"), j.alias("part"), p["type"].alias("type"), p["ref"].alias("ref"), p["tokens"].alias("tokens"))))
    so_far = Window.partitionBy("id").orderBy("nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    present = lambda c: F.filter(c, lambda x: x.isNotNull())
    return shown.select(
        "id", "nth", "turn", "role", "formatted",
        (F.sum(F.char_length("formatted").cast("long")).over(so_far) - F.char_length("formatted")).alias("start"),
        F.when(F.col("role").isin(*trained), present(spans)).otherwise(
            F.array().cast("array<struct<start:int,length:int>>")).alias("loss"),
        present(files).alias("attachments"),
        F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["tokens"]).alias("tokens"))


def format_conversations(rows: DataFrame, id_col: str, turn_col: str, role_col: str, parts_col: str,
                         trained: tuple[str, ...] = ("assistant",), visitor: PartVisitor | None = None) -> DataFrame:
    """(id, n_turns, formatted, turns, attachments, n_tokens): one row a conversation.

    ``turns`` holds each turn's ``start`` in ``formatted`` and its ``loss`` spans."""
    turns = format_turns(rows, id_col, turn_col, role_col, parts_col, trained, visitor)
    gathered = turns.groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("nth", "formatted", "start", "loss", "attachments"))).alias("all"),
        F.sum("tokens").alias("n_tokens"))
    return gathered.select(
        "id", F.size("all").cast("long").alias("n_turns"),
        F.array_join(F.transform("all", lambda t: t["formatted"]), "").alias("formatted"),
        F.transform("all", lambda t: F.struct(t["start"], t["loss"])).alias("turns"),
        F.flatten(F.transform("all", lambda t: t["attachments"])).alias("attachments"), "n_tokens")


def _turn_strings(formatted: Column) -> Column:
    pieces = F.split(formatted, "<\\|end\\|>\n", -1)
    return F.slice(pieces, F.lit(1), F.size(pieces) - F.lit(1))  # after the last end stands nothing


def _after_mark(c: Column) -> Column:
    return F.substr(c, F.instr(c, "|>") + F.lit(2))


def read_turns(formatted: Column) -> Column:
    """array(struct(role, text)) from the string; placeholders leave nothing in the text."""
    def turn(piece: Column) -> Column:
        marks = F.split(piece, "<\\|", -1)  # '', start|>role, body|>text, image 0.1|>text ...
        return F.struct(
            unescape(_after_mark(F.get(marks, F.lit(1)))).alias("role"),
            unescape(F.array_join(F.transform(F.slice(marks, F.lit(3), F.greatest(F.size(marks) - F.lit(2), F.lit(0))), _after_mark), "")).alias("text"))

    return F.transform(_turn_strings(formatted), turn)


def read_loss(formatted: Column, turns: Column) -> Column:
    """All text under the loss mask, unescaped, read at the recorded spans."""
    return F.array_join(F.zip_with(
        _turn_strings(formatted), turns, lambda piece, t: F.array_join(F.transform(
            t["loss"], lambda s: unescape(F.substr(piece, s["start"] + F.lit(1), s["length"]))), "")), "")
