"""Chat formatting: typed content parts become text with placeholders, turns are marked, texts are escaped.

A conversation's text is the concatenation of its turns' pieces in order. Pieces are made row by row, so a
conversation of any length needs no grouping to be formatted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PART = "type string, text string, ref string, width int, height int, seconds double, pages int"
OPEN, CLOSE = "<turn ", "</turn>\n"


def escape(text: Column) -> Column:
    """Makes texts free of ``<``, so that no control string of the template can stand in them; ``unescape`` undoes it."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<"), F.lit("\\l"))


def unescape(text: str) -> str:
    """The text that was escaped. Escaped backslashes are set apart first, so none is read twice."""
    return "\\".join(part.replace("\\l", "<").replace("\\g", ">") for part in text.split("\\\\"))


def escape_role(role: Column) -> Column:
    """A role without ``<`` and ``>`` too, since the first ``>`` ends a turn's head."""
    return F.replace(escape(role), F.lit(">"), F.lit("\\g"))


class PartVisitor:
    """Turns one part into struct<body, kind, ref, tokens>. Subclasses change how a type is shown or counted.

    Token counts of attachments: an image costs one token for each started ``patch`` x ``patch`` square, audio
    ``per_second`` for each second, a document ``per_page`` for each page; one token at least, also where the
    measures are null. Texts and parts of unknown type count none here; unknown types are kept as escaped text.
    """

    attachments = ("image", "audio", "document")

    def __init__(self, patch: int = 28, per_second: int = 25, per_page: int = 512):
        self.patch, self.per_second, self.per_page = patch, per_second, per_page

    def tokens(self, part: Column) -> Column:
        image = F.ceil(part["width"] / self.patch) * F.ceil(part["height"] / self.patch)
        audio, document = F.ceil(part["seconds"] * self.per_second), part["pages"] * self.per_page
        count = F.when(part["type"] == "image", image).when(part["type"] == "audio", audio).otherwise(document)
        return F.greatest(F.coalesce(count.cast("bigint"), F.lit(1)), F.lit(1))

    def visit(self, part: Column) -> Column:
        attached = F.coalesce(part["type"].isin(*self.attachments), F.lit(False))
        return F.struct(
            F.when(~attached, escape(F.coalesce(part["text"], F.lit("")))).alias("body"),
            F.when(attached, part["type"]).alias("kind"),
            F.when(attached, F.coalesce(part["ref"], F.lit(""))).alias("ref"),
            F.when(attached, self.tokens(part)).otherwise(F.lit(0)).cast("bigint").alias("tokens"),
        )


def text_part(text: str = "text") -> Column:
    """A plain text column as a list of one text part; null is an empty text."""
    values = {"type": F.lit("text"), "text": F.coalesce(F.col(text), F.lit(""))}
    fields = [f.strip().split(" ") for f in PART.split(",")]
    return F.array(F.struct(*[values.get(n, F.lit(None)).cast(t).alias(n) for n, t in fields]))


def format_turns(
    turns: DataFrame, parts: Column | None = None, role: str = "role", visitor: PartVisitor | None = None
) -> DataFrame:
    """``turns`` with a struct column ``_chat``: piece, loss_start, loss_chars, attachments, tokens.

    A piece is ``<turn ROLE>``, a line break, the turn's parts and ``</turn>`` with a line break. Attachments become
    ``<KIND N>``, numbered within the turn, and are listed in order with reference and tokens. The loss mask covers
    the parts of assistant turns: ``loss_chars`` code points from ``loss_start`` (from 0) of the piece, none in other
    turns. A null role is an empty one; null or no parts make an empty turn. All rows and columns stay; a column
    ``_chat`` or one that starts with ``__chat`` is refused.
    """
    clash = [c for c in turns.columns if c == "_chat" or c.startswith("__chat")]
    if clash:
        raise ValueError(f"the turns have columns {clash} already")
    visitor = visitor or PartVisitor()
    parts = text_part() if parts is None else parts
    seen = F.transform(F.coalesce(parts, F.array().cast(f"array<struct<{PART.replace(' ', ':').replace(',:', ',')}>>")), visitor.visit)
    attached = F.filter(seen, lambda p: p["kind"].isNotNull())
    listed = F.transform(
        attached, lambda p, i: F.struct((i + 1).alias("number"), p["kind"].alias("kind"), p["ref"].alias("ref"), p["tokens"].alias("tokens"))
    )

    def shown(part: Column, at: Column) -> Column:
        number = F.size(F.filter(F.slice(F.col("__chat_seen"), 1, at + 1), lambda q: q["kind"].isNotNull()))
        return F.coalesce(part["body"], F.format_string("<%s %d>", part["kind"], number))

    name = escape_role(F.coalesce(F.col(role), F.lit("")))
    head = F.concat(F.lit(OPEN), name, F.lit(">\n"))
    learned = F.coalesce(F.col(role), F.lit("")) == "assistant"
    staged = turns.withColumn("__chat_seen", seen).withColumn("__chat_attached", listed)
    staged = staged.withColumn("__chat_body", F.array_join(F.transform("__chat_seen", shown), ""))
    chat = F.struct(
        F.concat(head, F.col("__chat_body"), F.lit(CLOSE)).alias("piece"),
        F.length(head).cast("bigint").alias("loss_start"),
        F.when(learned, F.length("__chat_body")).otherwise(F.lit(0)).cast("bigint").alias("loss_chars"),
        F.col("__chat_attached").alias("attachments"),
        F.aggregate("__chat_attached", F.lit(0).cast("bigint"), lambda n, p: n + p["tokens"]).alias("tokens"),
    )
    return staged.withColumn("_chat", chat).drop("__chat_seen", "__chat_attached", "__chat_body")


def read_piece(piece: str) -> tuple[str, str]:
    """Role and body of a piece, as they stand in it (escaped). Raises ValueError for what is no piece."""
    head, found, body = piece.partition(">\n")
    if not (found and head.startswith(OPEN) and body.endswith(CLOSE)):
        raise ValueError("not a formatted turn")
    return head[len(OPEN) :], body[: -len(CLOSE)]
