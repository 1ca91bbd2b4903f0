r"""Chat formatting with a grammar that reads back to the source.

A conversation is a run of turns, each ``<|im_start|>`` role ``\n`` text ``<|im_end|>\n``. Within role and
text no ``<|`` may stand: a turn is rendered as it is and parsed again, and where the parse differs from the
source its content is escaped (one backslash more between ``<`` and ``|``, a line break in a role as
``<|nl|>``) and parsed once more. The parser takes one backslash away again, so a turn whose text already
looks escaped differs too and is escaped as well.

Everything is a column expression. A conversation is one row of the result, so its turns meet in one row.

Null text or role: empty. Turns go by turn, then role, then text; a null turn first, repeated rows stay. A null
``conv_id`` is a conversation of its own. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
BREAK = "<|nl|>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit(BREAK))


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parse_turn(body: Column) -> Column:
    """A turn from what follows its start mark: role up to the line break, text up to the next ``<|``."""
    role = F.substring_index(body, "\n", 1)
    rest = F.substr(body, F.length(role) + F.lit(2))
    text = F.substring_index(rest, "<|", 1)
    return F.struct(
        unescape(F.replace(role, F.lit(BREAK), F.lit("\n"))).alias("role"),
        unescape(text).alias("text"),
        (F.substr(rest, F.length(text) + F.lit(1)) == F.lit(END + "\n")).alias("closed"),
    )


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of role, text, closed."""
    parts = F.split(formatted, r"<\|im_start\|>", -1)
    return F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), parse_turn)


def _turn_parses(segment: Column, role: Column, text: Column) -> Column:
    turns = parse(segment)
    one = F.get(turns, F.lit(0))
    return (F.size(turns) == 1) & (one["role"] == role) & (one["text"] == text) & one["closed"]


def format_conversations(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss (the spans of assistant texts), round_trip.

    ``loss`` holds ``(turn, start, length)``: the turn's number from 0 and the span of its escaped text in
    ``formatted``, in code points from 0. ``round_trip``: the parsed turns equal the source.
    """
    source = rows.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    role, text = F.col("role"), F.col("text")
    plain, escaped = render(role, text), render(escape_role(role), escape(text))
    kept = _turn_parses(plain, role, text)
    segments = source.withColumn("plain", kept).select(
        "*",
        F.when(F.col("plain"), plain).otherwise(escaped).alias("segment"),
        F.length(F.when(F.col("plain"), role).otherwise(escape_role(role))).alias("role_chars"),
        F.length(F.when(F.col("plain"), text).otherwise(escape(text))).alias("text_chars"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = segments.select(
        "conv_id",
        F.row_number().over(order).alias("place"),
        "role",
        "text",
        "segment",
        "text_chars",
        (
            F.coalesce(F.sum(F.length("segment").cast("long")).over(before), F.lit(0))
            + F.lit(len(START) + 1)
            + F.col("role_chars")
        ).alias("start"),
    )
    gathered = placed.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "role", "text", "segment", "start", "text_chars"))).alias("turns")
    )
    turns = F.col("turns")
    whole = gathered.select(
        "conv_id",
        F.array_join(F.transform(turns, lambda t: t["segment"]), "").alias("formatted"),
        F.transform(
            F.filter(turns, lambda t: t["role"] == "assistant"),
            lambda t: F.struct(
                (t["place"] - 1).cast("long").alias("turn"),
                t["start"].alias("start"),
                t["text_chars"].cast("long").alias("length"),
            ),
        ).alias("loss"),
        F.transform(
            turns,
            lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"), F.lit(True).alias("closed")),
        ).alias("wanted"),
    )
    return whole.select("conv_id", "formatted", "loss", (parse(F.col("formatted")) == F.col("wanted")).alias("round_trip"))


def digests(formatted: DataFrame) -> DataFrame:
    """The columns by which a formatted conversation is compared, read back from the formatted text."""
    read = formatted.select(
        "conv_id", "loss", F.length("formatted").cast("long").alias("formatted_chars"), parse(F.col("formatted")).alias("turns")
    )
    turns = F.col("turns")
    under_loss = F.array_join(
        F.transform(F.col("loss"), lambda s: F.get(turns, s["turn"].cast("int"))["text"]), ""
    )
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(
            F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256
        ).alias("turns_sha256"),
        under_loss.alias("under_loss"),
        "formatted_chars",
    ).select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.length("under_loss").cast("long").alias("loss_chars"),
        F.sha2("under_loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
