"""Chat formatting with a grammar that is checked by a round trip.

    conversation = *turn
    turn         = "### " role ": " text "</turn>"

Roles are URL-encoded, so they hold neither blank nor colon. A conversation is rendered with its texts as
they are, parsed again and compared with its source. The parser takes an opening inside a text for a forged turn
and rejects it, as it ends a turn at the first close. If the turns differ, conflicting content is escaped
and the result parsed and compared again: first only the control strings and the escape sign, then every
sign that a control string is made of. The level that came back identical is stored beside the text.

Level 1 writes ``\\`` as ``\\\\``, ``</turn>`` as ``<\\/turn>`` and ``##`` as ``#\\#``; level 2 puts a
``\\`` before each of ``\\ < / > # :``. Both are undone by dropping one ``\\`` before each kept sign.

``loss_mask`` has the spans, in code points of ``formatted``, of the assistant's texts, as start and length.

Edge cases: a null or empty text is an empty turn; a null role is the empty role. Turns go by number,
nulls first, then by role and text; rows that repeat a turn are turns of their own. Rows without a
``conv_id`` form one conversation. A conversation is one row of the result, so the longest has to fit a
task. An empty table gives an empty one; other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed control strings.
OPEN, SEPARATOR, CLOSE = "### ", ": ", "</turn>"
LEVELS = (0, 1, 2)


def escaped(text: Column, level: int) -> Column:
    if level == 0:
        return text
    if level == 1:
        out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        out = F.replace(out, F.lit(CLOSE), F.lit("<\\/turn>"))
        return F.replace(out, F.lit("##"), F.lit("#\\#"))
    return F.regexp_replace(text, r"([\\</>#:])", r"\\$1")


def unescaped(text: Column, level: int) -> Column:
    return text if level == 0 else F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(turns: Column, level: int) -> Column:
    piece = lambda t: F.concat(F.lit(OPEN), F.url_encode(t["role"]), F.lit(SEPARATOR), escaped(t["text"], level), F.lit(CLOSE))
    return F.array_join(F.transform(turns, piece), "")


def parse(formatted: Column, level: int) -> Column:
    """Turns of a rendered text, roles and texts unescaped. What doesn't follow the grammar becomes a null role,
    a turn that holds the opening of another one included."""
    pieces = F.split(formatted, CLOSE, -1)
    turns = F.slice(pieces, F.lit(1), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        at = F.locate(SEPARATOR, piece)
        good = piece.startswith(OPEN) & (at > len(OPEN)) & (F.locate(OPEN, piece, 2) == 0)
        role = F.when(good, F.url_decode(F.substring(piece, F.lit(len(OPEN) + 1), at - len(OPEN) - 1)))
        text = unescaped(F.substring(piece, at + len(SEPARATOR), F.char_length(piece)), level)
        return F.struct(role.alias("role"), text.alias("text"))

    return F.transform(turns, turn)


def _mask(turns: Column, level: Column) -> Column:
    """Spans of the assistant's texts, from the lengths of what was rendered."""
    text = lambda t: F.when(level == 0, t["text"]).when(level == 1, escaped(t["text"], 1)).otherwise(escaped(t["text"], 2))

    def step(state: Column, t: Column) -> Column:
        begin = state["at"] + len(OPEN) + F.char_length(F.url_encode(t["role"])) + len(SEPARATOR)
        length = F.char_length(text(t))
        span = F.struct(begin.alias("start"), length.alias("length"))
        spans = F.when(t["role"] == "assistant", F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((begin + length + len(CLOSE)).alias("at"), spans.alias("spans"))

    empty = F.array().cast("array<struct<start:int,length:int>>")
    return F.aggregate(turns, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda state: state["spans"])


def format_conversations(conversations: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted``, ``level``, ``loss_mask``, ``identical``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    turn = F.struct(F.col("turn"), role.alias("role"), text.alias("text"))
    grouped = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    same = [parse(render(F.col("turns"), level), level) == F.col("source") for level in LEVELS]
    level = F.when(same[0], 0).when(same[1], 1).otherwise(2)
    rendered = F.when(F.col("level") == 0, render(F.col("turns"), 0)).when(F.col("level") == 1, render(F.col("turns"), 1))
    return (
        grouped.withColumn("source", source)
        .withColumn("level", level)
        .withColumn("formatted", rendered.otherwise(render(F.col("turns"), 2)))
        .withColumn("loss_mask", _mask(F.col("turns"), F.col("level")))
        .withColumn("identical", read_turns() == F.col("source"))
        .select("conv_id", "formatted", "level", "loss_mask", "identical")
    )


def read_turns(formatted: str = "formatted", level: str = "level") -> Column:
    """The turns of a formatted text, read by the grammar."""
    f, n = F.col(formatted), F.col(level)
    return F.when(n == 0, parse(f, 0)).when(n == 1, parse(f, 1)).otherwise(parse(f, 2))


def read_loss(formatted: str = "formatted", level: str = "level", loss_mask: str = "loss_mask") -> Column:
    """The text under the loss mask, unescaped span by span and joined with nothing between."""
    f, n = F.col(formatted), F.col(level)
    cut = lambda s: F.substring(f, s["start"] + 1, s["length"])
    plain = lambda s: F.when(n == 0, cut(s)).otherwise(unescaped(cut(s), 1))
    return F.array_join(F.transform(F.col(loss_mask), plain), "")
