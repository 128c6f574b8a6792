"""Chat formatting by a grammar round trip: render, parse again, compare, escape what conflicts.

Grammar of a formatted conversation (no white space of its own)::

    conversation := "<s>" turn*
    turn         := "[INST]" text "[/INST]"                    role user
                  | "[SYS]" text "[/SYS]"                      role system
                  | "[OUT]" text "</s>"                        role assistant; its text is under the loss mask
                  | "[ROLE]" role "[/ROLE]" text "</s>"        any other role

A text keeps its characters unless parsing its rendered turn gives something else. Then every control
string in it, and everything that looks like an escaped one, gets one more backslash after its first
character; the parser takes one away. So no text can hold a control string, and the parser splits.
All of it are DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm import common

BEGIN = "<s>"
#: role: what stands before and after its text.
MARKS = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]"), "assistant": ("[OUT]", "</s>")}
OTHER = ("[ROLE]", "[/ROLE]", "</s>")
#: Role whose texts are under the loss mask.
LEARNED = "assistant"
_NAMES = r"/?(?:(?:INST|SYS|OUT|ROLE)\]|s>)"
_STOPS = rf"[\[<]{_NAMES}"
_CONTROL = rf"([\[<])(\\*)({_NAMES})"
_ESCAPED = rf"([\[<])\\(\\*)({_NAMES})"
#: A turn begins at each of these; none is left inside a text.
_BEGINS = r"(?=\[(?:INST|SYS|OUT|ROLE)\])"


def escape(text: Column) -> Column:
    """``text`` with one more backslash in everything that is or resembles a control string."""
    return F.regexp_replace(text, _CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    """The inverse of ``escape``; texts without an escaped control string are unchanged."""
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def render(role: Column, text: Column) -> Column:
    """One turn. ``text`` and ``role`` are put in as they are."""
    before, between, after = OTHER
    out = F.concat(F.lit(before), role, F.lit(between), text, F.lit(after))
    for name, (start, end) in MARKS.items():
        out = F.when(role == name, F.concat(F.lit(start), text, F.lit(end))).otherwise(out)
    return out


def text_start(role: Column) -> Column:
    """Characters of a rendered turn before its text."""
    out = F.length(role) + len(OTHER[0]) + len(OTHER[1])
    for name, (start, _) in MARKS.items():
        out = F.when(role == name, F.lit(len(start))).otherwise(out)
    return out


def _turn(part: Column) -> Column:
    """(role, text) of one turn. A text ends at the first control string of any kind, so one inside a text shows."""
    rest = F.substring(part, len(OTHER[0]) + 1, 2**31 - 1)
    name = F.split(rest, _STOPS, 2)[0]
    body = F.split(rest.substr(F.length(name) + len(OTHER[1]) + 1, F.length(rest)), _STOPS, 2)[0]
    out = F.struct(unescape(name).alias("role"), unescape(body).alias("text"))
    for role, (start, _) in MARKS.items():
        body = F.split(F.substring(part, len(start) + 1, 2**31 - 1), _STOPS, 2)[0]
        own = F.struct(F.lit(role).alias("role"), unescape(body).alias("text"))
        out = F.when(F.startswith(part, F.lit(start)), own).otherwise(out)
    return out


def parse(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text), texts unescaped."""
    body = F.substring(formatted, len(BEGIN) + 1, 2**31 - 1)
    parts = F.filter(F.split(body, _BEGINS), lambda p: p != "")
    return F.transform(parts, _turn)


def _escaped_where_needed(rows: DataFrame) -> DataFrame:
    """Columns own_role and own_text as they go into the output: escaped where the round trip of the turn asks for it."""
    alone = F.concat(F.lit(BEGIN), render(F.col("role"), F.col("text")))
    source = F.array(F.struct(F.col("role").alias("role"), F.col("text").alias("text")))
    same = parse(alone) == source
    rows = rows.withColumn("own_text", F.when(same, F.col("text")).otherwise(escape(F.col("text"))))
    return rows.withColumn("own_role", F.when(same, F.col("role")).otherwise(escape(F.col("role"))))


def format_chats(
    rows: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv``, formatted, loss_spans (start and length in characters, from 1).

    Turns stand in the order of ``turn`` (NULL first; ties by role, then text). NULL texts and roles are
    empty ones, repeated rows are repeated turns, rows with a NULL ``conv`` are one conversation, an empty
    table gives none; other columns are ignored. The parsed output equals the source for every
    conversation, else the query fails. Rows are exchanged once, by conversation; a conversation is one
    value, so it ends at Spark's limit of 2 GB a value.
    """
    rows = rows.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    rows = _escaped_where_needed(rows)
    rows = rows.withColumn("piece", render(F.col("own_role"), F.col("own_text")))
    order = Window.partitionBy("conv").orderBy("turn", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("place", F.row_number().over(order)).withColumn(
        "start", F.sum(F.length("piece").cast("long")).over(upto) - F.length("piece") + len(BEGIN) + 1
    )
    span = F.struct(
        (F.col("start") + text_start(F.col("own_role"))).cast("int").alias("start"),
        F.length("own_text").alias("length"),
    )
    found = rows.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("place", "piece", "role", "text"))).alias("turns"),
        F.array_sort(F.collect_list(F.when(F.col("role") == LEARNED, span))).alias("loss_spans"),
    )
    found = found.withColumn("formatted", F.concat(F.lit(BEGIN), F.array_join("turns.piece", "")))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    same = F.assert_true(parse(F.col("formatted")) == source, "a conversation is not what its text parses to")
    checked = F.when(same.isNull(), F.col("formatted"))
    return found.select(F.col("conv").alias(conv), checked.alias("formatted"), "loss_spans")


def read_chats(formatted: DataFrame, *, conv: str = "conv_id") -> DataFrame:
    """Digests of formatted conversations: ``conv``, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    Everything comes from the formatted text; the loss text is what its spans cover, unescaped, one
    after another.
    """
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.transform("loss_spans", lambda s: unescape(F.col("formatted").substr(s["start"], s["length"])))
    found = formatted.withColumn("turns", parse(F.col("formatted"))).withColumn("loss", F.array_join(loss, ""))
    return found.select(
        conv,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def round_trip(rows: DataFrame) -> DataFrame:
    """Format, write, read the written conversations back."""
    return read_chats(common.stage(format_chats(rows), "chats"))
