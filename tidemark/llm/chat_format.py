"""Chat formatting by event-sourced reconstruction.

A chat log is a stream of events. ``reconstruct`` partitions it by conversation and turn, sorts by
sequence and folds streamed deltas, edits and regenerations into the final messages; ``render`` writes
each conversation as one text of a template with a loss mask; ``read_back`` parses that text again.

The template: a turn of a loss role is ``<s>role\\ntext</s>``, any other ``[INST]role\\ntext[/INST]``.
Where a text holds one of these four marks, a backslash goes behind its first character, and one more
where backslashes stand there already; so no mark is left in a text, and taking one backslash away
gives the text back. Roles are url-encoded.

Work is dealt by (conversation, turn) first: events that a later one of their turn has replaced are
gone before anything is gathered, so a turn's list holds what its final text consists of. Only then do
the turns of a conversation meet, for its one output text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LOSS_ROLES = ("assistant",)

#: Marks of a turn that is learned from, and of any other.
LOSS_MARKS = ("<s>", "</s>")
OTHER_MARKS = ("[INST]", "[/INST]")

#: Code points of one streamed delta in ``events_of``.
DELTA_CHARS = 256

_MARK = r"(/?s>|/?INST\])"
_OPENING = r"(?=<s>|\[INST\])"
_FIRST = -(1 << 63)


def escape(text: Column) -> Column:
    """``text`` without marks of the template; ``unescape`` gives it back."""
    return F.regexp_replace(text, r"([<\[])(\\*)" + _MARK, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[])\\(\\*)" + _MARK, "$1$2$3")


def events_of(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text", streamed_roles: Sequence[str] = LOSS_ROLES) -> DataFrame:
    """The event log of a table of finished turns: (conv_id, seq, turn, event, role, text).

    Each row is a turn of its own, in the order of ``turn_col`` (null first; ties by role and text, so
    repeated rows are turns that follow each other). ``turn`` of the result counts them from 1.
    Streamed roles come as an empty message and deltas of DELTA_CHARS code points, others whole.
    A null text counts as the empty one.
    """
    rows = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("at"), F.col(role_col).alias("role"),
                                F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    placed = rows.withColumn("turn", F.row_number().over(Window.partitionBy("conv_id").orderBy("at", "role", "text")).cast("long"))
    streamed = F.coalesce(F.col("role").isin(*streamed_roles), F.lit(False))
    deltas = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{DELTA_CHARS}}}"), F.lit(0))
    parts = F.when(streamed, F.concat(F.array(F.lit("")), deltas)).otherwise(F.array("text"))
    return placed.select("conv_id", "turn", "role", F.posexplode(parts).alias("part", "text")).select(
        "conv_id", (F.shiftleft("turn", 32) + F.col("part")).alias("seq"), "turn",
        F.when(F.col("part") == 0, "message").otherwise("delta").alias("event"), "role", "text")


def reconstruct(events: DataFrame, conv_col: str = "conv_id", seq_col: str = "seq", turn_col: str = "turn",
                event_col: str = "event", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, turn, role, text): the messages that a chat log ends with.

    Events, in the order of ``seq_col`` (null first):

    - ``message`` and ``edit`` set the text of their turn, ``delta`` appends to it.
    - ``regenerate`` sets it too (mostly to nothing, with deltas to follow) and takes back all later
      turns of the conversation, as far as they were logged before.
    - Other kinds, and null, change nothing.
    - A message's role is the last one that an event of its turn names, null if none does.
    - Events that agree in all these columns are one event, delivered again. Of different setting
      events with one seq the last by kind and text counts; a delta comes after a setting event of its
      seq, deltas of one seq are in the order of their texts.
    - Null texts count as empty, null conversations and turns as any other (the null turn is the first).
    - Other columns are ignored. An empty log gives an empty result.
    """
    e = events.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.lower(event_col).alias("kind"),
                      F.coalesce(F.col(seq_col).cast("long"), F.lit(_FIRST)).alias("seq"), F.col(role_col).alias("role"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(
        F.col("kind").isin("message", "delta", "edit", "regenerate"))
    sets = F.col("kind") != "delta"
    own = Window.partitionBy("conv_id", "turn")
    last = F.struct("seq", "kind", "text")
    folded = e.select(
        "conv_id", "turn", "seq", "text", sets.alias("sets"), last.alias("this"),
        F.max(F.when(sets, last)).over(own).alias("last"),
        F.max(F.when(F.col("role").isNotNull(), F.struct("seq", "role"))).over(own)["role"].alias("role"),
        F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(own).alias("regenerated"),
    ).where(F.when(F.col("sets"), F.col("this") == F.col("last")).otherwise(
        F.col("last").isNull() | (F.col("seq") >= F.col("last.seq")))
    ).groupBy("conv_id", "turn").agg(
        F.first("role").alias("role"), F.first("regenerated").alias("regenerated"),
        F.collect_set(F.struct("seq", (~F.col("sets")).alias("delta"), "text")).alias("log"))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    valid = folded.withColumn("void", F.max("regenerated").over(before)).withColumn(
        "log", F.when(F.col("void").isNull(), F.col("log")).otherwise(F.filter("log", lambda x: x["seq"] > F.col("void"))))
    return valid.where(F.size("log") > 0).select(
        "conv_id", "turn", "role", F.array_join(F.sort_array("log")["text"], "").alias("text"))


def render(messages: DataFrame, loss_roles: Sequence[str] = LOSS_ROLES) -> DataFrame:
    """(conv_id, formatted, turns) from (conv_id, turn, role, text) rows: a row per conversation.

    ``turns`` has, for each turn, the code point offsets in ``formatted`` of its first mark (``start``)
    and of the text to learn from (``loss_start``, ``loss_end``; null for other roles). Order is by turn,
    null first, ties by role and text. Null roles and texts count as empty. Each conversation becomes
    one string, so it must fit a cell (2 GB).
    """
    loss = F.coalesce(F.col("role").isin(*loss_roles), F.lit(False))
    mark = [F.when(loss, a).otherwise(b) for a, b in zip(LOSS_MARKS, OTHER_MARKS)]
    head = F.concat(mark[0], F.url_encode(F.coalesce("role", F.lit(""))), F.lit("\n"))
    body = escape(F.coalesce("text", F.lit("")))
    pieces = messages.select("conv_id", "turn", "role", "text", loss.alias("loss"), head.alias("head"), body.alias("body"),
                             mark[1].alias("tail"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    pieces = pieces.withColumn("n", F.length("head") + F.length("body") + F.length("tail")).select(
        "conv_id", "loss", "head", "body", "tail", F.row_number().over(order).alias("at"),
        F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("start"))
    loss_start = F.when(F.col("loss"), F.col("start") + F.length("head"))
    span = F.struct("start", loss_start.alias("loss_start"), (loss_start + F.length("body")).alias("loss_end"))
    listed = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("at", F.concat("head", "body", "tail").alias("piece"), span.alias("span")))).alias("all"))
    return listed.select("conv_id", F.array_join("all.piece", "").alias("formatted"), F.col("all.span").alias("turns"))


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv_id, formatted, messages) from ``render``'s rows: each message's role and text as the formatted
    text has them, and ``loss``, what the mask covers of it (null where it covers nothing). A null role
    reads back as the empty one."""
    def message(piece: Column, turn: Column) -> Column:
        marks = F.when(piece.startswith(LOSS_MARKS[0]), F.lit(len(LOSS_MARKS[0]))).otherwise(len(OTHER_MARKS[0]))
        inner = F.substring(piece, marks + 1, F.length(piece) - 2 * marks - 1)  # a closing mark has one character more
        line_end = F.locate("\n", inner)
        masked = F.substring(piece, (turn["loss_start"] - turn["start"] + 1).cast("int"), (turn["loss_end"] - turn["loss_start"]).cast("int"))
        return F.struct(F.url_decode(F.substring(inner, F.lit(1), line_end - 1)).alias("role"),
                        unescape(F.substring(inner, line_end + 1, F.length(inner))).alias("text"), unescape(masked).alias("loss"))

    pieces = F.split("formatted", _OPENING)
    return rendered.select("conv_id", "formatted", F.zip_with(pieces, F.col("turns"), message).alias("messages"))
