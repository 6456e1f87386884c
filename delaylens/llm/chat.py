"""Chat formatting in budgeted windows with loss masks, by built-in functions.

A turn becomes ``<|im_start|>role\\ntext<|im_end|>\\n``. Control strings inside roles and texts are
escaped reversibly: ``<%`` becomes ``<%%``, then ``<|`` becomes ``<%|``, so no escaped text holds ``<|``
(line ends in roles become ``<%n``).

A conversation is cut in windows of at most ``budget`` tokens, always between turns:

* The system turn (the first, if its role is ``system``) opens every window.
* The prefix sums of the other turns' tokens choose the spans. With room = budget - system -
  history, turns whose sums end in the same half of the room form a span, so a span fits; a turn
  longer than half the room is a span by itself, and only a turn longer than the room exceeds it.
* From the second window on, the last ``history_turns`` turns of the span before are repeated, as
  far as they have at most ``history_tokens`` tokens.
* The loss mask covers the texts of assistant turns where they are new; repeated ones are masked
  out, so each is a target once.

Tokens are estimated as a quarter of the bytes of the formatted turn, unless a column names them.

Defined results: null texts and roles are empty; turns are ordered by number, then role and text,
null numbers first; repeated rows are turns of their own; rows without a conversation id form one
conversation; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


@dataclass(frozen=True)
class ChatParams:
    budget: int = 1024        # tokens of a window
    history_tokens: int = 192
    history_turns: int = 2


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<%"), F.lit("<%%")), F.lit("<|"), F.lit("<%|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<%|"), F.lit("<|")), F.lit("<%%"), F.lit("<%"))


def _segments(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str,
              tokens_col: str | None) -> DataFrame:
    """One row per turn: conv, turn, role, text, head, seg, tok."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    head = F.concat(F.lit(OPEN), F.replace(escape(role), F.lit("\n"), F.lit("<%n")), F.lit("\n"))
    named = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"),
                         text.alias("text"), head.alias("head"), escape(text).alias("body"),
                         *([F.col(tokens_col).cast("long").alias("tok")] if tokens_col else []))
    named = named.withColumn("seg", F.concat("head", "body", F.lit(CLOSE)))
    return named if tokens_col else named.withColumn("tok", F.expr("(octet_length(seg) + 3) div 4"))


def format_windows(turns: DataFrame, p: ChatParams = ChatParams(), conv_col: str = "conv_id", turn_col: str = "turn",
                   role_col: str = "role", text_col: str = "text", tokens_col: str | None = None) -> DataFrame:
    """One row per window: conv, window (from 1), text, n_segments, n_repeated (the segments at its
    front that earlier windows had), n_tokens, loss_spans (start and end in code points)."""
    conv = Window.partitionBy("conv")
    ordered = conv.orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    system = F.col("is_system")
    rows = (_segments(turns, conv_col, turn_col, role_col, text_col, tokens_col)
            .withColumn("pos", F.row_number().over(ordered))
            .withColumn("is_system", (F.col("pos") == 1) & (F.col("role") == "system"))
            .withColumn("ends", F.sum(F.when(system, 0).otherwise(F.col("tok"))).over(so_far))
            .withColumn("system_tok", F.max(F.when(system, F.col("tok")).otherwise(0)).over(whole)))
    half = F.greatest(F.expr(f"({p.budget - p.history_tokens} - system_tok) div 2"), F.lit(1))
    span = F.expr("(ends - 1) div half") * 2 + F.when(F.col("tok") > F.col("half"), 0).otherwise(1)
    # A new span starts where the key differs from that of the turn before; the system turn has none.
    rows = (rows.withColumn("half", half).withColumn("span", F.when(system, None).otherwise(span))
            .withColumn("prior", F.lag("span").over(ordered))
            .withColumn("starts", F.when(system, 0).when(F.col("span").eqNullSafe(F.col("prior")) &
                                                         F.col("span").isNotNull(), 0).otherwise(1))
            .withColumn("window", F.greatest(F.sum("starts").over(so_far), F.lit(1)))
            .withColumn("last_window", F.max("window").over(whole)))
    tail = Window.partitionBy("conv", "window").orderBy(F.col("pos").desc()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    rows = (rows.withColumn("after", F.count(F.when(~system, 1)).over(tail))
            .withColumn("after_tok", F.sum(F.when(system, 0).otherwise(F.col("tok"))).over(tail)))
    again = (~system & (F.col("after") <= p.history_turns) & (F.col("after_tok") <= p.history_tokens)
             & (F.col("window") < F.col("last_window")))
    own = F.struct(F.col("window"), F.lit(True).alias("new"))
    places = (F.when(system, F.transform(F.sequence(F.lit(1), F.col("last_window").cast("int")), lambda w: F.struct(
        w.cast("long").alias("window"), (w == 1).alias("new"))))
        .when(again, F.array(own, F.struct((F.col("window") + 1).alias("window"), F.lit(False).alias("new"))))
        .otherwise(F.array(own)))
    copies = rows.select("conv", "pos", "role", "head", "body", "seg", "tok", F.explode(places).alias("at")).select(
        "conv", F.col("at.window").alias("window"), F.col("at.new").alias("new"), "pos", "role", "head", "body", "seg", "tok")
    before = Window.partitionBy("conv", "window").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("seg")).over(before), F.lit(0)) + F.length("head")
    target = F.col("new") & (F.col("role") == "assistant")
    placed = copies.withColumn("loss_start", start).withColumn(
        "loss", F.when(target, F.struct("pos", F.col("loss_start").alias("start"),
                                        (F.col("loss_start") + F.length("body")).alias("end"))))
    # A window has at most ``budget`` tokens, or one turn besides system and history.
    return placed.groupBy("conv", "window").agg(
        F.concat_ws("", F.transform(F.array_sort(F.collect_list(F.struct("pos", "seg"))), lambda s: s["seg"])).alias("text"),
        F.count(F.lit(1)).alias("n_segments"), F.count(F.when(~F.col("new"), 1)).alias("n_repeated"),
        F.sum("tok").alias("n_tokens"),
        F.transform(F.array_sort(F.collect_list("loss")), lambda s: F.struct(s["start"], s["end"])).alias("loss_spans"),
    ).withColumnRenamed("conv", conv_col)


def read_turns(windows: DataFrame) -> DataFrame:
    """``windows`` with ``turns``: array of (role, text), unescaped, of the segments that are new, and
    ``targets``: the unescaped texts under the loss mask."""
    closed = F.split("text", r"<\|im_end\|>\n")
    segments = F.slice(closed, F.col("n_repeated") + 1, F.col("n_segments") - F.col("n_repeated"))
    parts = windows.withColumn("__segments", segments)

    def turn(seg: Column) -> Column:
        role = F.substring_index(F.substring(seg, len(OPEN) + 1, 2**31 - 1), "\n", 1)
        body = F.substring(seg, F.length(role) + len(OPEN) + 2, F.length(seg))
        return F.struct(unescape(F.replace(role, F.lit("<%n"), F.lit("\n"))).alias("role"), unescape(body).alias("text"))

    return (parts.withColumn("turns", F.transform("__segments", turn))
            .withColumn("targets", F.transform("loss_spans", lambda s: unescape(
                F.substring(F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))))
            .drop("__segments"))


def digests(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, read back from its windows: number and hash of its turns, length and hash
    of what the loss mask covers, and the length of the formatted text.

    A conversation's digest needs its text in order, so its windows meet in one row.
    """
    read = read_turns(windows).select(
        conv_col, "window", F.length("text").cast("long").alias("chars"), F.size("turns").cast("long").alias("n"),
        F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))).alias("said"),
        F.concat_ws("", F.col("targets")).alias("loss"))
    joined = lambda c: F.concat_ws("", F.transform(
        F.array_sort(F.collect_list(F.struct("window", c))), lambda s: s[c]))
    whole = read.groupBy(conv_col).agg(
        F.sum("n").alias("n_turns"), joined("said").alias("said"), joined("loss").alias("loss"),
        F.sum("chars").alias("formatted_chars"), F.count(F.lit(1)).alias("n_windows"))
    return whole.select(
        conv_col, "n_turns", F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars", "n_windows")
