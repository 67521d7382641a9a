"""Chat formatting: event logs folded into final messages, rendered with a template that can be read back.

Everything here is DataFrame and SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def escaped(text: Column) -> Column:
    r"""No `<|` is left: between `<` and `|`, with any backslashes there, one backslash more is put. Reversible."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _role_out(role: Column) -> Column:
    """Roles end at a line end, so theirs are written %0A (and % as %25)."""
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages (conv_id, at, role, text) of a log of conv_id, seq, kind, message_id, role, text.

    kind: `message` (a whole message), `delta` (text added to a message), `edit` (new text for a message) or
    `regenerate` (a message is begun anew). Events with one message_id in a conversation make one message, which stands
    where its first event does and has that event's role; its text is that of the last message, edit or regenerate
    event and of the deltas after it. An event without message_id is a message of its own. Events are taken by seq,
    ties by kind, role and text, so repeated events count as often as they are there. Null texts and roles are empty,
    null kinds are `message`. One conversation is sorted in one task, which spills.
    """
    e = events.select(
        "conv_id", "seq", F.coalesce("kind", F.lit("message")).alias("kind"), "message_id", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    log = Window.partitionBy("conv_id").orderBy("seq", "kind", "role", "text")
    e = e.withColumn("at", F.row_number().over(log))
    message = F.coalesce(F.concat(F.lit("m"), F.col("message_id").cast("string")), F.concat(F.lit("p"), F.col("at").cast("string")))
    folded = e.withColumn("_message", message).groupBy("conv_id", "_message").agg(
        F.min(F.struct("at", "role")).alias("first"),
        F.max(F.when(F.col("kind") != "delta", F.col("at"))).alias("reset"),
        F.array_sort(F.collect_list(F.struct("at", "text"))).alias("parts"),
    )
    live = F.filter("parts", lambda p: F.col("reset").isNull() | (p["at"] >= F.col("reset")))
    return folded.select("conv_id", F.col("first.at").alias("at"), F.col("first.role").alias("role"), F.array_join(F.transform(live, lambda p: p["text"]), "").alias("text"))


def render(messages: DataFrame, masked_role: str = "assistant") -> DataFrame:
    """conv_id, formatted and loss_spans of every conversation (its messages by `at`).

    A turn is the start string, its role, a line end, its escaped text, the end string and a line end. loss_spans are
    [start, end) in code points of `formatted`, one for the text of each turn of `masked_role`.
    """
    turn = F.struct("at", F.col("role").eqNullSafe(masked_role).alias("masked"), F.concat(F.lit(START), _role_out(F.col("role")), F.lit("\n")).alias("head"), escaped(F.col("text")).alias("body"))
    tail = f"{END}\n"
    turns = messages.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    step = lambda acc, t: F.struct(
        (acc["pos"] + F.length(t["head"]) + F.length(t["body"]) + len(tail)).alias("pos"),
        F.when(t["masked"], F.concat(acc["spans"], F.array(F.struct((acc["pos"] + F.length(t["head"])).alias("start"), (acc["pos"] + F.length(t["head"]) + F.length(t["body"])).alias("end"))))).otherwise(acc["spans"]).alias("spans"),
    )
    spans = F.aggregate("turns", F.struct(F.lit(0).alias("pos"), F.lit([]).cast("array<struct<start:int,end:int>>").alias("spans")), step, lambda acc: acc["spans"])
    return turns.select("conv_id", F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(tail))), "").alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text), loss_text (unescaped text under the spans, in order) and formatted of rendered conversations."""
    # escaped texts hold no `<|`, so the start string splits turns and the first line end after it ends the role
    pieces = F.filter(F.split("formatted", r"<\|im_start\|>"), lambda p: p != "")
    body = lambda p: F.substring(p, F.instr(p, "\n") + 1, F.length(p))
    turns = F.transform(
        pieces,
        lambda p: F.struct(_role_in(F.substring_index(p, "\n", 1)).alias("role"), unescaped(F.regexp_replace(body(p), r"<\|im_end\|>\n\z", "")).alias("text")),
    )
    masked = F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"])))
    return formatted.select("conv_id", turns.alias("turns"), F.array_join(masked, "").alias("loss_text"), "formatted")


def conversation_events(conversations: DataFrame) -> DataFrame:
    """The log of a table of finished turns: each row is a whole message at its turn."""
    return conversations.select("conv_id", F.col("turn").alias("seq"), F.lit("message").alias("kind"), F.lit(None).cast("long").alias("message_id"), "role", "text")


def digests(read: DataFrame) -> DataFrame:
    """One row per conversation, from what `read_back` gives."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
