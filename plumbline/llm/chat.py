"""Chat formatting from an event log.

Conversations arrive as events: a message begins, deltas stream in, an edit replaces a text, a
regeneration takes back a turn and everything after it. The log is partitioned by conversation,
sorted by sequence number and folded into final messages, which are rendered by a template with
reversible escapes and a loss mask over the assistant's words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MESSAGE, DELTA, EDIT, REGENERATE = "message", "delta", "edit", "regenerate"
START, END = "<|im_start|>", "<|im_end|>"
TRAINED_ROLE = "assistant"


def fold_events(log: DataFrame, conversation: str = "conv_id") -> DataFrame:
    """Final messages (conversation, turn, role, text) of a log.

    ``log`` has the conversation, ``seq`` (order), ``kind``, ``turn``, ``role`` and ``text``:

    - ``message`` begins the turn's text, ``delta`` adds to it, ``edit`` replaces it;
    - ``regenerate`` takes back its turn and all later turns as they stood; what follows in the log
      writes them anew.

    A null text is empty. Deltas without a message begin one. Events of one turn with the same
    ``seq`` are taken in the order kind, role, text, so repeated rows fold the same way each time. A
    null conversation is one of its own; other columns are ignored. Unknown kinds are dropped.
    """
    events = log.select(
        F.col(conversation).alias("conv_id"), F.col("seq"), F.col("kind"), F.col("turn"),
        F.col("role"), F.coalesce(F.col("text"), F.lit("")).alias("text")) \
        .where(F.col("kind").isin(MESSAGE, DELTA, EDIT, REGENERATE))
    # From the end of the log, so that the frame only grows: one step an event, however long the log is.
    later = Window.partitionBy("conv_id").orderBy(F.col("seq").desc()).rangeBetween(Window.unboundedPreceding, -1)
    taken_back = F.min(F.when(F.col("kind") == REGENERATE, F.col("turn"))).over(later)
    standing = events.withColumn("back_to", taken_back).where(
        (F.col("kind") != REGENERATE)
        & (F.col("back_to").isNull() | F.col("turn").isNull() | (F.col("turn") < F.col("back_to"))))
    step = F.struct("seq", F.when(F.col("kind") == DELTA, 1).otherwise(0).alias("adds"),
                    "role", "text")
    turns = standing.groupBy("conv_id", "turn").agg(
        F.sort_array(F.collect_list(step)).alias("steps"),
        F.max(F.when(F.col("kind") != DELTA, F.col("seq"))).alias("restart"),
        F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).alias("role"))
    restart = F.col("restart")
    # Of several restarts with the last sequence number the greatest in sort order stands.
    last = F.array_max(F.filter("steps", lambda s: (s["adds"] == 0) & (s["seq"] == restart)))
    added = F.filter("steps", lambda s: (s["adds"] == 1) & (restart.isNull() | (s["seq"] >= restart)))
    return turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.concat(F.coalesce(last["text"], F.lit("")),
                 F.array_join(F.transform(added, lambda s: s["text"]), "")).alias("text"))


def escape_text(text: Column) -> Column:
    """Put one more ``~`` into everything that looks like ``<|``, ``<~|``, ``<~~|`` ..."""
    return F.regexp_replace(text, r"<(~*)\|", "<$1~|")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, r"<(~*)~\|", "<$1|")


def escape_role(role: Column) -> Column:
    """A role is one line: line feeds and the escape's own sign are written as percent codes."""
    coded = F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))
    return escape_text(coded)


def unescape_role(role: Column) -> Column:
    plain = F.replace(unescape_text(role), F.lit("%0A"), F.lit("\n"))
    return F.replace(plain, F.lit("%25"), F.lit("%"))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted`` and ``loss``, the spans (start, end) of code points
    of ``formatted`` that are trained on: each assistant text, without its markers.

    Turns come in order of ``turn`` (null first). Role and text may hold anything, control strings of
    the template included; null counts as empty.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit(START), escape_role(role), F.lit("\n"))
    body = escape_text(text)
    parts = messages.select(
        "conv_id", "turn", (role == TRAINED_ROLE).alias("trained"), head.alias("head"),
        body.alias("body"))
    n_head, n_body = F.length("head"), F.length("body")
    size = n_head + n_body + F.lit(len(END) + 1)
    order = Window.partitionBy("conv_id").orderBy("turn", "head", "body", "trained")
    ends = F.sum(size.cast("long")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    placed = parts.withColumn("nr", F.row_number().over(order)).withColumn("start", ends - size)
    piece = F.struct(
        "nr", F.concat("head", "body", F.lit(END + "\n")).alias("piece"),
        F.when(F.col("trained"), F.struct(
            (F.col("start") + n_head).alias("start"),
            (F.col("start") + n_head + n_body).alias("end"))).alias("span"))
    pieces = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(piece)).alias("pieces"))
    return pieces.select(
        "conv_id", F.array_join(F.transform("pieces", lambda p: p["piece"]), "").alias("formatted"),
        F.filter(F.transform("pieces", lambda p: p["span"]), lambda s: s.isNotNull()).alias("loss"))


def read_back(formatted: Column) -> Column:
    """The messages (role, text) of a formatted conversation."""
    blocks = F.filter(F.split(formatted, r"<\|im_end\|>\n"), lambda b: b != "")

    def message(block):
        line = F.instr(block, "\n")
        return F.struct(
            unescape_role(block.substr(F.lit(len(START) + 1), line - 1 - len(START))).alias("role"),
            unescape_text(block.substr(line + 1, F.length(block))).alias("text"))

    return F.transform(blocks, message)


def masked_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(loss, lambda s: unescape_text(
        formatted.substr((s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))), "")
