"""Chat formatting of reply trees.

Messages name their parent. Self-joins that double their reach each round give every
message its depth and the score of its path from the root, so a chain of ``n`` replies
takes ``log2 n`` rounds. Leaves stand for the branches; they are ranked by score within
their conversation, and the messages of each chosen path are found by the same jumps,
the longest first. A path becomes one conversation in a template whose control strings
are escaped in the texts so that the texts can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectorferry.llm.store import materialize

BEGIN, END = "<|im_start|>", "<|im_end|>\n"
LEARNED_ROLE = "assistant"


def escape(text: Column) -> Column:
    """Double each backslash, then part each ``<|`` by one; no control string is left."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """As :func:`escape`, and line feeds, which end the role, become ``<\\n>``."""
    return F.replace(escape(role), F.lit("\n"), F.lit("<\\n>"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<\\n>"), F.lit("\n")))


def _segments(role: Column, text: Column) -> Column:
    """Pieces of one turn in order: ``(text, loss)``; only an assistant's text is learned."""
    def piece(value: Column, loss: bool) -> Column:
        return F.struct(value.alias("text"), F.lit(loss).alias("loss"))

    head = F.concat(F.lit(BEGIN), escape_role(role), F.lit("\n"))
    return F.when(
        role == LEARNED_ROLE, F.array(piece(head, False), piece(escape(text), True), piece(F.lit(END), False)),
    ).otherwise(F.array(piece(F.concat(head, escape(text), F.lit(END)), False)))


def rendered(segments: Column) -> Column:
    """The whole formatted conversation."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def learned(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    masked = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(masked, lambda s: unescape(s["text"])), "")


def parsed(formatted: Column) -> Column:
    """Turns ``(role, text)`` read back from a formatted conversation."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)
    bodies = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.substring(p, F.lit(len(BEGIN) + 1), F.length(p)))

    def turn(body: Column) -> Column:
        role = F.substring_index(body, "\n", 1)
        text = F.substring(body, F.length(role) + 2, F.length(body))
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(bodies, turn)


def linear_messages(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text") -> DataFrame:
    """Turns as messages, each the reply to the one before: ``(conv_id, message_id, parent_id, score, role, text)``."""
    order = Window.partitionBy(conversation).orderBy(turn, role, text)
    place = F.row_number().over(order).cast("bigint")
    return turns.select(
        F.col(conversation).alias("conv_id"), place.alias("message_id"), F.lit(0.0).alias("score"),
        F.col(role).alias("role"), F.col(text).alias("text"),
    ).withColumn("parent_id", F.expr("case when message_id > 1 then message_id - 1 end"))


def _jumps(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``(c, m, depth, total)`` of all messages that hang on a root, and tables of jumps by 1, 2, 4, ..."""
    parents = messages.select("c", F.col("m").alias("parent"), F.lit(True).alias("there"))
    start = messages.select("c", "m", "parent", "score").join(parents, ["c", "parent"], "left").select(
        "c", "m", F.expr("case when there then parent end").alias("up"), F.lit(1).cast("bigint").alias("depth"),
        F.col("score").alias("total"))
    state = materialize(start, "paths")
    rooted, jumps, rounds = [], [], 0
    limit = state.count().bit_length() + 1  # beyond that only cycles are left
    while True:
        rooted.append(state.filter("up is null").select("c", "m", "depth", "total"))
        active = state.filter("up is not null")
        if rounds > limit or active.isEmpty():
            break
        rounds += 1
        jumps.append(active.select("c", "m", "up"))
        known = rooted[0]
        for part in rooted[1:]:
            known = known.unionByName(part)
        ahead = known.select("c", F.col("m").alias("up"), F.lit(None).cast(state.schema["up"].dataType).alias("next"),
                             F.col("depth").alias("more"), F.col("total").alias("add"))
        ahead = ahead.unionByName(active.select("c", F.col("m").alias("up"), F.col("up").alias("next"),
                                                F.col("depth").alias("more"), F.col("total").alias("add")))
        state = materialize(active.join(ahead, ["c", "up"]).select(
            "c", "m", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"),
            (F.col("total") + F.col("add")).alias("total")), "paths")
    known = rooted[0]
    for part in rooted[1:]:
        known = known.unionByName(part)
    return known, jumps


def format_trees(messages: DataFrame, conversation: str = "conv_id", message: str = "message_id",
                 parent: str = "parent_id", score: str = "score", role: str = "role", text: str = "text",
                 branches: int = 1) -> DataFrame:
    """``(conversation, leaf, branch, path_score, segments)``: the best branches of each conversation.

    ``path_score`` sums the scores from root to leaf; of equal ones the longer path,
    then the smaller leaf is ranked first. ``branch`` counts from 1; ``branches`` is
    how many are kept. Null roles and texts count as empty, null scores as 0. A
    message whose parent is null or absent is a root; a conversation may have many,
    and its branches are ranked together. Messages of a cycle and those below it
    have no root and are in no path; a message without an id cannot be placed either.
    Rows of one id are one message, the smallest by parent, score, role and text. A
    null conversation id is one conversation. Other columns are not read. An empty
    table gives an empty result. A path is one row, as it is one text.
    """
    rows = messages.select(
        F.coalesce(F.concat(F.lit("k"), F.col(conversation).cast("string")), F.lit("n")).alias("c"),
        F.col(conversation).alias("name"), F.col(message).alias("m"), F.col(parent).alias("parent"),
        F.coalesce(F.col(score).cast("double"), F.lit(0.0)).alias("score"),
        F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"),
    ).filter("m is not null")
    one = materialize(
        rows.groupBy("c", "m").agg(F.min(F.struct("parent", "score", "role", "text", "name")).alias("w")).select(
            "c", "m", "w.*"), "messages")
    placed, jumps = _jumps(one.select("c", "m", "parent", "score"))
    placed = materialize(placed, "placed")
    above = one.filter("parent is not null").select("c", F.col("parent").alias("m")).distinct()
    leaves = placed.join(above, ["c", "m"], "left_anti")
    rank = F.row_number().over(
        Window.partitionBy("c").orderBy(F.col("total").desc(), F.col("depth").desc(), F.col("m")))
    chosen = materialize(
        leaves.withColumn("branch", rank).filter(F.col("branch") <= branches).select(
            "c", F.col("m").alias("leaf"), "branch", "total", "m"), "chosen")
    path = chosen
    for jump in reversed(jumps):
        further = path.join(jump, ["c", "m"]).select("c", "leaf", "branch", "total", F.col("up").alias("m"))
        path = materialize(path.unionByName(further), "chosen")
    full = path.join(placed.select("c", "m", "depth"), ["c", "m"]).join(
        one.select("c", "m", "name", "role", "text"), ["c", "m"])
    turns = F.sort_array(F.collect_list(F.struct("depth", "role", "text")))
    grouped = full.groupBy("c", "leaf", "branch", "total").agg(turns.alias("turns"), F.first("name").alias("name"))
    return grouped.select(
        F.col("name").alias(conversation), "leaf", "branch", F.col("total").alias("path_score"),
        F.flatten(F.transform("turns", lambda t: _segments(t["role"], t["text"]))).alias("segments"))
