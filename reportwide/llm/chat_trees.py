"""Chat formatting of reply trees, in DataFrame functions only.

Messages form trees by parent links. Iterative self-joins double every message's jump to an
ancestor (1, 2, 4, ... steps) and add up depth and score on the way, so a path of n messages
takes log2(n) joins. Leaves are ranked by the score of their branch, the best ``branches`` of each
tree are chosen, and their messages are enumerated with the same jumps, from the leaf up. Each
chosen path is formatted as one conversation.

A turn is ``### <role>:``, a new line, the text and ``</turn>`` with a new line. In roles and
texts backslash, <, # and : become a backslash with b, l, h or c, so no text can hold a control
string, and ``unescape`` gives back the original.

A conversation is one value in the end; its turns meet in one row only there.

Defined cases: null roles and texts are empty; a message whose parent is missing is a root;
messages on a cycle have no root and are left out; equal scores are ranked by message order;
turns of equal number are put in order by role and text; a null conv_id is a conversation of its
own; extra columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reportwide.llm.tables import materialize

# Escapes, in the order in which they are applied (undone in reverse).
ESCAPES = (("\\", "\\b"), ("<", "\\l"), ("#", "\\h"), (":", "\\c"))
HEAD, AFTER_ROLE, END = "### ", ":\n", "</turn>\n"


def escape(text: Column) -> Column:
    for a, b in ESCAPES:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def unescape(text: Column) -> Column:
    for a, b in reversed(ESCAPES):
        text = F.replace(text, F.lit(b), F.lit(a))
    return text


def chosen_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, branch, pos, node) of the best root-to-leaf paths of each tree.

    ``messages``: tree, node (unique), parent (null: root), score. ``pos`` counts from the root,
    ``branch`` from 0 in the order of falling path scores.
    """
    nodes = messages.select("node", "parent", F.coalesce("score", F.lit(0)).cast("double").alias("score"))
    known = nodes.select(F.col("node").alias("parent"), F.lit(True).alias("there"))
    jump = materialize(nodes.join(known, "parent", "left").select(
        "node", F.when(F.col("there"), F.col("parent")).alias("up"), "score",
        F.lit(1).cast("long").alias("depth")), "jump0")
    jumps, size = [jump], messages.count()
    while not jump.filter("up is not null").isEmpty() and (1 << (len(jumps) - 1)) <= size:
        above = jump.select(F.col("node").alias("up"), F.col("up").alias("up2"),
                            F.col("score").alias("more"), F.col("depth").alias("steps"))
        jump = materialize(jump.filter("up is not null").join(above, "up").select(
            "node", F.col("up2").alias("up"), (F.col("score") + F.coalesce("more", F.lit(0.0))).alias("score"),
            (F.col("depth") + F.coalesce("steps", F.lit(0))).alias("depth"))
            .union(jump.filter("up is null").select("node", "up", "score", "depth")), f"jump{len(jumps)}")
        jumps.append(jump)
    # A jump that is still open after more steps than there are messages is on a cycle.
    total = jump.filter("up is null").select("node", "score", "depth")
    inner = jumps[0].filter("up is not null").select(F.col("up").alias("node")).distinct()
    leaves = (total.join(inner, "node", "left_anti").join(messages.select("tree", "node"), "node"))
    best = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
    paths = (leaves.withColumn("branch", F.row_number().over(best) - 1).filter(F.col("branch") < branches)
             .select("tree", "branch", "node", (F.col("depth") - 1).alias("pos")))
    for k, j in enumerate(jumps[:-1] if len(jumps) > 1 else jumps):
        step = j.filter("up is not null").select("node", F.col("up").alias("to"))
        more = paths.join(step, "node").select("tree", "branch", F.col("to").alias("node"), (F.col("pos") - (1 << k)).alias("pos"))
        paths = materialize(paths.union(more), f"paths{k}")
    return paths


def linear(conversations: DataFrame) -> DataFrame:
    """Messages of plain conversations: each turn replies to the one before."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"),
                                F.coalesce("text", F.lit("")).alias("text")).withColumn("i", F.row_number().over(order))
    name = lambda i: F.struct("conv_id", i.alias("i"))
    return rows.select(F.struct("conv_id").alias("tree"), name(F.col("i")).alias("node"),
                       F.when(F.col("i") > 1, name(F.col("i") - 1)).alias("parent"),
                       F.lit(1.0).alias("score"), "role", "text")


def format_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, branch, formatted, loss): one conversation for each chosen path.

    ``loss`` lists the character spans (from 0) of assistant texts inside ``formatted``.
    """
    messages = materialize(messages, "messages")
    paths = chosen_paths(messages, branches)
    turns = paths.join(messages.select("node", "role", "text"), "node")
    turns = turns.groupBy("tree", "branch").agg(F.array_sort(F.collect_list(
        F.struct("pos", "role", escape(F.col("role")).alias("r"), escape(F.col("text")).alias("t")))).alias("turns"))
    head = lambda x: F.concat(F.lit(HEAD), x["r"], F.lit(AFTER_ROLE))
    whole = F.transform("turns", lambda x: F.concat(head(x), x["t"], F.lit(END)))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def add(acc, x):
        a = acc["at"] + F.length(head(x))
        n = F.length(x["t"]).cast("long")
        span = F.array(F.struct(a.cast("long").alias("start"), n.alias("length")))
        return F.struct((a + n + len(END)).cast("long").alias("at"),
                        F.when(x["role"] == "assistant", F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))
    return turns.select("tree", "branch", F.array_join(whole, "").alias("formatted"),
                        F.aggregate("turns", start, add)["spans"].alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns and loss texts as they stand in the formatted conversations: adds ``turns`` and ``masked``."""
    parts = F.filter(F.split("formatted", END), lambda p: p != "")
    turn = lambda p: F.struct(
        unescape(F.substring_index(F.substr(p, F.lit(len(HEAD) + 1)), AFTER_ROLE, 1)).alias("role"),
        unescape(F.substr(p, F.position(F.lit(AFTER_ROLE), p) + len(AFTER_ROLE))).alias("text"))
    masked = F.transform("loss", lambda s: unescape(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return formatted.withColumn("turns", F.transform(parts, turn)).withColumn("masked", masked)
