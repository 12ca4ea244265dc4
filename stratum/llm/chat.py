"""Chat formatting of reply trees (DataFrame functions only).

Messages form trees: each names its parent. :func:`reply_paths` enumerates the
root-to-leaf paths by iterative self-joins that double their reach: after k
joins every message knows its ancestor 2^k steps up and the score of the
messages between, so a thread of n turns takes log2(n) joins. Branches are
ranked by the summed score of their path in each tree (ties by leaf id), and
only the chosen leaves are expanded to their paths, again by doubling, so the
work follows what is written out. :func:`format_paths` writes each path as one
conversation.

Template, one turn: ``### role: text</turn>`` and a line feed. Inside texts and
roles a backslash is written as ``\\s``, ``<`` as ``\\l`` and ``#`` as ``\\h``
(in roles also ``:`` as ``\\c`` and a line feed as ``\\n``), so no text can hold
a marker and every output can be read back exactly. ``loss_spans`` are the
places (0-based start, length in code points) of the assistant texts.

Defined results: null roles and texts count as empty; a message whose parent is
null or missing is a root; messages on or behind a cycle belong to no path;
a null score is 0; equal message ids count once; an empty table gives no rows;
input columns other than the named ones are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratum.llm.common import stored

TURN_START, ROLE_END, TURN_END = "### ", ": ", "</turn>\n"
ESCAPES = [("\\", "\\s"), ("<", "\\l"), ("#", "\\h")]
ROLE_ESCAPES = [*ESCAPES, (":", "\\c"), ("\n", "\\n")]


def escape(value: Column, escapes=ESCAPES) -> Column:
    for plain, written in escapes:
        value = F.replace(value, F.lit(plain), F.lit(written))
    return value


def unescape(value: Column, escapes=ESCAPES) -> Column:
    for plain, written in reversed(escapes):
        value = F.replace(value, F.lit(written), F.lit(plain))
    return value


def reply_paths(messages: DataFrame, top: int = 1) -> DataFrame:
    """(tree, leaf, rank, up, node): the messages of the ``top`` best branches
    of each tree, ``up`` steps above their leaf. ``messages`` has tree, node
    (unique over all trees), parent and score."""
    nodes = messages.groupBy("node").agg(
        F.min(F.struct("tree", "parent", F.coalesce("score", F.lit(0.0)).alias("score"))).alias("m")
    ).select("node", "m.*")
    nodes = stored(nodes, "chat-nodes")
    ids = nodes.select(F.col("node").alias("parent"))
    jumps = nodes.join(ids, "parent", "left_semi").select("node", F.col("parent").alias("up"))
    reach = stored(
        nodes.join(jumps, "node", "left").select("tree", "node", "up", F.col("score").cast("double").alias("score")),
        "chat-reach-0",
    )
    n = reach.count()
    # messages that know their root are done; only the others are joined again
    whole, open_ = reach.where("up IS NULL"), reach.where("up IS NOT NULL")
    levels = []
    for k in range(1, 2 + math.ceil(math.log2(max(2, n)))):  # more only at a cycle
        if open_.isEmpty():
            break
        levels.append(open_.select("node", "up"))
        known = whole.unionByName(open_)
        above = known.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("score").alias("score2"))
        reach = stored(
            open_.join(above, "up").select(
                "tree", "node", F.col("up2").alias("up"), (F.col("score") + F.col("score2")).alias("score")
            ),
            f"chat-reach-{k}",
        )
        whole, open_ = whole.unionByName(reach.where("up IS NULL")), reach.where("up IS NOT NULL")
    whole = whole.select("tree", "node", "score")
    leaves = whole.join(nodes.select(F.col("parent").alias("node")), "node", "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc("score"), "node")
    # the filter on the rank also runs before the shuffle: a large tree sends top rows a task
    chosen = leaves.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    paths = stored(chosen.select("tree", F.col("node").alias("leaf"), "rank", F.lit(0).cast("bigint").alias("up"), "node"), "chat-paths")
    for k in reversed(range(len(levels))):
        step = levels[k].select("node", F.col("up").alias("next"))
        more = paths.join(step, "node").select("tree", "leaf", "rank", (F.col("up") + (1 << k)).alias("up"), F.col("next").alias("node"))
        paths = paths.unionByName(more)
        if k % 4 == 0 and k:
            paths = stored(paths, "chat-paths")
    return paths


def format_paths(paths: DataFrame, messages: DataFrame) -> DataFrame:
    """(tree, leaf, rank, formatted, loss_spans): a row for each path.
    ``messages`` has node, role and text."""
    texts = messages.groupBy("node").agg(
        F.min(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))).alias("m")
    )
    head = F.concat(F.lit(TURN_START), escape(F.col("m.role"), ROLE_ESCAPES), F.lit(ROLE_END))
    turns = paths.join(texts, "node").select(
        "tree", "leaf", "rank", "up", head.alias("head"), escape(F.col("m.text")).alias("body"), (F.col("m.role") == "assistant").alias("loss")
    )
    turns = turns.withColumn("seg", F.concat("head", "body", F.lit(TURN_END)))
    in_path = Window.partitionBy("tree", "leaf", "rank").orderBy(F.desc("up"))
    start = F.sum(F.length("seg")).over(in_path) - F.length("seg") + F.length("head")
    spans = F.struct(start.cast("bigint").alias("start"), F.length("body").cast("bigint").alias("length"))
    turns = turns.withColumn("span", F.when(F.col("loss"), spans))
    return (
        turns.groupBy("tree", "leaf", "rank")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "seg", "span"))).alias("t"))
        .select(
            "tree",
            "leaf",
            "rank",
            F.array_join("t.seg", "").alias("formatted"),
            F.filter("t.span", lambda s: s.isNotNull()).alias("loss_spans"),
        )
    )


def read_back(formatted: Column) -> Column:
    """The (role, text) turns of a formatted conversation."""
    segments = F.split(formatted, TURN_END, -1)

    def turn(seg: Column) -> Column:
        role = F.substring_index(F.substr(seg, F.lit(len(TURN_START) + 1)), ROLE_END, 1)
        text = F.substr(seg, F.length(role) + len(TURN_START) + len(ROLE_END) + 1)
        return F.struct(unescape(role, ROLE_ESCAPES).alias("role"), unescape(text).alias("text"))

    return F.transform(F.slice(segments, F.lit(1), F.size(segments) - 1), turn)


def loss_text(formatted: Column, loss_spans: Column) -> Column:
    """The texts under the loss mask, unescaped, one after the other."""
    return F.array_join(
        F.transform(
            loss_spans,
            lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))),
        ),
        "",
    )


def from_turns(conversations: DataFrame) -> DataFrame:
    """Messages of a table with conv_id, turn, role and text: each row replies
    to the row before it (by turn, then role and text; null first)."""
    rows = conversations.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("tree"), "turn", "role", "text")
    at = F.row_number().over(Window.partitionBy("tree").orderBy("turn", "role", "text"))
    return rows.withColumn("at", at).select(
        "tree",
        F.concat_ws(":", "tree", "at").alias("node"),
        F.when(F.col("at") > 1, F.concat_ws(":", "tree", F.col("at") - 1)).alias("parent"),
        F.lit(None).cast("double").alias("score"),
        "role",
        "text",
    )
