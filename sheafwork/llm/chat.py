"""Reply trees as chat text.

Paths from root to leaf are enumerated by self-joins that double the distance: after
step k every leaf has its ancestors up to 2^k away, and each message knows the one 2^k
above it. So a thread of n messages takes log2(n) rounds. Branches are ranked by score,
and each chosen path is laid out as one conversation. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sheafwork.llm.tables import written

START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"
_NODE = ["tree_id", "message_id", "copy"]
_LEAF = ["tree_id", "leaf_id", "leaf_copy"]


def escape(text: Column) -> Column:
    """Put a backslash into whatever could be read as the start of a control string."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def _escaped_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role(escaped: Column) -> Column:
    return F.replace(F.replace(unescape(escaped), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _same(left: DataFrame, right: DataFrame, pairs: dict[str, str]) -> Column:
    """Equality of columns where null equals null."""
    condition = F.lit(True)
    for one, two in pairs.items():
        condition = condition & left[one].eqNullSafe(right[two])
    return condition


def _nodes(messages: DataFrame) -> DataFrame:
    best = F.col("score").desc_nulls_last()
    order = W.partitionBy("tree_id", "message_id").orderBy(best, "role", "text", "parent_id")
    return messages.select(
        "tree_id",
        "message_id",
        F.when(F.col("parent_id") < F.col("message_id"), F.col("parent_id")).alias("parent_id"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.col("score").cast("double").alias("score"),
    ).withColumn("copy", F.row_number().over(order))


def paths(nodes: DataFrame) -> DataFrame:
    """``(tree_id, leaf_id, leaf_copy, message_id, copy, distance)`` for all leaves."""
    targets = nodes.where("copy = 1").select(
        F.col("tree_id").alias("t"), F.col("message_id").alias("above")
    )
    linked = nodes.join(
        targets, _same(nodes, targets, {"tree_id": "t"}) & (nodes.parent_id == targets.above), "left"
    )
    jumps = written(linked.select(*_NODE, "above"))
    parents = jumps.where("above IS NOT NULL").select(
        F.col("tree_id").alias("t"), F.col("above").alias("m"), F.lit(1).alias("c")
    )
    leaves = jumps.join(
        parents.distinct(), _same(jumps, parents, {"tree_id": "t", "message_id": "m", "copy": "c"}), "left_anti"
    )
    found = leaves.select(
        "tree_id",
        F.col("message_id").alias("leaf_id"),
        F.col("copy").alias("leaf_copy"),
        "message_id",
        "copy",
        F.lit(0).cast("long").alias("distance"),
    )
    step = 1
    while True:
        jumps = jumps.where("above IS NOT NULL")
        if jumps.isEmpty():
            return found
        ups = jumps.select(
            F.col("tree_id").alias("t"), F.col("message_id").alias("m"), F.col("copy").alias("c"), "above"
        )
        further = found.join(ups, _same(found, ups, {"tree_id": "t", "message_id": "m", "copy": "c"}))
        further = further.select(
            *_LEAF, F.col("above").alias("message_id"), F.lit(1).alias("copy"), F.col("distance") + step
        )
        found = written(found.union(further))
        firsts = ups.where("c = 1").select(
            F.col("t").alias("tree"), F.col("m").alias("mid"), F.col("above").alias("next")
        )
        twice = jumps.join(firsts, _same(jumps, firsts, {"tree_id": "tree"}) & (jumps.above == firsts.mid))
        jumps = written(twice.select(*_NODE, F.col("next").alias("above")))
        step *= 2


def conversations(messages: DataFrame, branches: int | None = None) -> DataFrame:
    """Chosen paths of ``messages(tree_id, message_id, parent_id, role, text, score)``.

    A tree's branches are ranked by the mean score of their messages, best first, then
    by their leaf; the first ``branches`` are chosen, all without it. The result has
    ``tree_id, leaf_id, leaf_copy, branch_rank, mean_score, n_turns, formatted`` and
    ``loss_spans``, the code points of ``formatted`` that count for the loss: what
    assistants say.

    A parent that does not come before its reply, or does not exist, makes the reply a
    root, so there are no cycles. Of rows with the same id, the best scored one takes
    the replies, and the others are leaves. Null roles and texts are empty, null scores
    count for nothing, null ids are trees and messages of their own. A path is one value,
    as large as the conversation it is. Further columns are not read.
    """
    nodes = _nodes(messages)
    steps = paths(nodes)
    on = {name: name for name in _NODE}
    steps = steps.join(nodes, _same(steps, nodes, on)).select(
        *(steps[name] for name in [*_LEAF, "distance"]), "role", "text", "score"
    )
    if branches is not None:
        means = steps.groupBy(*_LEAF).agg(F.avg("score").alias("mean"))
        best = W.partitionBy("tree_id").orderBy(F.col("mean").desc_nulls_last(), "leaf_id", "leaf_copy")
        chosen = means.withColumn("place", F.row_number().over(best)).where(F.col("place") <= branches)
        steps = steps.join(chosen, _same(steps, chosen, {name: name for name in _LEAF}), "left_semi")
    role, text = _escaped_role(F.col("role")), escape(F.col("text"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    turn = F.concat(head, text, F.lit(f"{END}\n"))
    steps = steps.select(
        *_LEAF,
        "distance",
        "score",
        turn.alias("turn"),
        F.char_length(head).alias("head"),
        F.char_length(text).alias("size"),
        F.char_length(turn).alias("chars"),
        (F.col("role") == LOSS_ROLE).alias("counts"),
    )
    thread = W.partitionBy(*_LEAF).orderBy(F.col("distance").desc())
    start = F.sum("chars").over(thread) - F.col("chars") + F.col("head")
    span = F.struct(start.alias("start"), (start + F.col("size")).alias("end"))
    steps = steps.select(*_LEAF, "distance", "score", "turn", F.when(F.col("counts"), span).alias("span"))
    rows = F.array_sort(F.collect_list(F.struct((-F.col("distance")).alias("place"), "turn", "span")))
    laid = steps.groupBy(*_LEAF).agg(rows.alias("rows"), F.avg("score").alias("mean_score"))
    best = W.partitionBy("tree_id").orderBy(F.col("mean_score").desc_nulls_last(), "leaf_id", "leaf_copy")
    return laid.select(
        *_LEAF,
        F.row_number().over(best).alias("branch_rank"),
        "mean_score",
        F.size("rows").cast("long").alias("n_turns"),
        F.array_join("rows.turn", "").alias("formatted"),
        F.filter("rows.span", lambda x: x.isNotNull()).alias("loss_spans"),
    )


def turns(formatted: Column) -> Column:
    """``array<struct<role, text>>`` read back from a conversation's text."""
    parts = F.split(formatted, r"<\|im_end\|>\n")
    parts = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        body = F.substr(part, F.lit(len(START) + 1))
        cut = F.instr(body, "\n")
        return F.struct(
            _role(F.left(body, cut - 1)).alias("role"),
            unescape(F.substr(body, cut + 1)).alias("text"),
        )

    return F.transform(parts, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """The unescaped text under the loss mask, joined in order."""
    said = F.transform(
        spans,
        lambda span: unescape(
            F.substr(formatted, (span["start"] + 1).cast("int"), (span["end"] - span["start"]).cast("int"))
        ),
    )
    return F.array_join(said, "")
