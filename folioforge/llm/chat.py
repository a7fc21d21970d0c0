"""Reply trees to chat-formatted training conversations (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.llm.common import kept_table

# The control strings of the template, and how texts and roles avoid them.
START, END = "<|im_start|>", "<|im_end|>\n"
OPENER, ESCAPED_OPENER = "<|", "<\\|"
LINE, ESCAPED_LINE = "\n", "<\\~>"
SLASH, ESCAPED_SLASH = "\\", "\\\\"


def escape(text: Column) -> Column:
    """Backslashes doubled, then every opener split by a single one: no control string is left inside a text."""
    return F.replace(F.replace(text, F.lit(SLASH), F.lit(ESCAPED_SLASH)), F.lit(OPENER), F.lit(ESCAPED_OPENER))


def unescape(text: Column) -> Column:
    """Exact inverse of escape: a single backslash after < only comes from escape, the others come in pairs."""
    return F.replace(F.replace(text, F.lit(ESCAPED_OPENER), F.lit(OPENER)), F.lit(ESCAPED_SLASH), F.lit(SLASH))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit(LINE), F.lit(ESCAPED_LINE))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(ESCAPED_LINE), F.lit(LINE)))


def replies_by_turn(turns: DataFrame) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as reply trees: each row answers the row before it.

    Order: turn, NULL turns last, then role and text, so that ties and repeated rows have one defined order. NULL role
    or text is empty. Rows of a NULL conv_id form one conversation. Other columns are ignored.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(F.col("conv_id").alias("tree"), F.row_number().over(order).cast("long").alias("node"), "role", "text")
    return rows.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(0.0))


def branches(messages: DataFrame, top: int | None = None) -> DataFrame:
    """Root-to-leaf paths of reply trees (tree, node, parent, score): rows (tree, leaf, node, depth, rank).

    Iterative self-joins with doubled steps: in round k each path takes over what lies 2^k replies above it, and every
    message learns its ancestor twice as far up, so a path of d messages needs log2(d) rounds. Joins are on
    (tree, node), so one huge tree is dealt over all tasks.

    A parent that is NULL or absent makes a root. Several rows of one (tree, node) count once, the least by (parent,
    score). Messages whose parents form a circle reach no root and are left out. Branches rank by the sum of their
    scores (NULL is 0), the largest first, ties by leaf; top keeps that many for each tree.
    """
    tree = lambda a, b: F.col(f"{a}.tree").eqNullSafe(F.col(f"{b}.tree"))
    known = messages.where("node IS NOT NULL").groupBy("tree", "node").agg(F.min(F.struct("parent", F.coalesce("score", F.lit(0.0)).alias("score"))).alias("m")).select("tree", "node", "m.parent", "m.score")
    known = kept_table(known)
    ids, parents = known.select("tree", "node"), known.select("tree", F.col("parent").alias("node")).distinct()
    step = known.alias("x").join(ids.alias("y"), tree("x", "y") & (F.col("x.parent") == F.col("y.node")))
    steps = [kept_table(step.select("x.tree", "x.node", F.col("x.parent").alias("up")))]
    most = max(1, known.count())
    while not steps[-1].isEmpty() and 2 ** len(steps) < 2 * most:
        twice = steps[-1].alias("x").join(steps[-1].alias("y"), tree("x", "y") & (F.col("x.up") == F.col("y.node")))
        steps.append(kept_table(twice.select("x.tree", "x.node", "y.up")))
    endless = steps.pop()  # empty, but for messages above which there is a circle
    leaves = ids.alias("x").join(parents.alias("y"), tree("x", "y") & (F.col("x.node") == F.col("y.node")), "left_anti")
    leaves = leaves.alias("x").join(endless.alias("y"), tree("x", "y") & (F.col("x.node") == F.col("y.node")), "left_anti")
    paths = leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("above"))
    for k, step in enumerate(steps):
        more = paths.alias("x").join(step.alias("y"), tree("x", "y") & (F.col("x.node") == F.col("y.node")))
        paths = kept_table(paths.unionByName(more.select("x.tree", "x.leaf", F.col("y.up").alias("node"), (F.col("x.above") + 2**k).alias("above"))))
    facts = paths.alias("x").join(known.alias("y"), tree("x", "y") & (F.col("x.node") == F.col("y.node")), "inner").select("x.tree", "leaf", "x.node", "above", "score")
    totals = facts.groupBy("tree", "leaf").agg(F.sum("score").alias("total"), F.max("above").alias("length"))
    rank = F.row_number().over(Window.partitionBy("tree").orderBy(F.col("total").desc(), "leaf"))
    totals = totals.withColumn("rank", rank)
    if top is not None:
        totals = totals.where(F.col("rank") <= top)
    out = facts.drop("score").alias("x").join(totals.alias("y"), tree("x", "y") & (F.col("x.leaf") == F.col("y.leaf")))
    return out.select("x.tree", "x.leaf", "x.node", (F.col("y.length") - F.col("x.above")).alias("depth"), "y.rank")


def format_branches(messages: DataFrame, paths: DataFrame) -> DataFrame:
    """One row for each chosen path: (tree, rank, formatted, loss_spans).

    loss_spans: code-point spans (start, end exclusive) of the assistants' escaped texts in formatted, in order.
    NULL role or text is empty, and its turn stays; of several rows of one (tree, node) the least counts. Empty tables
    give no rows; other columns are ignored.
    """
    said = F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    texts = messages.groupBy("tree", "node").agg(F.min(said).alias("m")).select("tree", "node", "m.role", "m.text")
    turns = paths.alias("x").join(texts.alias("y"), F.col("x.tree").eqNullSafe(F.col("y.tree")) & (F.col("x.node") == F.col("y.node")))
    head, body = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")), escape(F.col("text"))
    turns = turns.select("x.tree", "rank", "depth", head.alias("head"), body.alias("body"), (F.col("role") == "assistant").alias("learn"))
    rows = turns.groupBy("tree", "rank").agg(F.sort_array(F.collect_list(F.struct("depth", "head", "body", "learn"))).alias("turns"))
    formatted = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda s, t: F.struct(
            (s["at"] + F.length(t["head"]) + F.length(t["body"]) + len(END)).alias("at"),
            F.when(t["learn"], F.array_append(s["spans"], F.struct((s["at"] + F.length(t["head"])).alias("start"), (s["at"] + F.length(t["head"]) + F.length(t["body"])).alias("end")))).otherwise(s["spans"]).alias("spans"),
        ),
        lambda s: s["spans"],
    )
    return rows.select("tree", "rank", formatted.alias("formatted"), spans.alias("loss_spans"))


def read_back(formatted: Column) -> Column:
    """Array of (role, text), unescaped, parsed from the output alone."""
    pieces = F.split(formatted, r"\Q" + START + r"\E")
    pieces = F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece: Column) -> Column:
        inside = F.substring(piece, F.lit(1), F.length(piece) - len(END))
        role = F.substring_index(inside, "\n", 1)
        return F.struct(unescape_role(role).alias("role"), unescape(F.substring(inside, F.length(role) + 2, F.length(inside))).alias("text"))

    return F.transform(pieces, turn)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, with nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def format_chats(messages: DataFrame, top: int | None = None) -> DataFrame:
    """Reply trees (tree, node, parent, role, text, score) to one formatted conversation for each chosen branch.

    NULLs, ties, circles and repeated rows are as in branches and format_branches; an empty table gives no rows.
    """
    return format_branches(messages, branches(messages, top))
