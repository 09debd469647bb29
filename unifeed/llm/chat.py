"""Operator 10: format reply trees as conversations.

Messages hang in trees (``parent``).  Root-to-leaf paths are enumerated by iterative
self-joins that double the reach each round: after round k every leaf knows its ancestors
nearer than 2^k, so a chain of n messages takes log2(n) joins, not n.  Branches are ranked
by score and each chosen path is formatted as one record, with the spans of assistant text
(the loss mask) as code point offsets.

Template: each turn is ``<|im_start|>role NEWLINE text<|im_end|>NEWLINE``.  Inside texts and
roles a backslash is doubled and every control string is broken by a backslash after its
first character, so the text can be restored exactly and never forges a turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from .shared import table, text_or_empty

START, END = "<|im_start|>", "<|im_end|>\n"
# Control strings of common chat templates start with one of these.
CONTROL = r"<(?=\||/?s>|/?<SYS>>)|<(?=<SYS>>|</SYS>>)|\[(?=/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"\\", r"\\\\"), f"({CONTROL})", r"$1\\")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(escape(role), "\n", "\\\\\n")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def one_per_node(msgs: DataFrame, tree: str, node: str, parent: str, role: str, text: str, score: str | None) -> DataFrame:
    """(t, n, p, role, text, score): of several rows for one node the least by (parent, role, text,
    score), NULLs first, is the message; repeated rows are one."""
    sc = F.coalesce(F.col(score), F.lit(0.0)).cast("double") if score else F.lit(0.0)
    rows = msgs.select(F.col(tree).alias("t"), F.col(node).alias("n"), F.struct(
        F.col(parent).alias("p"), text_or_empty(role).alias("role"), text_or_empty(text).alias("text"), sc.alias("score")).alias("m"))
    return rows.groupBy("t", "n").agg(F.min("m").alias("m")).select("t", "n", "m.*")


def reply_paths(msgs: DataFrame, tree: str, node: str, parent: str) -> DataFrame:
    """(tree, leaf, node, dist) for every node of every root-to-leaf path; dist 0 is the leaf.

    A message whose parent is null or missing is a root.  Messages on a cycle belong to no
    path (they are never reached from a root), nor do messages without a node id.  Rows must be
    unique by (tree, node): :func:`one_per_node`."""
    t, n = F.col(tree), F.col(node)
    ids = msgs.select(t.alias("t"), n.alias("n"), F.col(parent).alias("p"))
    known = ids.select(F.col("t").alias("kt"), F.col("n").alias("kn"))
    up = (ids.where(F.col("p").isNotNull())
             .join(known, F.col("t").eqNullSafe(F.col("kt")) & (F.col("p") == F.col("kn")))
             .select("t", "n", F.col("p").alias("up")))
    up = table(up)
    roots = table(ids.join(up.select(F.col("t").alias("kt"), F.col("n").alias("kn")),
                           F.col("t").eqNullSafe(F.col("kt")) & (F.col("n") == F.col("kn")), "left_anti")
                  .select("t", "n"))
    leaves = ids.join(up.select(F.col("t").alias("kt"), F.col("up").alias("kn")),
                      F.col("t").eqNullSafe(F.col("kt")) & (F.col("n") == F.col("kn")), "left_anti")
    paths = table(leaves.select("t", F.col("n").alias("leaf"), "n", F.lit(0).cast("long").alias("dist")))
    deepest = msgs.groupBy(tree).count().agg(F.max("count")).first()[0] or 0
    reach, jump = 1, up
    while reach < deepest and not jump.isEmpty():
        step = jump.select(F.col("t").alias("jt"), F.col("n").alias("jn"), "up")
        on = F.col("t").eqNullSafe(F.col("jt")) & (F.col("n") == F.col("jn"))
        paths = table(paths.unionByName(
            paths.join(step, on).select("t", "leaf", F.col("up").alias("n"),
                                        (F.col("dist") + reach).alias("dist"))))
        on = F.col("t").eqNullSafe(F.col("jt")) & (F.col("m") == F.col("jn"))
        jump = table(jump.select("t", "n", F.col("up").alias("m")).join(step, on).select("t", "n", "up"))
        reach *= 2
    # keep the paths that end in a root (cycles do not)
    tops = (paths.join(roots.select(F.col("t").alias("kt"), F.col("n").alias("kn")),
                       F.col("t").eqNullSafe(F.col("kt")) & (F.col("n") == F.col("kn")), "left_semi")
                 .select(F.col("t").alias("kt"), F.col("leaf").alias("kl")))
    on = F.col("t").eqNullSafe(F.col("kt")) & (F.col("leaf") == F.col("kl"))
    return paths.join(tops, on, "left_semi").select(
        F.col("t").alias(tree), "leaf", F.col("n").alias(node), "dist")


def format_trees(msgs: DataFrame, tree: str = "tree", node: str = "node", parent: str = "parent",
                 role: str = "role", text: str = "text", score: str | None = None,
                 branches: int | None = None) -> DataFrame:
    """One row per chosen path: ``tree, leaf, branch_rank, branch_score, n_turns, formatted,
    loss_spans`` (array of start, end code points of assistant texts in ``formatted``).

    Branches of a tree rank by mean message score (null scores count 0), ties by leaf;
    ``branches`` keeps that many per tree, None all.  Null texts and roles are empty.
    Repeated rows are one message; of different rows for one node the least by (parent, role,
    text, score) is taken.  Messages without a node id, or on a cycle, are on no path.  An
    empty table gives an empty result; other columns are ignored.  Time grows with the length of
    the formatted text: places are running sums, not counted anew for every turn."""
    msgs_ = table(one_per_node(msgs, tree, node, parent, role, text, score))
    links = msgs_.select(F.col("t").alias(tree), F.col("n").alias(node), F.col("p").alias(parent))
    body = msgs_.select(F.col("t").alias("bt"), F.col("n").alias("bn"), "role", "text", "score")
    rows = reply_paths(links, tree, node, parent).join(
        body, F.col(tree).eqNullSafe(F.col("bt")) & (F.col(node) == F.col("bn")))
    if branches is not None:
        rank = (rows.groupBy(tree, "leaf").agg(F.avg("score").alias("s"))
                    .withColumn("r", F.row_number().over(W.partitionBy(tree).orderBy(F.desc("s"), "leaf")))
                    .where(F.col("r") <= branches).select(F.col(tree).alias("kt"), F.col("leaf").alias("kl")))
        rows = rows.join(rank, F.col(tree).eqNullSafe(F.col("kt")) & (F.col("leaf") == F.col("kl")), "left_semi")
    open_tag = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    turn = rows.select(tree, "leaf", "score", (-F.col("dist")).alias("o"), open_tag.alias("open"),
                       escape(F.col("text")).alias("body"), (F.col("role") == "assistant").alias("train"))
    size = F.char_length("open") + F.char_length("body")
    upto = W.partitionBy(tree, "leaf").orderBy("o").rowsBetween(W.unboundedPreceding, W.currentRow)
    turn = turn.withColumn("end", F.sum((size + len(END)).cast("long")).over(upto) - len(END))
    span = F.struct((F.col("end") - F.char_length("body")).alias("start"), F.col("end"))
    turn = turn.select(tree, "leaf", "score", F.struct("o", F.concat("open", "body", F.lit(END)).alias("said"),
                                                       F.when(F.col("train"), span).alias("span")).alias("turn"))
    path = (turn.groupBy(tree, "leaf").agg(F.avg("score").alias("branch_score"),
                                           F.array_sort(F.collect_list("turn")).alias("turns")))
    formatted = F.concat_ws("", F.transform("turns", lambda x: x.said))
    path = path.select(tree, "leaf", "branch_score", F.size("turns").cast("long").alias("n_turns"), formatted.alias("formatted"),
                       F.array_compact(F.transform("turns", lambda x: x.span)).alias("loss_spans"))
    order = W.partitionBy(tree).orderBy(F.desc("branch_score"), "leaf")
    return path.withColumn("branch_rank", F.row_number().over(order))


def read_back(formatted: Column) -> Column:
    """array<struct<role, text>> parsed from a formatted conversation."""
    parts = F.split(formatted, r"<\|im_end\|>\n", -1)
    header = r"^<\|im_start\|>((?:[^\\\n]++|\\[\s\S])*+)\n"

    def turn(x: Column) -> Column:
        head = F.regexp_extract(x, header, 0)
        return F.struct(
            unescape(F.regexp_extract(x, header, 1)).alias("role"),
            unescape(F.substr(x, F.char_length(head) + 1)).alias("text"))
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between.  Spans are cut from a
    code of four bytes a code point, where a place is found without counting from the start."""
    cut = lambda code, s: F.decode(F.substr(code, (4 * s.start + 1).cast("int"), (4 * (s.end - s.start)).cast("int")), "UTF-32")
    whole = F.array(F.encode(formatted, "UTF-32"))                    # a lambda variable: encoded once
    return F.transform(whole, lambda code: F.concat_ws("", F.transform(spans, lambda s: unescape(cut(code, s)))))[0]
