"""Chat formatting of reply trees, in DataFrame functions only.

Nodes name their parent. Self-joins that double the distance give every node
its root, its depth and its path's score, in as many steps as the depth has
binary digits; the same jumps then list the nodes of the chosen branches. A
branch is a path from the root to a leaf; branches of a tree rank by the sum of
their nodes' scores, then by leaf. Each chosen branch is one conversation in
one row, with the spans (code points) of the assistant's texts.

Turns are ``<|im_start|>role\\ntext<|im_end|>\\n``. In a text, ``<``, any
backslashes and ``|`` get one more backslash, so that no control string is left
and the change can be taken back; a role has ``%``, line feeds and ``|`` in per
cent form.

A node whose parent is missing is a root. Nodes without an id are left out, and
so are nodes on a cycle or below one. Of repeated nodes the least row counts. A
null tree id is a tree of its own. Null texts and roles are empty, null scores
0. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from namepulse.llm.tables import settle

START, STOP = "<|im_start|>", "<|im_end|>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("|"), F.lit("%7C"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%7C"), F.lit("|")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def _jumps(nodes: DataFrame) -> list[DataFrame]:
    """For 1, 2, 4, ... steps: each node's ancestor that far up, or its root if that is nearer.

    ``steps`` and ``total`` count the way there, without the ancestor itself.
    """
    parents = nodes.select("tree", F.col("node").alias("parent"), F.lit(True).alias("there"))
    first = nodes.join(parents, ["tree", "parent"], "left").select(
        "tree",
        "node",
        F.when(F.col("there"), F.col("parent")).otherwise(F.col("node")).alias("up"),
        F.when(F.col("there"), 1).otherwise(0).cast("long").alias("steps"),
        F.when(F.col("there"), F.col("score")).otherwise(0.0).alias("total"),
    )
    found = [settle(first, "tree-jumps")]
    largest = nodes.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    while 1 << (len(found) - 1) < largest:
        last = found[-1]
        on = last.select("tree", F.col("node").alias("up"), F.col("up").alias("next"), F.col("steps").alias("more"), F.col("total").alias("extra"))
        step = last.join(on, ["tree", "up"]).select(
            "tree", "node", F.col("next").alias("up"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("total") + F.col("extra")).alias("total")
        )
        found.append(settle(step, "tree-jumps"))
        if found[-1].where(F.col("steps") == 1 << (len(found) - 1)).isEmpty():
            break
    return found


def branches(nodes: DataFrame, most: int = 1) -> DataFrame:
    """The nodes of each tree's best ``most`` branches: ``tree``, ``rank``, ``depth`` and the node's columns."""
    jumps = _jumps(nodes)
    # On a cycle every jump goes on for ever; a way to the root ends.
    ended = jumps[-1].where(F.col("steps") < 1 << (len(jumps) - 1))
    roots = nodes.select("tree", F.col("node").alias("up"), F.col("score").alias("own"))
    leaves = ended.join(nodes.select("tree", F.col("parent").alias("node")).distinct(), ["tree", "node"], "left_anti")
    leaves = leaves.join(roots, ["tree", "up"]).select("tree", F.col("node").alias("leaf"), "steps", (F.col("total") + F.col("own")).alias("total"))
    order = Window.partitionBy("tree").orderBy(F.desc("total"), "leaf")
    chosen = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    path = settle(chosen.select("tree", "rank", F.col("leaf").alias("node"), F.col("steps").alias("depth")), "tree-paths")
    for k, jump in enumerate(jumps):
        exact = jump.where(F.col("steps") == 1 << k).select("tree", "node", "up")
        above = path.join(exact, ["tree", "node"]).select("tree", "rank", F.col("up").alias("node"), (F.col("depth") - (1 << k)).alias("depth"))
        path = settle(path.union(above), "tree-paths")
    return path.join(nodes.drop("score", "parent"), ["tree", "node"])


def tree_nodes(
    rows: DataFrame, *, tree: str, node: str, parent: str, role: str = "role", text: str = "text", score: str | None = None
) -> DataFrame:
    """Rows as nodes; a tree's key is text, so that a null tree id is a key too."""
    value = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)
    body = F.struct(
        F.col(parent).cast("long").alias("parent"),
        value.alias("score"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    keyed = rows.select(F.to_json(F.struct(F.col(tree).alias("id"))).alias("tree"), F.col(tree).alias("tree_id"), F.col(node).cast("long").alias("node"), body.alias("body"))
    one = keyed.where("node IS NOT NULL").groupBy("tree", "node").agg(F.first("tree_id").alias("tree_id"), F.min("body").alias("body"))
    return one.select("tree", "tree_id", "node", "body.*")


def format_branches(rows: DataFrame, *, tree: str, node: str, parent: str, most: int = 1, speaker: str = "assistant", **names: str) -> DataFrame:
    """One row per chosen branch: ``tree``, ``rank``, ``n_turns``, ``formatted`` and ``loss`` spans ``(start, length)``."""
    nodes = settle(tree_nodes(rows, tree=tree, node=node, parent=parent, **names), "tree-nodes")
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    turn = branches(nodes, most).select(
        "tree",
        "tree_id",
        "rank",
        F.struct("depth", head.alias("head"), escape(F.col("text")).alias("body"), (F.col("role") == speaker).alias("learned")).alias("turn"),
    )
    whole = turn.groupBy("tree", "rank").agg(F.first("tree_id").alias("tree_id"), F.array_sort(F.collect_list("turn")).alias("turns"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(STOP))), "")
    zero = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans"))

    def add(state: Column, t: Column) -> Column:
        start, size = state["at"] + F.length(t["head"]), F.length(t["body"]).cast("long")
        span = F.array(F.struct(start.alias("start"), size.alias("length")))
        spans = F.when(t["learned"], F.concat(state["spans"], span)).otherwise(state["spans"])
        return F.struct((start + size + len(STOP)).alias("at"), spans.alias("spans"))

    loss = F.aggregate("turns", zero, add, lambda s: s["spans"])
    return whole.select(F.col("tree_id").alias(tree), "rank", F.size("turns").cast("long").alias("n_turns"), text.alias("formatted"), loss.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of ``(role, text)``."""
    parts = F.split(formatted, r"<\|im_end\|>\n")
    parts = F.slice(parts, 1, F.size(parts) - 1)
    bare = F.transform(parts, lambda p: F.substr(p, F.lit(len(START) + 1)))
    role = lambda p: F.substring_index(p, "\n", 1)
    return F.transform(
        bare, lambda p: F.struct(unescape_role(role(p)).alias("role"), unescape(F.substr(p, F.length(role(p)) + 2)).alias("text"))
    )


def read_loss(formatted: Column, loss: Column) -> Column:
    """The texts under the loss spans, without escapes, one after the other."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
