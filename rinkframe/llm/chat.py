"""Chat formatting of reply trees with DataFrame operations only.

Messages name their parent. Self-joins first find the ancestors at distances 1, 2, 4, …
of each message; then each leaf's ancestors are doubled, from the nearest on. So all
root-to-leaf paths are enumerated in as many rounds as the depth has bits, with one row
for each message of a path. The paths of a tree are ranked by the sum of their scores,
and each chosen one becomes one conversation. A turn reads

    ### role: text </turn>

with a newline at its end; a backslash stands before each backslash, # and < of a
text, and also before each colon of a role, so that no control string can occur inside
a text and the format can be undone. The loss mask is a list of spans of the formatted
text, which cover assistant texts.

Defined cases: null texts and roles are empty, null scores 0; a null tree id is a tree
of its own; a message whose parent is absent is a root; messages on or below a cycle
have no root and are left out; in a tree, a message id must not repeat; paths that tie
are ranked by their ids; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import storage

END = " </turn>\n"


def escape(text: Column, more: str = "") -> Column:
    return F.regexp_replace(text, rf"([\\#<{more}])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def paths(messages: DataFrame) -> DataFrame:
    """All root-to-leaf paths: tree, path (message ids from the root), score."""
    m = messages.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    known = m.select(F.col("tree").alias("t"), F.col("node").alias("n"))
    m = storage.table(m.join(known, _of("parent"), "left").select("tree", "node", F.col("n").alias("above"), "score"), "messages")
    # Ancestors at distance 1, 2, 4, …: a row a message and round, until none is left.
    jumps = [m.where("above is not null").select("tree", "node", "above")]
    most = m.groupBy("tree").count().agg(F.max("count").alias("n")).first()["n"] or 0
    while 1 << (len(jumps) - 1) < most and jumps[-1].limit(1).count():
        far = jumps[-1].select(F.col("tree").alias("t"), F.col("node").alias("n"), F.col("above").alias("far"))
        jumps.append(storage.table(jumps[-1].join(far, _of("above")).select("tree", "node", F.col("far").alias("above")), "ancestors"))
    parents = jumps[0].select(F.col("tree").alias("t"), F.col("above").alias("n")).distinct()
    # What has an ancestor farther away than its tree has messages lies on or below a cycle.
    endless = jumps.pop().select(F.col("tree").alias("t"), F.col("node").alias("n"))
    leaves = m.select("tree", "node").join(parents, _of("node"), "left_anti").join(endless, _of("node"), "left_anti")
    reach = storage.table(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).alias("up")), "reach")
    for k, jump in enumerate(jumps):
        far = jump.select(F.col("tree").alias("t"), F.col("node").alias("n"), "above")
        more = reach.join(far, _of("node")).select("tree", "leaf", F.col("above").alias("node"), (F.col("up") + (1 << k)).alias("up"))
        reach = reach.unionByName(storage.table(more, "reach"))
    scored = reach.join(m.select(F.col("tree").alias("t"), F.col("node").alias("n"), "score"), _of("node"))
    steps = F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "node", "score")))
    found = scored.groupBy("tree", "leaf").agg(steps.alias("steps"))
    # Summed in the order of the path, so that reruns agree.
    total = F.aggregate("steps", F.lit(0.0), lambda s, x: s + x["score"])
    return found.select("tree", F.transform("steps", lambda x: x["node"]).alias("path"), total.alias("score"))


def _of(node: str) -> Column:
    """Joins messages named by columns tree and `node` with those named t and n."""
    return F.col("tree").eqNullSafe(F.col("t")) & (F.col(node) == F.col("n"))


def format_paths(messages: DataFrame, top: int = 1, loss_role: str = "assistant") -> DataFrame:
    """The `top` best paths of each tree: tree, place, n_turns, formatted, loss (spans of formatted).

    messages: tree, node, parent, score, role, text.
    """
    order = W.partitionBy("tree").orderBy(F.desc("score"), "path")
    chosen = paths(messages).withColumn("place", F.row_number().over(order)).where(F.col("place") <= top)
    steps = chosen.select(F.col("tree").alias("t"), "place", F.posexplode("path").alias("turn_at", "n"))
    role = F.coalesce("role", F.lit(""))
    text = escape(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit("### "), escape(role, ":"), F.lit(": "))
    turns = messages.select("tree", "node", (role == loss_role).alias("in_loss"), F.char_length(head).alias("head_chars"), F.char_length(text).alias("text_chars"), F.concat(head, text, F.lit(END)).alias("piece"))
    turns = steps.join(turns, F.col("t").eqNullSafe(F.col("tree")) & (F.col("n") == F.col("node")))
    before = W.partitionBy("tree", "place").orderBy("turn_at").rowsBetween(W.unboundedPreceding, -1)
    turns = turns.withColumn("from_", F.coalesce(F.sum(F.char_length("piece")).over(before), F.lit(0)) + F.col("head_chars"))
    turns = turns.groupBy("tree", "place").agg(F.array_sort(F.collect_list(F.struct("turn_at", "piece", "in_loss", "from_", (F.col("from_") + F.col("text_chars")).alias("to_")))).alias("turns"))
    loss = F.transform(F.filter("turns", lambda t: t["in_loss"]), lambda t: F.struct(t["from_"].alias("start"), t["to_"].alias("end")))
    return turns.select("tree", "place", F.size("turns").cast("long").alias("n_turns"), F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("formatted"), loss.alias("loss"))


def parse_turns(formatted: Column) -> Column:
    """Roles and texts back from a formatted conversation."""
    pieces = F.filter(F.split(formatted, END), lambda x: x != "")
    pattern = r"(?s)^### ((?:[^:\\]|\\.)*): (.*)$"
    return F.transform(pieces, lambda x: F.struct(unescape(F.regexp_extract(x, pattern, 1)).alias("role"), unescape(F.regexp_extract(x, pattern, 2)).alias("text")))


def loss_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")))), "")


def chains(conversations: DataFrame) -> DataFrame:
    """Reply trees without branches from columns conv_id, turn, role, text: each turn answers the one before.

    Rows that tie in turn are ordered by role and text.
    """
    order = W.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order)
    rows = conversations.select("conv_id", "turn", "role", "text").withColumn("node", node)
    return storage.table(rows.select(F.col("conv_id").alias("tree"), "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text"), "chains")
