"""Conversations from reply trees, formatted with a reversible template and a loss mask.

Messages form trees by their parents. Iterative self-joins with pointer doubling give every
message its depth and the score sum of its path to the root in log2(depth) rounds, without
making any path. Branches, one per leaf, are ranked by mean score; only the chosen ones are
enumerated, by the same jumps in the other direction, so each round doubles the part of
the path that is known. Then each chosen path becomes one text.

All of it is DataFrame operations, without Python code.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pintulog.shared import settle

OPEN, CLOSE = "<|turn|>", "<|end|>\n"
LEARNT = "assistant"


def escaped(text: Column) -> Column:
    """``text`` without the start of any control string; backslashes mark what changed."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\s")), F.lit("<|"), F.lit("<\\p"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\p"), F.lit("|")), F.lit("\\s"), F.lit("\\"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit("\n"), F.lit("\\n"))


def unescaped_role(role: Column) -> Column:
    return unescaped(F.replace(role, F.lit("\\n"), F.lit("\n")))


def _jumps(links: DataFrame) -> list[DataFrame]:
    """Tables (tree, node, up, total, depth): ``up`` is 2^k messages above, total and depth cover those below it."""
    tables = [settle(links.select("tree", "node", "up", "score", F.lit(1).cast("long").alias("depth")).withColumnRenamed("score", "total"))]
    most = max(1, tables[0].count())
    while (1 << len(tables)) <= 2 * most and not tables[-1].filter("up is not null").isEmpty():
        x, y = tables[-1].alias("x"), tables[-1].alias("y")
        met = x.join(y, (F.col("x.tree") == F.col("y.tree")) & (F.col("x.up") == F.col("y.node")), "left")
        tables.append(settle(met.select(
            "x.tree", "x.node", F.col("y.up").alias("up"),
            (F.col("x.total") + F.coalesce("y.total", F.lit(0.0))).alias("total"),
            (F.col("x.depth") + F.coalesce("y.depth", F.lit(0))).alias("depth"),
        )))
    return tables


def best_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(tree, leaf, position, node) of the ``branches`` best root-to-leaf paths of each tree.

    ``messages`` has (tree, node, parent, score), nodes unique in their tree. A path ranks by its mean
    score, then by length, then by the smaller leaf; a null score counts 0. A message
    whose parent does not exist is a root. Messages that reach no root, because their
    parents form a ring, are in no path; rows without a tree or node are left out.
    """
    known = messages.filter("tree is not null and node is not null")
    parents = known.select("tree", F.col("node").alias("up"))
    links = known.select("tree", "node", F.col("parent").alias("up"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"))
    there = links.join(parents, ["tree", "up"], "left_semi").select("tree", "node", "up", "score")
    tops = links.join(parents, ["tree", "up"], "left_anti").select("tree", "node", F.lit(None).cast(links.schema["up"].dataType).alias("up"), "score")
    jumps = _jumps(there.union(tops))
    rooted = jumps[-1].filter("up is null")
    leaves = rooted.join(jumps[0].select("tree", F.col("up").alias("node")), ["tree", "node"], "left_anti")
    best = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / F.col("depth")), F.desc("depth"), "node")
    chosen = leaves.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= branches)
    paths = chosen.select("tree", F.col("node").alias("leaf"), (F.col("depth") - 1).alias("position"), "node")
    for k, jump in enumerate(jumps[:-1]):
        above = paths.join(jump.filter("up is not null").select("tree", "node", "up"), ["tree", "node"])
        paths = settle(paths.unionByName(above.select("tree", "leaf", (F.col("position") - (1 << k)).alias("position"), F.col("up").alias("node"))))
    return paths


def formatted(turns: DataFrame) -> DataFrame:
    """(tree, leaf, n_turns, formatted, mask) of each path of ``turns`` (tree, leaf, position, role, text).

    A turn is written as the opening string, role, a line feed, text and the closing
    string. Control strings inside roles and texts are escaped and can be restored. The
    mask lists (start, length) in code points of every assistant text, in order, for
    the loss. Null roles and texts are empty ones. A path is one row, as its text is.
    """
    text = escaped(F.coalesce("text", F.lit("")))
    head = F.concat(F.lit(OPEN), escaped_role(F.coalesce("role", F.lit(""))), F.lit("\n"))
    piece = F.concat(head, text, F.lit(CLOSE))
    before = Window.partitionBy("tree", "leaf").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    placed = turns.select(
        "tree", "leaf", "position", piece.alias("piece"), F.length(head).alias("head"), F.length(text).alias("length"),
        F.coalesce(F.col("role") == LEARNT, F.lit(False)).alias("learnt"),
    ).withColumn("start", F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)) + F.col("head"))
    grouped = placed.groupBy("tree", "leaf").agg(
        F.sort_array(F.collect_list(F.struct("position", "piece", "learnt", "start", "length"))).alias("turns")
    )
    return grouped.select(
        "tree", "leaf",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join("turns.piece", "").alias("formatted"),
        F.transform(F.filter("turns", lambda t: t["learnt"]), lambda t: F.struct(t["start"].alias("start"), t["length"].cast("long").alias("length"))).alias("mask"),
    )


def read_back(chats: DataFrame) -> DataFrame:
    """``chats`` with ``turns`` (role, text) and ``learnt``, the unescaped text under the mask, from its text alone."""
    body = F.split("formatted", r"<\|end\|>\n")
    inner = F.transform(F.slice(body, 1, F.size(body) - 1), lambda t: F.substring(t, len(OPEN) + 1, 1 << 30))

    def turn(t: Column) -> Column:
        role = F.substring_index(t, "\n", 1)
        return F.struct(unescaped_role(role).alias("role"), unescaped(F.substring(t, F.length(role) + 2, F.lit(1 << 30))).alias("text"))

    under = F.transform("mask", lambda m: unescaped(F.substring(F.col("formatted"), (m["start"] + 1).cast("int"), m["length"].cast("int"))))
    return chats.withColumns({"turns": F.transform(inner, turn), "learnt": F.array_join(under, "")})


def from_conversations(df: DataFrame) -> DataFrame:
    """Messages of linear conversations (conv_id, turn, role, text): each turn answers the one before.

    Rows follow their turn; rows of one turn follow role and text, and repeated rows
    are turns of their own. Rows without a conversation are left out.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = df.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("tree"), "role", "text", F.row_number().over(order).cast("long").alias("node")
    )
    return numbered.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def format_trees(messages: DataFrame, branches: int = 1) -> DataFrame:
    """The chosen paths of reply trees (tree, node, parent, role, text, score), each as one text."""
    messages = settle(messages.select("tree", "node", "parent", "role", "text", "score"))
    turns = best_paths(messages, branches).join(messages.select("tree", "node", "role", "text"), ["tree", "node"])
    return formatted(turns)


def conversation_digests(df: DataFrame) -> DataFrame:
    """One row per conversation: what is read back from its formatted text."""
    chats = read_back(format_trees(from_conversations(df)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2(F.col("learnt").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


CONVERSATIONS_SQL = r"""
with turns as (
  select conv_id, turn, role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(replace(replace(role, '\', '\s'), '<|', '<\p')) + length(replace(replace(text, '\', '\s'), '<|', '<\p')) + 17) as bigint) as formatted_chars
from turns where conv_id is not null group by conv_id
"""
