"""Chat formatting: root-to-leaf paths of reply trees, ranked, formatted and read back.  All native.

Template, for each turn:  <s>[ROLE]role[/ROLE]text</s>
Inside role and text each ``<``, ``[`` and backslash gets a backslash behind it, so no control string of
this template or another of that form (``</s>``, ``[INST]``) stands in escaped text, and the reverse
replacement gives the text back exactly.

Null role and null text count as empty.  A node whose parent is not in its conversation is a root.  A node id that
stands twice in a tree is one node, the row with the smallest parent, role and text; a null node is none.  The
nodes of a reply cycle, and those that answer to one, are on no path.
Conversations may have a null id, which is an id as any other.  Repeated turns of plain conversations are turns of
their own, in the order of role and text.  An empty table gives an empty result.  Further columns, whatever their
names, are not looked at.

No task holds a whole conversation before its chosen paths are formatted: nodes are numbered in cells, and
paths are ranked by leaf, score and nothing else.  A formatted path is one row, so its turns meet in the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, table

OPEN, CLOSE_ROLE, CLOSE = "<s>[ROLE]", "[/ROLE]", "</s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


#: Turns of one conversation that are numbered in one cell, if turns are numbered one by one.
CELL = 4096


def linear_tree(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Plain conversations as reply trees: each turn answers the one before it."""
    nodes = turns.select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).alias("_turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).withColumn("_cell", F.floor(F.col("_turn") / CELL))
    # Cells of a conversation are in the order of its turns; each starts after the cells before it.
    cells = nodes.groupBy("conv", "_cell").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("conv").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = cells.select(F.col("conv").alias("_c"), F.col("_cell").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    order = Window.partitionBy("conv", "_cell").orderBy("_turn", "role", "text")
    placed = nodes.withColumn("_r", F.row_number().over(order)).join(starts, F.col("conv").eqNullSafe(F.col("_c")) & F.col("_cell").eqNullSafe(F.col("_at")))
    node = (F.col("_r") + F.col("_start")).cast("long")
    return placed.select("conv", node.alias("node"), (node - 1).alias("parent"), F.lit(0.0).alias("score"), "role", "text")


def _links(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame], DataFrame]:
    """(leaves, jumps, cyclic): jumps[k] has (conv, node, to, gain) for each node's ancestor 2**k replies up, with the
    sum of the scores from the node to below that; cyclic has the nodes whose replies never end at a root.

    Self-joins that double their reach.  A way up that is as long as its conversation has nodes is in a cycle.
    """
    ids = cut(nodes.select("conv", "node", "parent", F.coalesce("score", F.lit(0.0)).alias("score")), "chat-ids")
    known = ids.select(F.col("conv").alias("c"), F.col("node").alias("p"))
    parents = ids.select(F.col("conv").alias("c"), F.col("parent").alias("p")).distinct()
    leaves = ids.join(parents, ids["conv"].eqNullSafe(parents["c"]) & (ids["node"] == parents["p"]), "left_anti").select("conv", "node", "score")
    now = cut(ids.join(known, ids["conv"].eqNullSafe(known["c"]) & (ids["parent"] == known["p"]), "left_semi").select("conv", "node", F.col("parent").alias("to"), F.col("score").alias("gain")), "chat-jumps")
    longest = ids.groupBy("conv").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    jumps, reach = [], 1
    while reach < longest and not now.isEmpty():
        jumps.append(now)
        step = now.select(F.col("conv").alias("c"), F.col("node").alias("at"), F.col("to").alias("further"), F.col("gain").alias("more"))
        now = cut(now.join(step, now["conv"].eqNullSafe(step["c"]) & (now["to"] == step["at"])).select("conv", "node", F.col("further").alias("to"), (F.col("gain") + F.col("more")).alias("gain")), "chat-jumps")
        reach *= 2
    return leaves, jumps, now.select("conv", "node")


def _trees(nodes: DataFrame) -> DataFrame:
    """One row for each node."""
    row = F.struct("parent", "role", "text", "score")
    return nodes.filter("node is not null").groupBy("conv", "node").agg(F.min(row).alias("x")).select("conv", "node", "x.*")


def ranked_leaves(nodes: DataFrame, best: int | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """(conv, leaf, rank) of the ``best`` root-to-leaf paths of each conversation (all, if None), and the jumps.

    Paths rank by the sum of their scores, then by leaf.  Each leaf climbs to its root by the jumps, from the
    longest to the shortest, so no path is listed for its rank.
    """
    leaves, jumps, cyclic = _links(nodes)
    off = cyclic.select(F.col("conv").alias("c"), F.col("node").alias("n"))
    at = leaves.join(off, leaves["conv"].eqNullSafe(off["c"]) & (leaves["node"] == off["n"]), "left_anti").select("conv", F.col("node").alias("leaf"), F.col("node").alias("at"), F.lit(0.0).alias("total"))
    for k, jump in enumerate(reversed(jumps)):
        step = jump.select(F.col("conv").alias("c"), F.col("node").alias("n"), "to", "gain")
        at = at.join(step, at["conv"].eqNullSafe(step["c"]) & (at["at"] == step["n"]), "left").select("conv", "leaf", F.coalesce("to", "at").alias("at"), (F.col("total") + F.coalesce("gain", F.lit(0.0))).alias("total"))
        if k % 4 == 3:
            at = cut(at, "chat-climb")
    root = nodes.select(F.col("conv").alias("c"), F.col("node").alias("n"), F.coalesce("score", F.lit(0.0)).alias("last"))
    scored = at.join(root, at["conv"].eqNullSafe(root["c"]) & (at["at"] == root["n"])).select("conv", "leaf", (F.col("total") + F.col("last")).alias("score"))
    if best is None:
        return scored.select("conv", "leaf", F.lit(0).alias("rank")), jumps
    rank = F.row_number().over(Window.partitionBy("conv").orderBy(F.desc("score"), "leaf"))
    return scored.withColumn("rank", rank).filter(F.col("rank") <= best).select("conv", "leaf", "rank"), jumps


def _climb(leaves: DataFrame, jumps: list[DataFrame]) -> DataFrame:
    """(conv, leaf, rank, node, up): after step k a path holds its last 2**(k + 1) nodes; up counts from the leaf."""
    paths = cut(leaves.select("conv", "leaf", "rank", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("up")), "chat-paths")
    for k, jump in enumerate(jumps):
        step = jump.select(F.col("conv").alias("c"), F.col("node").alias("at"), "to")
        longer = paths.join(step, paths["conv"].eqNullSafe(step["c"]) & (paths["node"] == step["at"])).select("conv", "leaf", "rank", F.col("to").alias("node"), (F.col("up") + (1 << k)).alias("up"))
        paths = cut(paths.unionByName(longer), "chat-paths")
    return paths


def root_to_leaf_paths(nodes: DataFrame) -> DataFrame:
    """(conv, leaf, node, up): every node of every root-to-leaf path; up counts from the leaf."""
    return _climb(*ranked_leaves(_trees(nodes))).drop("rank")


def format_paths(nodes: DataFrame, best: int = 1) -> DataFrame:
    """conv, leaf, rank, formatted, loss: the ``best`` paths of each conversation.

    Paths rank by the sum of their scores, then by leaf.  loss holds (start, length) of each assistant
    text in ``formatted``, in characters from 1: the loss mask.
    """
    nodes = cut(_trees(nodes), "chat-trees")
    paths = _climb(*ranked_leaves(nodes, best))
    right = nodes.select(F.col("conv").alias("c"), F.col("node").alias("n"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = paths.join(right, paths["conv"].eqNullSafe(right["c"]) & (paths["node"] == right["n"]))
    turn = F.struct((-F.col("up")).alias("at"), escape(F.col("role")).alias("role"), escape(F.col("text")).alias("text"))
    chosen = rows.groupBy("conv", "leaf", "rank").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    piece = f"concat('{OPEN}', t.role, '{CLOSE_ROLE}', t.text, '{CLOSE}')"
    head, tail = len(OPEN) + len(CLOSE_ROLE), len(CLOSE)
    # Only assistant turns are lost on; starts are running sums of the lengths of the turns before.
    spans = f"""aggregate(turns, named_struct('at', 1L, 'out', cast(array() as array<struct<start: bigint, length: bigint>>)),
        (s, t) -> named_struct('at', s.at + {head + tail} + length(t.role) + length(t.text),
            'out', if(t.role = 'assistant', concat(s.out, array(named_struct('start', s.at + {head} + length(t.role), 'length', cast(length(t.text) as bigint)))), s.out)),
        s -> s.out)"""
    return chosen.select("conv", "leaf", "rank", F.expr(f"array_join(transform(turns, t -> {piece}), '')").alias("formatted"), F.expr(spans).alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv, turns (role and text as they were), loss_text, formatted: from the formatted string and mask alone."""
    turns = f"transform(slice(split(formatted, '{CLOSE}', -1), 1, size(split(formatted, '{CLOSE}', -1)) - 1), x -> split(substring(x, {len(OPEN) + 1}), '\\\\[/ROLE\\\\]', 2))"
    raw = formatted.select("conv", "formatted", F.expr(turns).alias("raw"), F.expr("transform(loss, s -> substring(formatted, cast(s.start as int), cast(s.length as int)))").alias("lost"))
    return raw.select(
        "conv",
        "formatted",
        F.transform("raw", lambda t: F.struct(unescape(t[0]).alias("role"), unescape(t[1]).alias("text"))).alias("turns"),
        F.array_join(F.transform("lost", unescape), "").alias("loss_text"),
    )


#: The conversation that the contract adds: both turns are made of control strings.
PROBE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op2_chat_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(c).cast("long").alias("conv_id"), F.lit(t).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(x).alias("text")) for c, t, r, x in PROBE])).alias("x")).select("x.*")
    back = read_back(format_paths(cut(linear_tree(turns.unionByName(probe)), "chat-nodes")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        F.col("conv").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), t AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS lost,
         sum(20 + length(regexp_replace(role, '([<\[\\])', '\1\\', 'g')) + length(regexp_replace(text, '([<\[\\])', '\1\\', 'g'))) AS formatted_chars
  FROM c GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(lost) AS BIGINT) AS loss_chars,
       sha256(lost) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM t
"""
