"""Conversation prefix trie: shared openings of conversations, and what sharing them saves.

Each distinct sequence of the first d turns (role, text) of some conversation is a node of depth d;
the root is the empty sequence. A node's members are the conversations that start with it, its
conv_id is its smallest member. Per node: its parent's conv_id, members, children, the childless
nodes of its subtree (its leaves, itself included when childless) and the saving of its subtree:
over every node of the subtree, (members - 1) times the UTF-8 bytes of the node's last text.

Method: the Euler-tour technique. Node keys are exact sums, per conversation, of position-tagged
turn hashes (two 62-bit lanes summed in decimal, so a prefix key is a running window sum and a
parent's key is the child's less its last turn). Every node gets an enter and an exit arc; the
successor of an enter arc is the enter arc of the first child (or its own exit arc), the successor
of an exit arc the enter arc of the next sibling (or the parent's exit arc). The tour is ranked by
pointer jumping -- each round joins the arcs to their successors and doubles the stride, one written
table a round, ceil(log2 arcs) + 1 rounds -- carrying suffix sums of the leaf and saving weights
placed on enter arcs. A subtree's figures are the sums at its enter arc less those at its exit arc.
Everything is joins and aggregations; no group of a node's members is gathered, except the ids of
conversations ending at a node for its digest, which is a sequential hash by definition.

``rebuilt`` forms the conversations of the contract: conversation c takes the first h turns of
conversation c - c % 5 and its own turns after its first h, h = crc32(decimal c) % 9.

Defined cases: turns are ordered by turn (null first), then role and text; a null role or text is
empty; rows with a null conv_id belong to no conversation and are left out; a conversation whose
turns all fall to the rebuilt opening of another is still a member (even with no turn it is a
member of the root); equal turns and repeated rows are turns of their own; an empty table gives no
nodes; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sqlloom.operators.joins import lookup
from sqlloom.options import JoinOptions
from sqlloom.sources.scratch import RunScratch

# Fixed values of the contract: conversations are rebuilt from the one at c - c % GROUP, taking
# crc32(decimal c) % OPENING of its turns.
GROUP = 5
OPENING = 9

_LANE = 0x3FFFFFFFFFFFFFFF  # 62 bits: sums of any number of terms stay exact in decimal(38, 0)
_SUM = "decimal(38,0)"


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, idx from 1, role, text), nulls of role and text empty, null conv_ids left out."""
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return turns.withColumn("idx", F.row_number().over(order).cast("long")).drop("turn")


def opening(c: Column) -> Column:
    return (F.crc32(c.cast("string")) % OPENING).cast("long")


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths): turns (c, pos from 1, role, text) of every rebuilt conversation c, and
    (c, length) of every one, turnless ones included."""
    turns = ordered_turns(conversations)
    counts = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"))
    ids = counts.select(F.col("conv_id").alias("c"), F.col("n").alias("n_own"), opening(F.col("conv_id")).alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("b"))
    base = counts.select(F.col("conv_id").alias("b"), F.col("n").alias("n_base"))
    ids = ids.join(base, "b", "left").withColumn("taken", F.least("h", F.coalesce("n_base", F.lit(0))))
    lengths = ids.select("c", (F.col("taken") + F.greatest(F.col("n_own") - F.col("h"), F.lit(0))).alias("length"))
    opened = ids.select("c", "b", "h").join(turns.withColumnRenamed("conv_id", "b"), "b").where(F.col("idx") <= F.col("h"))
    opened = opened.select("c", F.col("idx").alias("pos"), "role", "text")
    own = turns.where(F.col("idx") > opening(F.col("conv_id"))).join(ids.select(F.col("c").alias("conv_id"), "h", "taken"), "conv_id")
    own = own.select(F.col("conv_id").alias("c"), (F.col("taken") + F.col("idx") - F.col("h")).alias("pos"), "role", "text")
    return opened.unionByName(own), lengths


def _lane(*parts: Column) -> Column:
    return F.xxhash64(*parts).bitwiseAND(F.lit(_LANE)).cast(_SUM)


def members(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """(c, depth, k1, k2, p1, p2, last_bytes, ends): one row per conversation and depth 0..length.
    (k1, k2) is the node's key, (p1, p2) its parent's; ``ends`` is true at the conversation's length."""
    term1 = _lane(F.col("pos"), F.col("role"), F.col("text"))
    term2 = _lane(F.col("text"), F.col("role"), F.col("pos"), F.lit("second lane"))
    running = Window.partitionBy("c").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keyed = turns.select("c", "pos", F.octet_length("text").cast("long").alias("last_bytes"), term1.alias("t1"), term2.alias("t2"))
    keyed = keyed.withColumns({"k1": F.sum("t1").over(running), "k2": F.sum("t2").over(running)})
    deep = keyed.select(
        "c", F.col("pos").alias("depth"), "k1", "k2", (F.col("k1") - F.col("t1")).alias("p1"), (F.col("k2") - F.col("t2")).alias("p2"), "last_bytes"
    )
    zero = F.lit(0).cast(_SUM)
    root = lengths.select("c", F.lit(0).cast("long").alias("depth"), zero.alias("k1"), zero.alias("k2"), F.lit(None).cast(_SUM).alias("p1"), F.lit(None).cast(_SUM).alias("p2"), F.lit(0).cast("long").alias("last_bytes"))
    rows = deep.unionByName(root).join(lengths, "c")
    return rows.withColumn("ends", F.col("depth") == F.col("length")).drop("length")


def nodes(rows: DataFrame, scratch: RunScratch, options: JoinOptions) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, last_bytes, ends_sha256."""
    ending = F.array_join(F.array_sort(F.collect_list(F.when(F.col("ends"), F.col("c")))).cast("array<string>"), ",")
    grouped = rows.groupBy("depth", "k1", "k2").agg(
        F.min("c").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.first("p1").alias("p1"),
        F.first("p2").alias("p2"),
        F.first("last_bytes").alias("last_bytes"),
        F.sha2(ending, 256).alias("ends_sha256"),
    )
    grouped = scratch.write(grouped, "nodes")
    parent_key = F.when(F.col("depth") > 0, F.struct((F.col("depth") - 1).alias("d"), F.col("p1").alias("a"), F.col("p2").alias("b")))
    probe = grouped.withColumn("__pkey", parent_key)
    parents = grouped.select(F.struct(F.col("depth").alias("d"), F.col("k1").alias("a"), F.col("k2").alias("b")).alias("__pkey"), F.col("conv_id").alias("parent_conv_id"))
    linked = lookup(probe, parents, "__pkey", spread_by="conv_id", options=options)
    return scratch.write(linked.select("conv_id", "depth", "parent_conv_id", "n_convs", "last_bytes", "ends_sha256"), "linked")


def arcs(tree: DataFrame) -> DataFrame:
    """(id, nxt, leaves, saved, n): the Euler tour's arcs, ids struct(conv_id, depth, exit)."""
    kids = tree.where(F.col("parent_conv_id").isNotNull()).groupBy("parent_conv_id", "depth").agg(
        F.count(F.lit(1)).alias("n_children"), F.min("conv_id").alias("first_child")
    )
    kids = kids.select(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"), "n_children", "first_child")
    siblings = Window.partitionBy("parent_conv_id", "depth").orderBy("conv_id")
    full = tree.join(kids, ["conv_id", "depth"], "left").withColumns(
        {"n_children": F.coalesce("n_children", F.lit(0).cast("long")), "next_sibling": F.when(F.col("depth") > 0, F.lead("conv_id").over(siblings))}
    )

    def arc(conv_id: Column, depth: Column, exit_: bool) -> Column:
        return F.struct(conv_id.alias("conv_id"), depth.alias("depth"), F.lit(exit_).alias("exit"))

    here = (F.col("conv_id"), F.col("depth"))
    enter_next = F.when(F.col("n_children") > 0, arc(F.col("first_child"), F.col("depth") + 1, False)).otherwise(arc(*here, True))
    exit_next = F.when(F.col("next_sibling").isNotNull(), arc(F.col("next_sibling"), F.col("depth"), False)).when(
        F.col("depth") > 0, arc(F.col("parent_conv_id"), F.col("depth") - 1, True)
    )
    saving = (F.col("n_convs") - 1) * F.col("last_bytes")
    enter = full.select(arc(*here, False).alias("id"), enter_next.alias("nxt"), (F.col("n_children") == 0).cast("long").alias("leaves"), saving.alias("saved"), F.lit(1).cast("long").alias("n"))
    leave = full.select(arc(*here, True).alias("id"), exit_next.alias("nxt"), F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("saved"), F.lit(1).cast("long").alias("n"))
    return enter.unionByName(leave), full.select("conv_id", "depth", "n_children")


def rank(tour: DataFrame, scratch: RunScratch) -> DataFrame:
    """Suffix sums of leaves, saved and n from each arc to the end of the tour, by pointer jumping."""
    tour = scratch.write(tour, "tour-0")
    total = tour.count()
    for step in range(1, max(total, 1).bit_length() + 2):
        ahead = tour.select(F.col("id").alias("__at"), F.col("nxt").alias("__nxt"), F.col("leaves").alias("__l"), F.col("saved").alias("__s"), F.col("n").alias("__n"))
        jumped = tour.join(ahead, tour["nxt"] == ahead["__at"], "left").select(
            "id",
            F.col("__nxt").alias("nxt"),
            (F.col("leaves") + F.coalesce("__l", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("__s", F.lit(0))).alias("saved"),
            (F.col("n") + F.coalesce("__n", F.lit(0))).alias("n"),
        )
        tour, previous = scratch.write(jumped, f"tour-{step}"), f"tour-{step - 1}"
        scratch.drop(previous)
    return tour


def prefix_trie(conversations: DataFrame, options: JoinOptions = JoinOptions()) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256, and ``position``, the rank of its enter arc in the tour from 0."""
    scratch = RunScratch(conversations.sparkSession, "prefix-trie")
    turns, lengths = rebuilt(conversations)
    tree = nodes(members(turns, lengths), scratch, options)
    tour, children = arcs(tree)
    ranked = rank(tour, scratch)
    total = ranked.agg(F.max("n")).first()[0] or 0
    enter = ranked.where(~F.col("id.exit")).select(F.col("id.conv_id").alias("conv_id"), F.col("id.depth").alias("depth"), "leaves", "saved", "n")
    leave = ranked.where(F.col("id.exit")).select(F.col("id.conv_id").alias("conv_id"), F.col("id.depth").alias("depth"), F.col("leaves").alias("__l"), F.col("saved").alias("__s"))
    sums = enter.join(leave, ["conv_id", "depth"]).select(
        "conv_id", "depth", (F.col("leaves") - F.col("__l")).alias("n_leaves"), (F.col("saved") - F.col("__s")).alias("saved_tokens"), (F.lit(total) - F.col("n")).alias("position")
    )
    out = tree.join(children, ["conv_id", "depth"]).join(sums, ["conv_id", "depth"])
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "position")
