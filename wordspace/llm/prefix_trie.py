"""Conversation prefix trie by fixed-length block hashing.

Method. Turns are replaced by 128-bit digests and numbered; every ``BLOCK``
consecutive turns of a conversation form a block with a digest of its own, and
running digests of whole blocks name the prefixes that end at block borders.
Conversations are grouped by these first: all that share the blocks before a
block and have the same next one get the block's turn nodes at once, as a chain
without branches. Only inside blocks where such siblings diverge (different
digests, or one of them ends earlier) are turns grouped one by one.

A running digest is the exclusive-or of position-keyed digests, so it needs no
order of evaluation: it is summed in stretches of ``STRETCH`` positions, whose
totals give the offsets. No conversation, however long, is one group.

Subtrees. A node is named by its smallest member and its depth, so the nodes of
one conversation that carry its id form a path, which hangs on a node of another
path. Totals of whole paths go up this tree of paths by pointer jumping (rounds:
the logarithm of its height), and a node's subtree is the rest of its path from
its depth on with all that hangs there.

The digest of a node's ending conversations is read in one sorted stream: SHA-256
is sequential, so a node's ids pass through one task, one at a time and never
held together.

Defined results: turns are ordered by ``turn`` (null first), equal turns by the
SHA-256 of their role and text, so repeated rows are turns of their own; null
role or text is empty;
rows with a null ``conv_id`` belong to no conversation and are left out; extra
columns are ignored; an empty table has no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

BLOCK = 4  # turns of a block
STRETCH = 1 << 14  # positions that are numbered or summed in one group
HEAD = 6  # shared heads have less than this many turns
FAMILY = 100  # conversations c and c - c % FAMILY share a head


def _xor(name: str) -> Column:
    return F.expr(f"bit_xor({name})")


def _keyed(*cols) -> list[Column]:
    """Two 64-bit digests of a position and digests."""
    return [F.xxhash64(F.lit(0x5EED0001), *cols), F.xxhash64(F.lit(0x5EED0002), *cols[::-1])]


def _offsets(rows: DataFrame, by: str, stretch: Column, totals: dict[str, Column], descending: bool = False) -> DataFrame:
    """Per (``by``, stretch): what the stretches before it (after it, if
    ``descending``) come to, for each total (name -> aggregate)."""
    each = rows.groupBy(by, stretch.alias("_stretch")).agg(*[v.alias(k) for k, v in totals.items()])
    order = F.desc("_stretch") if descending else F.asc_nulls_first("_stretch")
    before = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    again = lambda k: _xor(k) if k.startswith("x") else F.sum(k)
    return each.select(F.col(by).alias("_by"), F.col("_stretch").alias("_at"), *[F.coalesce(again(k).over(before), F.lit(0)).cast("long").alias(f"_before_{k}") for k in totals])


def _with_offsets(rows: DataFrame, offsets: DataFrame, by: str) -> DataFrame:
    return rows.join(offsets, (F.col(by) == F.col("_by")) & F.col("_stretch").eqNullSafe(F.col("_at"))).drop("_by", "_at")


# ---- turns ---------------------------------------------------------------------
def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, d1, d2, chars): every turn with its place from 0."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    half = lambda at: F.conv(F.substring(digest, at, 16), 16, -10).cast("long")
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), half(1).alias("d1"), half(17).alias("d2"),
        F.length(text).cast("long").alias("chars"),
    )
    stretch = F.floor(F.col("turn") / F.lit(STRETCH)).cast("long")
    offsets = _offsets(rows, "conv", stretch, {"n": F.count(F.lit(1))})
    unsigned = [F.col(d).bitwiseXOR(F.lit(-(1 << 63))) for d in ("d1", "d2")]
    order = Window.partitionBy("conv", "_stretch").orderBy(F.asc_nulls_first("turn"), *unsigned)
    rows = rows.withColumn("_stretch", stretch).withColumn("_row", F.row_number().over(order))
    return _with_offsets(rows, offsets, "conv").select("conv", (F.col("_before_n") + F.col("_row") - 1).alias("pos"), "d1", "d2", "chars")


def rebuilt(turns: DataFrame, head: int = HEAD, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """The turns of every rebuilt conversation (with ``last``, true for the one
    that ends it), and all conversations with their lengths."""
    known = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    known = known.withColumn("h", F.crc32(F.col("conv").cast("string").cast("binary")) % head).withColumn("base", F.col("conv") - F.col("conv") % family)
    tops = known.filter("conv = base").select(F.col("conv").alias("_base"), F.col("own").alias("base_own"))
    convs = known.join(tops, F.col("base") == F.col("_base"), "left").drop("_base")
    convs = convs.withColumn("taken", F.least("h", F.coalesce("base_own", F.lit(0)))).withColumn("n", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0)))
    convs = materialize(convs.select("conv", "base", "h", "taken", "n"))
    pos = (F.col("pos") - F.col("h") + F.col("taken")).alias("pos")
    own = turns.join(convs, "conv").filter("pos >= h").select("conv", pos, "d1", "d2", "chars", "n")
    heads = turns.filter((F.col("conv") % family == 0) & (F.col("pos") < head - 1)).withColumnRenamed("conv", "base")
    given = convs.join(heads, "base").filter("pos < h").select("conv", "pos", "d1", "d2", "chars", "n")
    both = own.unionByName(given)
    return both.select("conv", "pos", "d1", "d2", "chars", (F.col("pos") == F.col("n") - 1).alias("last")), convs.select("conv", "n")


# ---- blocks --------------------------------------------------------------------
def blocks(turns: DataFrame, size: int = BLOCK) -> DataFrame:
    """(conv, blk, n, last, q1, q2, p1, p2): every block with the running digests
    before it and with it."""
    blk, at = F.floor(F.col("pos") / size).cast("long"), (F.col("pos") % size)
    a, b = _keyed(at, F.col("d1"), F.col("d2"))
    each = turns.select("conv", blk.alias("blk"), "last", a.alias("a"), b.alias("b"))
    each = each.groupBy("conv", "blk").agg(F.count(F.lit(1)).alias("n"), F.max("last").alias("last"), _xor("a").alias("a"), _xor("b").alias("b"))
    a, b = _keyed(F.col("blk"), F.col("n"), F.col("a"), F.col("b"))
    each = materialize(each.select("conv", "blk", "n", "last", a.alias("a"), b.alias("b")))
    stretch = F.floor(F.col("blk") / STRETCH).cast("long")
    offsets = _offsets(each, "conv", stretch, {"x1": _xor("a"), "x2": _xor("b")})
    inside = Window.partitionBy("conv", "_stretch").orderBy("blk").rowsBetween(Window.unboundedPreceding, 0)
    run = each.withColumn("_stretch", stretch).withColumn("x1", _xor("a").over(inside)).withColumn("x2", _xor("b").over(inside))
    run = _with_offsets(run, offsets, "conv")
    p1, p2 = F.col("x1").bitwiseXOR(F.col("_before_x1")), F.col("x2").bitwiseXOR(F.col("_before_x2"))
    return run.select("conv", "blk", "n", "last", p1.bitwiseXOR(F.col("a")).alias("q1"), p2.bitwiseXOR(F.col("b")).alias("q2"), p1.alias("p1"), p2.alias("p2"))


def nodes(turns: DataFrame, convs: DataFrame, size: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, parent, n_convs, chars) of every node but the root, and
    (conv, depth, member) for every conversation that ends at a node but it."""
    cut = materialize(blocks(turns, size))
    group = ["blk", "q1", "q2"]
    same = F.struct("n", "p1", "p2")
    groups = cut.groupBy(*group).agg(F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.min(same).alias("low"), F.max(same).alias("high"))
    # what holds the prefix at the border before a block: its smallest member
    border = cut.filter(F.col("n") == size).groupBy((F.col("blk") + 1).alias("blk"), F.col("p1").alias("q1"), F.col("p2").alias("q2")).agg(F.min("conv").alias("above"))
    top = convs.agg(F.min("conv").alias("top"))  # one row
    groups = groups.join(border, group, "left").join(F.broadcast(top), how="cross")
    groups = materialize(groups.select(*group, "rep", "n_convs", F.coalesce("above", "top").alias("above"), (F.col("low") == F.col("high")).alias("alike")))
    placed = turns.withColumn("blk", F.floor(F.col("pos") / size).cast("long")).withColumn("j", F.col("pos") % size)

    # siblings alike: the block's turns are a chain
    alike = groups.filter("alike")
    chain = placed.join(alike.withColumnRenamed("rep", "conv"), ["conv", "blk"])
    parent = F.when(F.col("j") == 0, F.col("above")).otherwise(F.col("conv"))
    chain = chain.select("conv", (F.col("pos") + 1).alias("depth"), parent.alias("parent"), "n_convs", "chars")
    chain_ends = cut.filter("last").join(alike.select(*group, "rep"), group).select(F.col("rep").alias("conv"), (F.col("blk") * size + F.col("n")).alias("depth"), F.col("conv").alias("member"))

    # siblings that diverge: turns one by one
    apart = groups.filter("NOT alike").select(*group, "above")
    inside = cut.select("conv", *group).join(apart, group).join(placed, ["conv", "blk"])
    a, b = _keyed(F.col("j"), F.col("d1"), F.col("d2"))
    inside = inside.withColumn("a", a).withColumn("b", b)
    so_far = Window.partitionBy("conv", "blk").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    inside = inside.withColumn("r1", _xor("a").over(so_far)).withColumn("r2", _xor("b").over(so_far))
    inside = inside.withColumn("o1", F.col("r1").bitwiseXOR(F.col("a"))).withColumn("o2", F.col("r2").bitwiseXOR(F.col("b")))
    inside = materialize(inside.select("conv", *group, "above", "j", "pos", "chars", "last", "r1", "r2", "o1", "o2"))
    found = inside.groupBy(*group, "j", "r1", "r2").agg(
        F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs"), F.max("chars").alias("chars"), F.first("above").alias("above"), F.first("o1").alias("o1"), F.first("o2").alias("o2")
    )
    found = materialize(found)
    over = found.select(*group, (F.col("j") + 1).alias("j"), F.col("r1").alias("o1"), F.col("r2").alias("o2"), F.col("conv").alias("up"))
    fine = found.join(over, [*group, "j", "o1", "o2"], "left").select("conv", (F.col("blk") * size + F.col("j") + 1).alias("depth"), F.when(F.col("j") == 0, F.col("above")).otherwise(F.col("up")).alias("parent"), "n_convs", "chars")
    owner = found.select(*group, "j", "r1", "r2", F.col("conv").alias("owner"))
    fine_ends = inside.filter("last").join(owner, [*group, "j", "r1", "r2"]).select(F.col("owner").alias("conv"), (F.col("pos") + 1).alias("depth"), F.col("conv").alias("member"))
    return chain.unionByName(fine), chain_ends.unionByName(fine_ends)


# ---- subtrees ------------------------------------------------------------------
def subtree_sums(tree: DataFrame) -> DataFrame:
    """(conv, depth, n_children, n_leaves, saved_tokens) of every node of
    ``tree`` (conv, depth, parent, weight), the root included."""
    children = tree.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    tree = tree.join(children, ["conv", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    tree = materialize(tree.withColumn("leaf", (F.col("n_children") == 0).cast("long")))
    own = tree.groupBy("conv").agg(F.sum("leaf").alias("leaf"), F.sum("weight").alias("weight"))
    hangs = tree.filter("parent IS NOT NULL AND parent <> conv").select("conv", F.col("parent").alias("on"), (F.col("depth") - 1).alias("at"))
    hangs = materialize(hangs)
    # pointer jumping: a path's sums hold all paths less than 2**round below it
    paths = materialize(own.join(hangs.select("conv", F.col("on").alias("up")), "conv", "left"))
    while not (moving := paths.filter("up IS NOT NULL")).isEmpty():
        gained = moving.groupBy(F.col("up").alias("conv")).agg(F.sum("leaf").alias("more_leaf"), F.sum("weight").alias("more_weight"))
        above = moving.select(F.col("conv").alias("up"), F.col("up").alias("next"))
        paths = paths.join(gained, "conv", "left").join(above, "up", "left")
        total = lambda c: (F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c)
        paths = materialize(paths.select("conv", total("leaf"), total("weight"), F.col("next").alias("up")))
    hung = hangs.join(paths.select("conv", "leaf", "weight"), "conv").groupBy(F.col("on").alias("conv"), F.col("at").alias("depth")).agg(F.sum("leaf").alias("hung_leaf"), F.sum("weight").alias("hung_weight"))
    full = tree.join(hung, ["conv", "depth"], "left")
    add = lambda c: (F.col(c) + F.coalesce(f"hung_{c}", F.lit(0))).alias(c)
    full = materialize(full.select("conv", "depth", "n_children", add("leaf"), add("weight")))
    stretch = F.floor(F.col("depth") / STRETCH).cast("long")
    offsets = _offsets(full, "conv", stretch, {"leaf": F.sum("leaf"), "weight": F.sum("weight")}, descending=True)
    below = Window.partitionBy("conv", "_stretch").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    run = full.withColumn("_stretch", stretch).withColumn("leaf", F.sum("leaf").over(below)).withColumn("weight", F.sum("weight").over(below))
    run = _with_offsets(run, offsets, "conv")
    return run.select("conv", "depth", "n_children", (F.col("leaf") + F.col("_before_leaf")).alias("n_leaves"), (F.col("weight") + F.col("_before_weight")).alias("saved_tokens"))


def ends_digests(ends: DataFrame) -> DataFrame:
    """(conv, depth, ends_sha256) of every node at which conversations end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done: list[tuple] = []
            conv, depth, member = (batch.column(i).to_numpy() for i in range(3))
            cuts = np.flatnonzero((conv[1:] != conv[:-1]) | (depth[1:] != depth[:-1])) + 1 if len(conv) else []
            bounds = [0, *cuts, len(conv)] if len(conv) else []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                key = (int(conv[a]), int(depth[a]))
                text = ",".join(map(str, member[a:b].tolist())).encode()
                if key != now:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = key, hashlib.sha256(text)
                else:
                    state.update(b"," + text)
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.int64()), pa.array([x[1] for x in done], pa.int64()), pa.array([x[2] for x in done], pa.string())], names=["conv", "depth", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now[0]], pa.int64()), pa.array([now[1]], pa.int64()), pa.array([state.hexdigest()])], names=["conv", "depth", "ends_sha256"])

    return ends.repartition("conv", "depth").sortWithinPartitions("conv", "depth", "member").mapInArrow(run, "conv long, depth long, ends_sha256 string")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations."""
    turns, convs = rebuilt(materialize(numbered_turns(conversations)))
    turns = materialize(turns)
    found, ends = nodes(turns, convs)
    top = convs.agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    root = top.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent"), "n_convs", F.lit(0).cast("long").alias("chars"))
    tree = materialize(root.unionByName(found.select("conv", "depth", "parent", "n_convs", "chars")))
    empty = convs.filter("n = 0").join(F.broadcast(top.select(F.col("conv").alias("top"))), how="cross").select(F.col("top").alias("conv"), F.lit(0).cast("long").alias("depth"), F.col("conv").alias("member"))
    digests = ends_digests(ends.unionByName(empty))
    sums = subtree_sums(tree.select("conv", "depth", "parent", ((F.col("n_convs") - 1) * F.col("chars")).alias("weight")))
    out = tree.join(sums, ["conv", "depth"]).join(digests, ["conv", "depth"], "left")
    return out.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def prefix_trie_sql() -> str:
    """The same rows in DuckDB."""
    crc = "list_reduce(list_prepend(4294967295::BIGINT, [ord(x)::BIGINT for x in string_split(CAST(conv_id AS VARCHAR), '')]), lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), list_value(0::BIGINT, 0, 0, 0, 0, 0, 0, 0)), lambda v, z: xor(v >> 1, 3988292384::BIGINT * (v & 1))))"
    return f"""
        WITH o AS (
            SELECT CAST(conv_id AS BIGINT) AS conv_id,
                   list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS own
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1
        ), h AS (SELECT conv_id, own, xor({crc}, 4294967295::BIGINT) % {HEAD} AS h FROM o),
        c AS (
            SELECT h.conv_id, list_concat(coalesce(b.own[1:h.h], []), h.own[h.h + 1:]) AS turns
            FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % {FAMILY}
        ), p AS (
            SELECT conv_id, len(turns) AS n, d AS depth, sha256(CAST(to_json(turns[1:d]) AS VARCHAR)) AS node,
                   CASE WHEN d > 0 THEN sha256(CAST(to_json(turns[1:d - 1]) AS VARCHAR)) END AS parent,
                   CASE WHEN d > 0 THEN length(turns[d].t) ELSE 0 END AS chars
            FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM c)
        ), g AS (
            SELECT depth, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
                   sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256
            FROM p GROUP BY depth, node
        ), k AS (
            SELECT g.*, up.conv_id AS parent_conv_id, (SELECT count(*) FROM g x WHERE x.depth = g.depth + 1 AND x.parent = g.node) AS n_children
            FROM g LEFT JOIN g up ON up.depth = g.depth - 1 AND up.node = g.parent
        ), s AS (
            SELECT a.depth, a.node, count(*) FILTER (k.n_children = 0) AS n_leaves, CAST(sum((k.n_convs - 1) * k.chars) AS BIGINT) AS saved_tokens
            FROM k JOIN p ON p.conv_id = k.conv_id AND p.depth <= k.depth JOIN g a ON a.depth = p.depth AND a.node = p.node
            GROUP BY a.depth, a.node
        )
        SELECT k.conv_id, k.depth, k.parent_conv_id, k.n_convs, k.n_children, s.n_leaves, s.saved_tokens, k.ends_sha256
        FROM k JOIN s USING (depth, node)
    """
