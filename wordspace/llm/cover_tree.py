"""Embedding near-duplicates by dual traversal of cover trees.

Method. Equal vectors are one point with a weight. Points, scaled to length one,
are dealt to cells around centres (the top level, chosen by farthest-first
traversal of a bounded sample) and a cell's points to chunks of about
``CHUNK`` points. Every chunk becomes one cover tree: a node covers its points
from one of them, and its children are a net of half its radius, the node's own
centre first (nested levels with halving radii). Each node keeps its true
covering radius.

Two trees (or a tree and itself) are traversed together from their roots. With
distance d between two centres and radii a and b, a pair of nodes with
``d > a + b + t`` has no linked pair and goes; one with ``d + a + b <= t`` has
only linked pairs, which are counted and joined without being listed; otherwise
the children, or the points of two leaves, are looked at. ``t`` is the chord of
the threshold, and a margin far above rounding keeps both bounds safe; points
are compared by their cosine in double precision. So the links are exact, and a
group of near copies costs about one comparison of nodes.

On the cluster, pairs of cells that the same bound cannot exclude are expanded to
pairs of chunks. The trees are written once, and each task reads two groups of them
from there (a Cartesian product with a condition) and takes one pair after the other:
no tree is copied by a shuffle, which bounds the disk, and a task holds a few trees.
What leaves a group are link counts per point and a spanning forest. Where the
data have no structure at this radius the bound excludes little and all chunks
meet, as for any exact search.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing, and vectors of different lengths do not link. Rows
count one by one, so a repeated row links with its twin; rows with one id and
different vectors stay apart. A null id has links like any other, is never named
as a component (null, if no member has an id) and is kept only if its component
is null. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import drop_path, materialize, scratch_path, written
from .components import components

CHUNK = 8192  # points of a chunk: of 8 bytes a component
SAMPLE = 2048  # points among which cell centres are chosen
CELLS = 256  # at most; beyond that cells have several chunks
LEAF = 48
EPS = 1e-6  # far above the rounding of distances, also near zero
BATCH = 256
EDGES = 1 << 18
GATHER = 1 << 15  # point pairs of small leaves that are compared at a time
GROUPS = 16  # groups of trees: any two of them are one task
GROUP_TREES = 8  # more groups beyond that many trees in each
BATCH_BYTES = 1 << 25  # trees sent to a task's Python at a time
AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch"

_POINTS = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("far", T.DoubleType()), T.StructField("node", T.LongType()), T.StructField("size", T.LongType()), T.StructField("unit", T.ArrayType(T.DoubleType()))])
_TREE = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("chunk", T.LongType()), T.StructField("nodes", T.BinaryType()), T.StructField("points", T.BinaryType()), T.StructField("unit", T.BinaryType())])
_FOUND = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("links", T.LongType())])

_NODE = np.dtype([("lo", "<i8"), ("hi", "<i8"), ("center", "<i8"), ("first", "<i8"), ("last", "<i8"), ("radius", "<f8")])
_POINT = np.dtype([("node", "<i8"), ("size", "<i8")])


class CoverTree:
    """``unit`` (points, in the order of the leaves), ``ids`` and ``size`` of the
    points and ``nodes``: each with its points ``lo:hi``, its centre and its
    children ``first:last``."""

    def __init__(self, unit: np.ndarray, ids: np.ndarray, size: np.ndarray, nodes: np.ndarray):
        self.unit, self.ids, self.size, self.nodes = unit, ids, size, nodes
        self.before = np.concatenate([[0], np.cumsum(size)])

    def weight(self, i: int) -> int:
        return int(self.before[self.nodes["hi"][i]] - self.before[self.nodes["lo"][i]])

    def leaf(self, i: int) -> bool:
        return self.nodes["first"][i] == self.nodes["last"][i]


def distance(cosine: np.ndarray) -> np.ndarray:
    """Angle between points of length one."""
    return np.arccos(np.clip(cosine, -1.0, 1.0))


def _net(unit: np.ndarray, members: np.ndarray, radius: float) -> list[np.ndarray]:
    """A greedy net: each part holds what lies within ``radius`` of its first
    member and of no earlier one."""
    parts, rest = [], members
    while len(rest):
        some = rest[:BATCH]
        near = distance(unit[rest] @ unit[some].T) <= radius
        among, taken, centers = near[: len(some)], np.zeros(len(some), bool), []
        for k in range(len(some)):
            if not taken[k]:
                centers.append(k)
                taken |= among[:, k]
                taken[k] = True
        near = near[:, centers]
        near[centers, np.arange(len(centers))] = True  # a centre covers itself, whatever the rounding
        covered, nearest = near.any(axis=1), near.argmax(axis=1)
        nearest[centers] = np.arange(len(centers))
        mine, of = rest[covered], nearest[covered]
        order = np.lexsort((mine != some[centers][of], of))  # the centre first
        cuts = np.flatnonzero(np.diff(of[order])) + 1
        parts += np.split(mine[order], cuts)
        rest = rest[~covered]
    return parts


def build(unit: np.ndarray, ids: np.ndarray, size: np.ndarray) -> CoverTree:
    """The cover tree of a chunk's points."""
    order = np.argsort(ids, kind="stable")
    unit, ids, size = unit[order], ids[order], size[order]
    members: list[np.ndarray] = [np.arange(len(ids))]
    spread = lambda m: float(distance(unit[m] @ unit[m[0]]).max())
    rows = [[0, len(ids), 0, 0, 0, spread(members[0])]]
    levels, at = [np.pi], 0
    while at < len(rows):
        lo, hi, _, _, _, radius = rows[at]
        level = levels[at]
        if hi - lo > LEAF and radius > EPS:
            while level / 2 >= radius:
                level /= 2
            first, start = len(rows), lo
            for part in _net(unit, members[at], level / 2):
                rows.append([start, start + len(part), 0, 0, 0, spread(part) if len(part) > 1 else 0.0])
                members.append(part)
                levels.append(level / 2)
                start += len(part)
            rows[at][3:5] = [first, len(rows)]
        at += 1
    # points in the order of the leaves, so that every node has a run of them
    place = np.empty(len(ids), np.int64)
    for row, m in zip(rows, members, strict=True):
        if row[3] == row[4]:
            place[row[0] : row[1]] = m
    where = np.empty(len(ids), np.int64)
    where[place] = np.arange(len(ids))
    nodes = np.zeros(len(rows), _NODE)
    for i, name in enumerate(("lo", "hi", "center", "first", "last", "radius")):
        nodes[name] = [r[i] for r in rows]
    nodes["center"] = where[[m[0] for m in members]]
    return CoverTree(unit[place], ids[place], size[place], nodes)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links (a, b): every node but its component's
    smallest with that one."""
    names, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = flat[: len(a)], flat[len(a) :]
    low = np.arange(len(names))
    while True:
        least = np.minimum(low[u], low[v])
        new = low.copy()
        np.minimum.at(new, low[u], least)
        np.minimum.at(new, low[v], least)
        new = new[new]
        while not np.array_equal(jump := new[new], new):
            new = jump
        if (new[u] == new[v]).all():
            break
        low = new
    moved = np.flatnonzero(new != np.arange(len(names)))
    return names[moved], names[new[moved]]


class DualTraversal:
    """Links between the points of two trees (or within one): ``count_a`` and
    ``count_b`` hold the linked weight of every point, ``links`` a spanning
    forest."""

    def __init__(self, a: CoverTree, b: CoverTree, cosine: float):
        self.a, self.b, self.same = a, b, a is b
        self.least, self.reach = cosine, float(distance(np.float64(cosine)))
        self.count_a, self.count_b = np.zeros(len(a.ids) + 1, np.int64), np.zeros(len(b.ids) + 1, np.int64)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.held, self.compared = 0, 0
        self.whole_a, self.whole_b = set(), set()
        self.small: list[tuple[np.ndarray, np.ndarray]] = []
        self.waiting = 0
        self.run()
        self._small_leaves()
        # the counts of runs are kept as differences
        self.count_a = np.cumsum(self.count_a[:-1])
        self.count_b = self.count_a if self.same else np.cumsum(self.count_b[:-1])

    def _link(self, a: np.ndarray, b: np.ndarray) -> None:
        self.edges.append((a, b))
        self.held += len(a)
        if self.held > EDGES:
            got = self.links()
            self.edges, self.held = [got], len(got[0])

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.edges:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return forest(np.concatenate([e[0] for e in self.edges]), np.concatenate([e[1] for e in self.edges]))

    def _all_linked(self, i: int, j: int) -> None:
        """Every point of node i with every point of node j."""
        a, b = self.a, self.b
        sides = [(a, i, self.count_a, b.weight(j))]
        if not (self.same and i == j):
            sides.append((b, j, self.count_a if self.same else self.count_b, a.weight(i)))
        for tree, k, counts, weight in sides:
            counts[tree.nodes["lo"][k]] += weight
            counts[tree.nodes["hi"][k]] -= weight
        self._link(a.ids[[a.nodes["center"][i]]], b.ids[[b.nodes["center"][j]]])
        for tree, k, seen in ((a, i, self.whole_a), (b, j, self.whole_a if self.same else self.whole_b)):
            if k not in seen:  # all of its points have a link to one point, so they are connected
                seen.add(k)
                ids = tree.ids[tree.nodes["lo"][k] : tree.nodes["hi"][k]]
                self._link(ids, np.full(len(ids), tree.ids[tree.nodes["center"][k]]))

    def _points(self, i: int, j: int) -> None:
        """The points of two leaves, compared one by one."""
        a, b = self.a, self.b
        al, ah, bl, bh = a.nodes["lo"][i], a.nodes["hi"][i], b.nodes["lo"][j], b.nodes["hi"][j]
        linked = a.unit[al:ah] @ b.unit[bl:bh].T >= self.least
        self.compared += linked.size
        if self.same and i == j:
            np.fill_diagonal(linked, True)
        x, y = np.nonzero(linked)
        if not len(x):
            return
        per_a = linked @ b.size[bl:bh]
        self.count_a[al:ah] += per_a
        self.count_a[al + 1 : ah + 1] -= per_a
        if not (self.same and i == j):
            per_b = linked.T @ a.size[al:ah]
            counts = self.count_a if self.same else self.count_b
            counts[bl:bh] += per_b
            counts[bl + 1 : bh + 1] -= per_b
        self._link(a.ids[al + x], b.ids[bl + y])

    def _small_leaves(self) -> None:
        """The points of small leaves that wait, all at once."""
        if not self.waiting:
            return
        a, b = self.a, self.b
        i, j = (np.concatenate(x) for x in zip(*self.small, strict=True))
        self.small, self.waiting = [], 0
        wide = b.nodes["hi"][j] - b.nodes["lo"][j]
        size = (a.nodes["hi"][i] - a.nodes["lo"][i]) * wide
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        wide = np.repeat(wide, size)
        x, y = np.repeat(a.nodes["lo"][i], size) + at // wide, np.repeat(b.nodes["lo"][j], size) + at % wide
        for k in range(0, len(x), GATHER):
            u, v = x[k : k + GATHER], y[k : k + GATHER]
            linked = np.einsum("ij,ij->i", a.unit[u], b.unit[v]) >= self.least
            u, v = u[linked], v[linked]
            counts = self.count_a if self.same else self.count_b
            for table, at, weight in ((self.count_a, u, b.size[v]), (counts, v, a.size[u])):
                np.add.at(table, at, weight)
                np.subtract.at(table, at + 1, weight)
            self._link(a.ids[u], b.ids[v])
        self.compared += len(x)

    def run(self) -> None:
        a, b = self.a, self.b
        leaf_a, leaf_b = a.nodes["first"] == a.nodes["last"], b.nodes["first"] == b.nodes["last"]
        size_a, size_b = a.nodes["hi"] - a.nodes["lo"], b.nodes["hi"] - b.nodes["lo"]
        todo: list[tuple[int, int]] = []
        i, j = np.zeros(1, np.int64), np.zeros(1, np.int64)
        d = distance(a.unit[a.nodes["center"][i]] @ b.unit[b.nodes["center"][0]])
        while True:
            own = (i == j) if self.same else np.zeros(len(i), bool)
            whole = np.where(own, 2 * a.nodes["radius"][i], d + a.nodes["radius"][i] + b.nodes["radius"][j]) <= self.reach - EPS
            for x, y in zip(i[whole].tolist(), j[whole].tolist(), strict=True):
                self._all_linked(x, y)
            i, j, own = i[~whole], j[~whole], own[~whole]
            ends = leaf_a[i] & leaf_b[j]
            small = ends & ~own & (size_a[i] * size_b[j] <= LEAF)
            if small.any():
                self.small.append((i[small], j[small]))
                self.waiting += int((size_a[i[small]] * size_b[j[small]]).sum())
                if self.waiting > EDGES:
                    self._small_leaves()
            for x, y in zip(i[ends & ~small].tolist(), j[ends & ~small].tolist(), strict=True):
                self._points(x, y)
            todo += zip(i[~ends].tolist(), j[~ends].tolist(), strict=True)
            if not todo:
                return
            i, j, d = self._children(*todo.pop())

    def _children(self, i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of children (a leaf stands for itself) that the bound leaves,
        and the distances of their centres."""
        a, b = self.a, self.b
        left = np.array([i]) if a.leaf(i) else np.arange(a.nodes["first"][i], a.nodes["last"][i])
        right = np.array([j]) if b.leaf(j) else np.arange(b.nodes["first"][j], b.nodes["last"][j])
        other, found = b.unit[b.nodes["center"][right]], []
        far = b.nodes["radius"][right] + (self.reach + EPS)
        for at in range(0, len(left), BATCH):
            some = left[at : at + BATCH]
            cosine = a.unit[a.nodes["center"][some]] @ other.T
            self.compared += cosine.size
            # distance <= radius + far, as a bound of the cosine
            near = a.nodes["radius"][some]
            bound = np.outer(np.cos(near), np.cos(far))
            bound -= np.outer(np.sin(near), np.sin(far))
            keep = cosine >= bound
            if near.max() + far.max() >= np.pi:
                keep |= near[:, None] + far[None, :] >= np.pi
            if self.same and i == j:
                keep &= some[:, None] <= right[None, :]
            x, y = np.nonzero(keep)
            found.append((some[x], right[y], distance(cosine[x, y])))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


# ---- Spark -----------------------------------------------------------------------
def _lists(column: pa.Array) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def farthest_first(unit: np.ndarray, k: int) -> np.ndarray:
    """k of the points: each the farthest from those before it."""
    chosen, best = [0], unit @ unit[0]
    while len(chosen) < min(k, len(unit)):
        far = int(best.argmin())
        if best[far] >= 1.0 - EPS:
            break
        chosen.append(far)
        best = np.maximum(best, unit @ unit[far])
    return unit[chosen]


def _dealt(points: DataFrame, centers: np.ndarray) -> DataFrame:
    """Points with their nearest centre and their distance from it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                cosine = _lists(batch.column(2)) @ centers.T
                cell = cosine.argmax(axis=1).astype(np.int32)
                far = distance(cosine[np.arange(len(cell)), cell])
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(far), *batch.columns], names=_POINTS.names)

    return points.select("node", "size", "unit").mapInArrow(run, _POINTS)


def _trees(placed: DataFrame) -> DataFrame:
    def one(table: pa.Table) -> pa.Table:
        tree = build(_lists(table.column("unit")), table.column("node").to_numpy(), table.column("size").to_numpy())
        points = np.empty(len(tree.ids), _POINT)
        points["node"], points["size"] = tree.ids, tree.size
        return pa.table({"cell": table.column("cell")[:1], "chunk": table.column("chunk")[:1], "nodes": [tree.nodes.tobytes()], "points": [points.tobytes()], "unit": [tree.unit.tobytes()]})

    return placed.groupBy("cell", "chunk").applyInArrow(one, _TREE)


def _tree(batch: pa.RecordBatch, row: int, side: str) -> CoverTree:
    nodes, points, unit = (batch.column(batch.schema.get_field_index(f"{c}_{side}"))[row].as_buffer() for c in ("nodes", "points", "unit"))
    points = np.frombuffer(points, _POINT)
    return CoverTree(np.frombuffer(unit, np.float64).reshape(len(points), -1), points["node"], points["size"], np.frombuffer(nodes, _NODE))


def _links_of(spark: SparkSession, points: DataFrame, cosine: float, chunk: int, sample: int) -> DataFrame:
    """(a, b, links): link counts of points (b null) and links that connect
    them (links null)."""
    n = points.count()
    picked = points.orderBy(F.xxhash64("unit"), "node").limit(sample).select("unit").collect()  # ``sample`` rows
    centers = farthest_first(np.array([r[0] for r in picked], np.float64), max(1, min(CELLS, -(-2 * n // chunk))))
    paths = [scratch_path(spark, name) for name in ("dealt", "trees")]
    dealt = written(_dealt(points, centers), "dealt", paths[0])
    cells = dealt.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / chunk).alias("chunks"), F.max("far").alias("radius"))
    cells = materialize(cells)  # at most CELLS rows
    placed = dealt.join(F.broadcast(cells), "cell").withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
    trees = written(_trees(placed.select("cell", "chunk", "node", "size", "unit")), "trees", paths[1])
    drop_path(spark, paths[0])
    # cells that the covering radii leave (at most CELLS ** 2 / 2 pairs), and their chunks
    reach = float(distance(np.float64(cosine)))
    apart = distance(centers @ centers.T)
    pairs = spark.createDataFrame([(i, j, float(apart[i, j])) for i in range(len(centers)) for j in range(i, len(centers))], "ca int, cb int, d double")
    side = lambda s: cells.select(F.col("cell").alias(f"c{s}"), F.col("chunks").alias(f"n{s}"), F.col("radius").alias(f"r{s}"))
    pairs = pairs.join(F.broadcast(side("a")), "ca").join(F.broadcast(side("b")), "cb").filter(F.col("d") <= F.col("ra") + F.col("rb") + reach + EPS)
    meets = pairs.groupBy(F.col("ca").alias("cell")).agg(F.collect_list("cb").alias("meets"))  # at most CELLS rows of CELLS
    total = trees.count()
    groups = min(total, max(GROUPS, -(-total // GROUP_TREES)))
    trees = trees.coalesce(max(1, groups))
    side = lambda t, s: t.select(*[F.col(c).alias(f"{c}_{s}") for c in t.columns])
    left, right = side(trees.join(F.broadcast(meets), "cell"), "a"), side(trees, "b")
    meet = F.array_contains("meets_a", F.col("cell_b")) & ((F.col("cell_a") < F.col("cell_b")) | (F.col("chunk_a") <= F.col("chunk_b")))
    met = left.hint("shuffle_replicate_nl").join(right, meet)
    met = met.select("cell_a", "chunk_a", "cell_b", "chunk_b", *[f"{c}_{s}" for s in "ab" for c in ("nodes", "points", "unit")])

    def found(got: DualTraversal) -> pa.RecordBatch:
        a, b = got.a, got.b
        x, y = got.links()
        some = [(a.ids[m], got.count_a[m]) for m in [got.count_a > 0]] + [(b.ids[m], got.count_b[m]) for m in [got.count_b > 0] if not got.same]
        ids, counts = np.concatenate([s[0] for s in some]), np.concatenate([s[1] for s in some])
        none = lambda n: pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([ids, x])), pa.concat_arrays([none(len(ids)), pa.array(y, pa.int64())]), pa.concat_arrays([pa.array(counts, pa.int64()), none(len(x))])],
            names=["a", "b", "links"],
        )

    def traversed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = list(zip(*[batch.column(c).to_pylist() for c in range(4)], strict=True))
            for row, k in enumerate(names):
                a = _tree(batch, row, "a")
                yield found(DualTraversal(a, a if k[:2] == k[2:] else _tree(batch, row, "b"), cosine))

    conf = spark.conf
    before, size = conf.get(AT_ONCE), 16 * chunk * centers.shape[1]
    conf.set(AT_ONCE, str(max(1, BATCH_BYTES // size)))  # rows are pairs of trees
    try:
        links = written(met.mapInArrow(traversed, _FOUND), "links")
    finally:
        conf.set(AT_ONCE, before)
    drop_path(spark, paths[1])
    return links


def near_duplicates(spark: SparkSession, vectors: DataFrame, cosine: float = 0.9, chunk: int = CHUNK, sample: int = SAMPLE, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    vec = F.col(vector).cast("array<double>")
    sound = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists("vec", lambda x: x != 0)
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), vec.alias("vec")).withColumn("sound", F.coalesce(sound, F.lit(False)))
    rows = written(rows.select("vec_id", F.when(F.col("sound"), F.col("vec")).alias("vec")), "vectors")
    classes = rows.filter("vec IS NOT NULL").groupBy("vec").agg(F.count(F.lit(1)).alias("size"), F.min("vec_id").alias("least"))
    # scaled by the largest component first, so that no square overflows or vanishes
    top = F.array_max(F.transform("vec", F.abs))
    scaled = F.transform("vec", lambda x: x / F.col("top"))
    norm = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda s, x: s + x * x))
    classes = classes.withColumn("top", top).withColumn("scaled", scaled).withColumn("norm", norm)
    classes = written(classes.select("vec", "size", "least", F.transform("scaled", lambda x: x / F.col("norm")).alias("unit"), F.monotonically_increasing_id().alias("node")), "classes")
    found = None
    for r in classes.select(F.size("unit").alias("d")).distinct().collect():  # a search per vector length
        part = _links_of(spark, classes.filter(F.size("unit") == r["d"]).select("node", "size", "unit"), cosine, chunk, sample)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("weight"))
    reached = components(found.filter("b IS NOT NULL AND a <> b").select("a", "b"))
    named = classes.select("vec", "node", "least").join(reached, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = written(named.join(smallest, "component").join(counts, "node").select("vec", "component_id", (F.col("weight") - 1).alias("n_links")), "named")
    out = rows.filter("vec IS NOT NULL").join(named, "vec").select("vec_id", "n_links", "component_id")
    alone = rows.filter("vec IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def near_duplicates_sql(cosine: float = 0.9) -> str:
    """The same rows in DuckDB, by comparing all pairs."""
    return f"""
        WITH RECURSIVE v AS (
            SELECT vec_id, [CAST(x AS DOUBLE) for x in embedding] AS v FROM embeddings
            WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in embedding if x <> 0]) > 0
        ), l AS MATERIALIZED (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {cosine}
        ), reach(vec_id, low) AS (
            SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.low FROM reach r JOIN l ON l.a = r.vec_id WHERE r.low < l.b
        ), c AS (SELECT vec_id, min(low) AS component_id FROM reach GROUP BY vec_id),
        n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
        SELECT c.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, c.vec_id = c.component_id AS kept
        FROM c LEFT JOIN n ON n.vec_id = c.vec_id
    """
