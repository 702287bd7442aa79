"""Exact n-gram Jaccard join by T-occurrence search (DivideSkip).

Method. A document is the set of its distinct word shingles (64-bit hashes). A
linked set shares all but ``n - ceil(num/den * n)`` of its n hashes with its
partner. So of its prefix, the smallest ``n - ceil(num/den * n) + ceil(n/10)``
hashes, it shares at least a tenth of the smaller set's size with the partner's
prefix. Prefix hashes of one document leave the data, and with them documents
that keep less than that tenth: chance hits and common passages seldom pass.
The others meet under the keys (prefix hash, size class); a class and its
neighbour cover all sizes that can link. All documents of a key hang on its
smallest one, the leader; the documents of a leader form an index block, cut
into chunks of at most ``CHUNK_HASHES`` hashes.

In a chunk every set is searched against the inverted lists of the others for
those that share at least T hashes, T following from the threshold. DivideSkip:
the longest lists are set aside, the short ones are merged, what occurs often
enough there is looked up in the long lists by binary search, and what reaches T
is compared exactly. Sets that are in one component already are not compared
again, so a group of near copies costs about one comparison a member, and links
leave a chunk as a spanning forest, never as all pairs.

Links between different chunks of a leader are found in a second step: hashes
that only one document of the leader has cannot count, so documents with less
than T others drop out; what is left outside the leader's own component is
searched against every chunk, in blocks.

Equal sets are one node (the smallest id of the class). Components of the links
then give each document the smallest id that it reaches.

Defined results: a null or empty text has no shingles, is linked with nothing
and is its own component; fewer words than a shingle are one shingle; repeated
rows each give a row with the same component; rows with one id and different
texts count as one linked document; a null id is grouped by its text alone and
its component is the smallest other id, or null; extra columns are dropped; an
empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, scratch_path
from .common import slices, utf8_rows
from .components import components
from .wordhash import WINDOW_BASE, Words, mix, range_sums

SCANS = 32  # documents of a chunk that are compared with all others first
LONG_LIST = 256  # entries from which a list is searched rather than merged
CHUNK_HASHES = 1_000_000  # of 8 bytes: what one task holds at a time, with its index
CHUNK_ROWS = 8192  # documents of a chunk
BROADCAST_BYTES = 64 << 20  # of a table in memory that is broadcast rather than shuffled with texts
ROW_BYTES = 64  # of a row of up to five numbers in a broadcast relation
ITEM_BYTES = 40  # of an item of a list in it: three numbers


def shingle_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    raw, offsets = utf8_rows(column)
    w = Words(raw, offsets, lower=True)
    runs = w.runs(words)
    for a, b in zip(w.first[:-1], w.first[1:], strict=True):
        if b - a >= words:
            yield np.unique(runs[a : b - words + 1])
        elif b > a:
            yield mix(range_sums(w.hash[a:b], np.array([0]), np.array([b - a]), WINDOW_BASE) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


_SKETCH = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()), T.StructField("s1", T.LongType()), T.StructField("s2", T.LongType())])
_KEYS = T.StructType([T.StructField("key", T.LongType()), T.StructField("doc_id", T.LongType())])


def _text_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """Size and two hashes of the set of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1000, text=1):
                n, s1, s2 = [], [], []
                for s in shingle_sets(batch.column(1), words):
                    n.append(len(s))
                    mixed = mix(s)
                    s1.append(mixed.sum(dtype=np.uint64))
                    s2.append(np.bitwise_xor.reduce(mix(mixed + np.uint64(1))) if len(s) else np.uint64(0))
                long = lambda x: pa.array(np.array(x, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), long(s1), long(s2)], names=_SKETCH.names)

    return docs.mapInArrow(run, _SKETCH)


def prefix_keys(docs: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """(key, doc_id): the prefix of every row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1000, text=1):
                keys, lens = [], []
                for s in shingle_sets(batch.column(1), words):
                    n = len(s)
                    keys.append(s[: n - -(-num * n // den) + -(-n // 10)])
                    lens.append(len(keys[-1]))
                ids = np.repeat(batch.column(0).to_numpy(), lens)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64) if keys else np.zeros(0, np.int64)), pa.array(ids, pa.int64())], names=_KEYS.names)

    return docs.mapInArrow(run, _KEYS)


# ---- one chunk ---------------------------------------------------------------
class Forest:
    """Components of a chunk's documents: ``label`` of each; a smaller component
    takes the label of a larger one."""

    def __init__(self, n: int):
        self.label = np.arange(n)
        self.members: dict[int, np.ndarray] = {}

    def _of(self, label: int) -> np.ndarray:
        return self.members.get(label, np.array([label]))

    def join(self, i: int, j: int) -> None:
        a, b = int(self.label[i]), int(self.label[j])
        if a != b:
            one, other = self._of(a), self._of(b)
            if len(one) < len(other):
                a, b, one, other = b, a, other, one
            self.label[other] = a
            self.members[a] = np.concatenate([one, other])
            self.members.pop(b, None)

    def join_all(self, i: int, others: np.ndarray) -> np.ndarray:
        """Joins documents with i; one of each component that was another's."""
        labels, first = np.unique(self.label[others], return_index=True)
        fresh = others[first[labels != self.label[i]]]
        for j in fresh.tolist():
            self.join(i, j)
        return fresh


def divide_skip(postings: np.ndarray, start: np.ndarray, size: np.ndarray, least: int) -> np.ndarray:
    """Documents that occur in at least ``least`` of the lists, which are the
    sorted runs ``postings[start : start + size]`` (the T-occurrence problem).
    At most ``least - 1`` lists can be set aside; only those longer than
    ``LONG_LIST`` are worth a binary search."""
    order = np.argsort(size, kind="stable")
    start, size = start[order], size[order]
    n_long = min(least - 1, int((size > LONG_LIST).sum()))
    n_short = len(size) - n_long
    # merge of the short lists: sorted runs brought together, equal neighbours counted
    ends = np.cumsum(size[:n_short])
    at = np.arange(ends[-1]) + np.repeat(start[:n_short] - ends + size[:n_short], size[:n_short])
    merged = np.sort(postings[at], kind="stable")
    first = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]]))
    counts = np.diff(np.append(first, len(merged)))
    enough = counts >= least - n_long
    found, counts = merged[first[enough]], counts[enough]
    for left in range(n_long, 0, -1):
        if not len(found):
            break
        one = postings[start[n_short + left - 1] :][: size[n_short + left - 1]]
        at = np.minimum(np.searchsorted(one, found), len(one) - 1)
        counts = counts + (one[at] == found)
        hopeful = counts + left - 1 >= least
        found, counts = found[hopeful], counts[hopeful]
    return found[counts >= least]


def chunk_links(ids: np.ndarray, sets: list[np.ndarray], num: int, den: int, asked: np.ndarray | None = None, known: np.ndarray | None = None) -> list[tuple[int, int]]:
    """A spanning forest of the links among a chunk's sets. ``asked`` marks the
    sets to search for (all, if None); ``known`` names components found before."""
    n = len(ids)
    sizes = np.array([len(s) for s in sets])
    order = np.lexsort((ids, sizes))  # a set is searched among the smaller ones
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    flat = np.concatenate([sets[i] for i in order])
    owner = np.repeat(np.arange(n), sizes[order])
    by_hash = np.argsort(flat, kind="stable")
    hashes, lists = flat[by_hash], owner[by_hash]
    edge = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1], [True]])) if len(hashes) else np.zeros(1, np.int64)
    keys, starts, ends = hashes[edge[:-1]], edge[:-1], edge[1:]
    shared = ends - starts > 1
    number = np.empty(len(flat), np.int64)  # the list of each hash of each set
    number[by_hash] = np.repeat(np.arange(len(keys)), ends - starts)
    sizes = sizes[order]
    first = np.append(0, np.cumsum(sizes))
    met = np.add.reduceat(shared[number], first[:-1]) if len(flat) else np.zeros(n, np.int64)
    asked = np.ones(n, bool) if asked is None else asked[order]
    forest, out = Forest(n), []
    if known is not None:
        labels, leader, of = np.unique(known[order], return_index=True, return_inverse=True)
        for x in range(n):
            forest.join(x, int(leader[of[x]]))
    able = met >= -(-num * sizes // den)

    def link(x: int, ys: np.ndarray) -> None:
        out.extend((int(ids[order[x]]), int(ids[order[y]])) for y in forest.join_all(x, ys).tolist())

    def shared_with(x: int, ys: np.ndarray | None) -> np.ndarray:
        """Which of the documents ``ys`` (all, if None) are linked with x."""
        mark = np.zeros(len(keys), bool)
        mark[number[first[x] : first[x + 1]]] = True
        if ys is None:
            common, ys = np.add.reduceat(mark[number], first[:-1], dtype=np.int64), np.arange(n)
        else:
            size = sizes[ys]
            ends = np.cumsum(size)
            at = np.arange(ends[-1]) + np.repeat(first[ys] - ends + size, size)
            common = np.add.reduceat(mark[number[at]], ends - size, dtype=np.int64)
        return ys[(den * common >= num * (sizes[x] + sizes[ys] - common)) & (ys != x)]

    # some documents against all, so that a group of copies becomes one component
    # at once; a link between components is one of a set outside the largest
    if asked.all():
        # first those whose hashes are met most often, in turn of all and of the unlinked
        met_often = np.add.reduceat((ends - starts)[number], first[:-1]) / sizes
        central = np.argsort(-met_often, kind="stable")
        central = central[able[central]]
        scanned = np.zeros(n, bool)
        for k in range(SCANS):
            free = ~scanned[central]
            alone = free & (np.bincount(forest.label, minlength=n)[forest.label[central]] == 1)
            if not alone.any():
                break
            x = int(central[np.argmax(alone if k % 2 else free)])
            scanned[x] = True
            link(x, shared_with(x, None))
        asked = forest.label != np.bincount(forest.label).argmax()
    for x in np.flatnonzero(asked & able).tolist():
        mine = number[first[x] : first[x + 1]]
        mine = mine[shared[mine]]
        # with partners of any size the shared part is at least num/den of the set
        ys = divide_skip(lists, starts[mine], ends[mine] - starts[mine], int(-(-num * sizes[x] // den)))
        ys = ys[(forest.label[ys] != forest.label[x]) & (den * np.minimum(sizes[x], sizes[ys]) >= num * np.maximum(sizes[x], sizes[ys]))]
        ys = ys[(ys < x) | ~asked[ys]]
        if len(ys):
            link(x, shared_with(x, ys))
    return out


_LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
_SETS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("hashes", T.BinaryType())])
_MEMBERS = T.StructType([
    T.StructField("leader", T.LongType()),
    T.StructField("chunk", T.LongType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("asked", T.BooleanType()),
    T.StructField("known", T.LongType()),
    T.StructField("hashes", T.BinaryType()),
])


def _searched(members: DataFrame, num: int, den: int) -> DataFrame:
    """Links of every (leader, chunk)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(rows: list[tuple]) -> list[tuple[int, int]]:
            ids = np.array([r[0] for r in rows])
            asked = np.array([r[1] for r in rows])
            known = np.array([r[0] if r[2] is None else r[2] for r in rows])
            if not asked.any():
                return []
            return chunk_links(ids, [np.frombuffer(r[3], np.uint64) for r in rows], num, den, None if asked.all() else asked, known)

        now, rows = None, {}
        for batch in batches:
            out: list[tuple[int, int]] = []
            cols = [batch.column(i).to_pylist() for i in range(6)]
            for leader, chunk, doc, asked, known, hashes in zip(*cols, strict=True):
                if (leader, chunk) != now:
                    if len(rows) > 1:
                        out += links(list(rows.values()))
                    now, rows = (leader, chunk), {}
                old = rows.get((doc, hashes))
                rows[doc, hashes] = (doc, asked or bool(old and old[1]), known, hashes)
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["a", "b"])
        out = links(list(rows.values())) if len(rows) > 1 else []
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64())], names=["a", "b"])

    return members.repartition("leader", "chunk").sortWithinPartitions("leader", "chunk", "doc_id").mapInArrow(run, _LINKS)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, hashes): the set of every row that has one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 500, text=1):
                sets = [s.tobytes() for s in shingle_sets(batch.column(1), words)]
                some = pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=_SETS.names)
                yield some.filter(pc.greater(pc.binary_length(some.column(1)), 0))

    return docs.mapInArrow(run, _SETS)


def _with_sets(docs: DataFrame, places: DataFrame, words: int) -> DataFrame:
    """Members (``places``: doc_id, leader, chunk, asked, known) with their sets,
    which are built once a document and joined by its id."""
    wanted = docs.join(places.select("doc_id").distinct(), "doc_id", "left_semi")
    return _sets(wanted, words).join(places, "doc_id").select(_MEMBERS.names)


def sized(spark: SparkSession, df: DataFrame, name: str, limit: int = BROADCAST_BYTES, lists: str | None = None, item: int = ITEM_BYTES) -> DataFrame:
    """The frame, of numbers and at most one column of ``lists``, written and
    read again, marked for broadcast if its rows are small enough in memory
    (never with a limit of 0). Beyond that Spark joins it by a shuffle of both
    sides, which adaptive execution can split at hot keys: it could not if the
    frame were an aggregate by the same keys in the same stage."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    if not limit:
        return back
    size = F.lit(ROW_BYTES) if lists is None else F.lit(ROW_BYTES) + F.size(lists) * item
    held = back.agg(F.sum(size.cast("long"))).first()[0] or 0
    return F.broadcast(back) if held <= limit else back


def jaccard_components(spark: SparkSession, docs: DataFrame, words: int, num: int, den: int, chunk_hashes: int = CHUNK_HASHES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row."""
    rows = _text_rows(docs, key, text)
    narrow = materialize(sketches(rows, words))
    # sets of more than one row; a written table, so that a large group of copies
    # is no hot key of a join with an aggregate
    classes = narrow.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("rows"))
    classes = sized(spark, classes.filter("rows > 1").drop("rows"), "classes")
    # ids with rows of different sets: all their rows are keyed, and linked with their classes
    of_id = F.struct("n", "s1", "s2")
    several = narrow.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(of_id).alias("a"), F.max(of_id).alias("b")).filter("a <> b").select("doc_id")
    several = sized(spark, several, "several")
    copies = narrow.join(classes, ["n", "s1", "s2"]).filter("doc_id > node").select("doc_id").distinct()
    if mixed := not several.isEmpty():
        copies = copies.join(several, "doc_id", "left_anti")
    copies = sized(spark, copies, "copies")

    # documents that meet under a key
    nodes = rows.filter("doc_id IS NOT NULL").join(copies, "doc_id", "left_anti").select("doc_id", "text")
    path = scratch_path(spark, "keyed")
    prefix_keys(nodes, words, num, den).write.parquet(path)
    keyed = spark.read.schema(_KEYS).parquet(path)
    shared = keyed.groupBy("key").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("key")
    shared = sized(spark, shared, "shared", 0)
    path = scratch_path(spark, "hits")
    keyed.join(shared, "key").write.parquet(path)
    hits = spark.read.schema(_KEYS).parquet(path)
    each = narrow.filter("doc_id IS NOT NULL AND n > 0").select("doc_id", "n").distinct()
    enough = hits.groupBy("doc_id").agg(F.count(F.lit(1)).alias("met")).join(each, "doc_id").filter(F.col("met") * 10 * den >= F.col("n") * num)
    size_class = lambda n: F.floor(F.log(n.cast("double")) / math.log(max(1.3, 1.05 * den / num))).cast("int")
    classes_of = F.array_distinct(F.array(size_class(F.col("n")), size_class(F.floor(F.col("n") * den / num))))
    able = sized(spark, enough.select("doc_id", "n", F.explode(classes_of).alias("c")).groupBy("doc_id", "c").agg(F.ceil(F.min("n") * num / (10 * den)).alias("share")), "able")
    meeting = hits.join(able, "doc_id")
    met = meeting.groupBy("key", "c").agg(F.min("doc_id").alias("leader"), F.max("doc_id").alias("last")).filter("leader < last").select("key", "c", "leader")
    met = sized(spark, met, "met", 0)
    ties = meeting.join(met, ["key", "c"]).groupBy("doc_id", "c", "leader", "share").agg(F.count(F.lit(1)).alias("weight"))
    # a linked pair meets under ``share`` keys of a class at least: a document can
    # leave its lightest leaders as long as they hold less than half of that
    lightest = Window.partitionBy("doc_id", "c").orderBy("weight", "leader").rowsBetween(Window.unboundedPreceding, 0)
    ties = ties.withColumn("light", F.sum("weight").over(lightest)).filter(F.col("light") * 2 > F.col("share") - 1)
    stars = materialize(ties.filter("doc_id > leader").select("leader", "doc_id").distinct())

    # a leader's documents in chunks; the leader itself is in each of them
    sizes = narrow.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("n").alias("n"))
    followers = stars.join(sizes, "doc_id")
    chunks = followers.groupBy("leader").agg(F.ceil(F.greatest(F.sum("n") / chunk_hashes, F.count(F.lit(1)) / CHUNK_ROWS)).alias("chunks"))
    hang = F.pmod(F.xxhash64("doc_id"), F.col("chunks"))
    no_label = F.lit(None).cast("long").alias("known")
    placed = followers.join(chunks, "leader").select("doc_id", "leader", hang.alias("chunk"), F.lit(True).alias("asked"), no_label)
    leading = chunks.select(F.col("leader").alias("doc_id"), "leader", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"), F.lit(True).alias("asked"), no_label)
    links = materialize(_searched(_with_sets(rows, materialize(placed.unionByName(leading)), words), num, den))

    if mixed:
        own = narrow.join(several, "doc_id").join(classes, ["n", "s1", "s2"]).filter("doc_id <> node")
        links = materialize(links.unionByName(own.select(F.col("doc_id").alias("a"), F.col("node").alias("b")).distinct()))
    hot = sized(spark, chunks.filter("chunks > 1"), "hot")
    if not hot.isEmpty():
        links = materialize(links.unionByName(_across_chunks(spark, rows, stars, hot, components(links), words, num, den)))
    reached = sized(spark, components(links), "reached")

    named = narrow.join(classes, ["n", "s1", "s2"], "left").withColumn("node", F.coalesce("node", "doc_id"))
    named = named.join(reached, "node", "left")
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("component_id"))


def _across_chunks(spark: SparkSession, rows: DataFrame, stars: DataFrame, hot: DataFrame, reached: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """Links between different chunks of a leader."""
    label = reached.select(F.col("node").alias("doc_id"), F.col("component").alias("label"))
    member = stars.unionByName(hot.select("leader", F.col("leader").alias("doc_id"))).join(hot, "leader").distinct()
    member = member.join(label, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
    main = label.select(F.col("doc_id").alias("leader"), F.col("label").alias("main"))
    member = materialize(member.join(main, "leader", "left").withColumn("main", F.coalesce("main", "leader")))
    # hashes that only one document of a leader has cannot count
    blank = [F.lit(0).cast("long").alias("chunk"), F.lit(True).alias("asked"), F.lit(None).cast("long").alias("known")]
    sets = _with_sets(rows, member.select("doc_id", "leader", *blank), words)
    hashes = _exploded(sets)
    often = hashes.groupBy("leader", "h").agg(F.countDistinct("doc_id").alias("f")).filter("f > 1").select("leader", "h")
    total = hashes.groupBy("leader", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    counted = hashes.join(often, ["leader", "h"]).groupBy("leader", "doc_id").agg(F.count(F.lit(1)).alias("met")).join(total, ["leader", "doc_id"])
    able = counted.filter(F.col("met") * den >= F.col("n") * num).select("leader", "doc_id")
    member = materialize(member.join(able, ["leader", "doc_id"]))
    chunk = F.pmod(F.xxhash64("doc_id"), F.col("chunks"))
    index = member.select("doc_id", "leader", chunk.alias("chunk"), F.lit(False).alias("asked"), F.col("label").alias("known"))
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    asking = member.filter("label <> main").select("doc_id", "leader", "chunks", "label", every.alias("c"), chunk.alias("block"))
    # questions in blocks too: a task holds one index chunk and one block of questions
    blocks = asking.select("leader", "chunks", "c", "block").distinct()
    index = index.withColumnRenamed("chunk", "c").join(blocks.select("leader", "c", "block", "chunks"), ["leader", "c"])
    task = (F.col("c") * F.col("chunks") + F.col("block")).alias("chunk")
    asking = asking.select("doc_id", "leader", task, F.lit(True).alias("asked"), F.col("label").alias("known"))
    placed = index.select("doc_id", "leader", task, "asked", "known").unionByName(asking)
    return _searched(_with_sets(rows, materialize(placed), words), num, den)


def _exploded(sets: DataFrame) -> DataFrame:
    """(leader, doc_id, h): the sets row by row."""
    schema = T.StructType([T.StructField("leader", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("h", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 200):
                sets = [np.frombuffer(x, np.int64) for x in batch.column(5).to_pylist()]
                lens = [len(s) for s in sets]
                spread = lambda i: np.repeat(batch.column(i).to_numpy(zero_copy_only=False), lens)
                yield pa.RecordBatch.from_arrays([pa.array(spread(0), pa.int64()), pa.array(spread(2), pa.int64()), pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64))], names=schema.names)

    return sets.mapInArrow(run, schema)


def one_of_each(spark: SparkSession, docs: DataFrame, words: int = 5, num: int = 8, den: int = 10, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: that with the smallest id.
    Of rows with one id, one stays; rows with a null id stay."""
    found = materialize(jaccard_components(spark, docs, words, num, den, key=key, text=text))
    dropped = sized(spark, found.filter("doc_id <> component_id").select(F.col("doc_id").alias(key)).distinct(), "dropped")
    repeated = sized(spark, found.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(key)).count().filter("count > 1").select(key), "repeated")
    kept = docs.join(dropped, key, "left_anti")
    if repeated.isEmpty():
        return kept.select(*docs.columns)
    once = kept.join(repeated, key, "left_semi").dropDuplicates([key])
    return kept.join(repeated, key, "left_anti").unionByName(once).select(*docs.columns)
