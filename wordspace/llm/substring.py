"""Substring dedup by relative Lempel-Ziv parsing against indexed blocks.

Method. The corpus is cut into blocks at content: every
window of ``WINDOW`` words belongs to the block of its anchor, the smallest hash
among its ``GRAM``-word runs. Equal windows have equal anchors, so only blocks
whose anchor occurs in two different documents are reference blocks. Their index
holds each window with its first occurrence: the smallest document id, and the
text and position there. Each document is factored against the whole index:
a factor starts at a window that a smaller document has, and goes on word by word
while the window's first occurrence moves on by one word in the same source, so
every factor is one substring of its source. Where it ends, the windows across
the boundary are looked up again, and the first one found starts the next factor
(neighbouring factors may overlap). All lookups are one join with the index.
A factor has at least ``WINDOW`` words, so each is a duplicate span; the words of
all of them are removed.

Documents of equal words are one class: all but those of the smallest id are
removed whole if they are a window long, without going through the index.

What moves: anchors (about one for 17 words), windows of shared blocks, spans
(overlapping factors of a document become one span before they are sent).
Lists of a document are bounded by its length; a window or anchor that very many
documents share is partially aggregated before the shuffle. Equality of windows
and whole texts is that of two 64-bit hashes over 64-bit hashes of the words.

Defined results: a null or empty text has no words and the digest of the empty
text; fewer words than a window are kept; rows of equal id are no source for one
another; a row with a null id keeps all its words and is no source; extra
columns are dropped by ``removed_words`` and kept by ``without_repeats``; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .common import slices, unused, utf8_rows
from .jaccard import sized
from .wordhash import BASE, WINDOW_BASE, Words, mix, range_sums, sliding_min

WINDOW = 50
GRAM = 17

_SKETCH = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("s1", T.LongType()),
    T.StructField("s2", T.LongType()),
    T.StructField("anchors", T.ArrayType(T.LongType())),
])
_WINDOWS = T.StructType([
    T.StructField("window", T.LongType()),
    T.StructField("check", T.LongType()),
    T.StructField("doc_id", T.LongType()),
    T.StructField("s1", T.LongType()),
    T.StructField("pos", T.IntegerType()),
])
_SPANS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("s1", T.LongType()), T.StructField("start", T.IntegerType()), T.StructField("length", T.IntegerType())])


def _text_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def _sequence_hashes(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of the whole word sequence of each text."""
    a, b = w.first[:-1], w.first[1:]
    size = (b - a).astype(np.uint64)
    return mix(range_sums(w.hash, a, b, WINDOW_BASE) + size), mix(range_sums(w.hash, a, b, BASE) + size)


def sketches(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """Number of words, sequence hashes and distinct anchors of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 500, text=1):
                w = Words(*utf8_rows(batch.column(1)))
                s1, s2 = _sequence_hashes(w)
                low = sliding_min(w.runs(gram), window - gram + 1)
                own = [np.unique(low[a : b - window + 1]) if b - a >= window else low[:0] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
                ends = np.cumsum([0, *map(len, own)])
                flat = np.concatenate(own).view(np.int64) if own else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.diff(w.first).astype(np.int64)), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))],
                    names=_SKETCH.names,
                )

    return rows.mapInArrow(run, _SKETCH)


def block_windows(rows: DataFrame, window: int, gram: int) -> DataFrame:
    """Windows of the blocks that ``wanted`` names, for each row of (doc_id,
    text, s1, wanted); a row whose words are not those of ``s1`` has none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 200, text=1):
                w = Words(*utf8_rows(batch.column(1)))
                s1 = _sequence_hashes(w)[0].view(np.int64)
                low = sliding_min(w.runs(gram), window - gram + 1).view(np.int64)
                runs, checks = w.runs(window).view(np.int64), w.runs(window, BASE).view(np.int64)
                meant = batch.column(2).to_numpy()
                wanted = batch.column(3)
                ids = batch.column(0).to_numpy()
                found = [[], [], [], [], []]
                for i, (a, b) in enumerate(zip(w.first[:-1], w.first[1:], strict=True)):
                    if b - a < window or s1[i] != meant[i]:
                        continue
                    at = np.flatnonzero(np.isin(low[a : b - window + 1], wanted[i].values.to_numpy()))
                    for col, x in zip(found, (runs[a + at], checks[a + at], np.full(len(at), ids[i]), np.full(len(at), s1[i]), at), strict=True):
                        col.append(x)
                cols = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in found]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (*[pa.int64()] * 4, pa.int32()), strict=True)], names=_WINDOWS.names)

    return rows.select("doc_id", "text", "s1", "wanted").mapInArrow(run, _WINDOWS)


def parse(
    doc: np.ndarray, seq: np.ndarray, pos: np.ndarray, source: np.ndarray, source_seq: np.ndarray, source_pos: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray]:
    """Factors of found windows, sorted by document and position: the row at
    which each starts, and its length in words. A factor goes on with the next
    word (or a repeated row) while its source does."""
    if not len(pos):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    step = np.diff(pos)
    same = (doc[1:] == doc[:-1]) & (seq[1:] == seq[:-1]) & (source[1:] == source[:-1]) & (source_seq[1:] == source_seq[:-1])
    goes_on = same & (step <= 1) & (np.diff(source_pos) == step)
    new = np.flatnonzero(np.concatenate([[True], ~goes_on]))
    last = np.append(new[1:], len(pos)) - 1
    return new, pos[last] - pos[new] + window


def spans(doc: np.ndarray, seq: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Factors that overlap or touch made one: the first of each, and the length."""
    if not len(start):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    end = start + length  # grows within a document, as each factor starts at a later window
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (seq[1:] != seq[:-1]) | (start[1:] > end[:-1])]))
    last = np.append(new[1:], len(start)) - 1
    return new, end[last] - start[new]


def found_windows(spark: SparkSession, rows: DataFrame, wanted: DataFrame, window: int, gram: int) -> DataFrame:
    """(doc_id, s1, pos, source, source_s1, source_pos): each window of the
    reference blocks that a smaller document has, and its first occurrence."""
    path = scratch_path(spark, "windows")
    block_windows(rows.join(wanted, "doc_id"), window, gram).write.parquet(path)
    windows = spark.read.schema(_WINDOWS).parquet(path)
    index = windows.groupBy("window", "check").agg(F.min(F.struct("doc_id", "s1", "pos")).alias("at"), F.max("doc_id").alias("last"))
    index = index.filter("at.doc_id < last").selectExpr("window", "check", "at.doc_id source", "at.s1 source_s1", "at.pos source_pos")
    index = sized(spark, index, "index", 0)
    return windows.join(index, ["window", "check"]).filter("source < doc_id").select("doc_id", "s1", "pos", "source", "source_s1", "source_pos")


def repeated_spans(spark: SparkSession, rows: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, cuts): what to remove from each document that repeats a smaller
    one; ``cuts`` lists (s1, start, length), start null for the whole text."""
    path = scratch_path(spark, "anchors")
    sketches(rows, window, gram).write.parquet(path)
    sketch = spark.read.schema(_SKETCH).parquet(path).filter(F.col("n_words") >= window)
    # texts of more than one row; a written table, so that a large group of copies
    # is no hot key of a join with an aggregate
    classes = sketch.groupBy("n_words", "s1", "s2").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("rows"))
    classes = sized(spark, classes.filter("rows > 1").drop("rows"), "classes")
    both = sketch.join(classes, ["n_words", "s1", "s2"], "left").withColumn("first", F.coalesce("first", "doc_id"))
    copies = both.filter("doc_id > first").select("doc_id", "s1", F.lit(None).cast("int").alias("start"), F.lit(None).cast("int").alias("length")).distinct()

    anchors = both.filter("doc_id = first").select("doc_id", "s1", F.explode("anchors").alias("anchor"))
    shared = anchors.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("anchor")
    shared = sized(spark, shared, "shared", 0)
    wanted = sized(spark, anchors.join(shared, "anchor").groupBy("doc_id", "s1").agg(F.collect_set("anchor").alias("wanted")), "wanted", lists="wanted", item=8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a factor that the edge of a batch cuts becomes two; their union is the same
        for batch in batches:
            doc, seq, pos, *source = (batch.column(i).to_numpy() for i in range(6))
            first, length = parse(doc, seq, pos, *source, window)
            doc, seq, pos = doc[first], seq[first], pos[first]
            first, length = spans(doc, seq, pos, length)
            yield pa.RecordBatch.from_arrays([pa.array(doc[first]), pa.array(seq[first]), pa.array(pos[first], pa.int32()), pa.array(length, pa.int32())], names=_SPANS.names)

    known = found_windows(spark, rows, wanted, window, gram)
    ordered = known.repartition("doc_id", "s1").sortWithinPartitions("doc_id", "s1", "pos")
    return ordered.mapInArrow(run, _SPANS).unionByName(copies).groupBy("doc_id").agg(F.collect_list(F.struct("s1", "start", "length")).alias("cuts"))


def cut_words(w: Words, cuts: list[dict] | None) -> np.ndarray | None:
    """Mask of the kept words of a single text, or None if all are kept."""
    if not cuts:
        return None
    own = int(_sequence_hashes(w)[0].view(np.int64)[0])
    keep = np.ones(len(w.hash), bool)
    for cut in cuts:
        if cut["s1"] == own:
            if cut["start"] is None:
                keep[:] = False
            else:
                keep[cut["start"] : cut["start"] + cut["length"]] = False
    return keep


_REMOVED = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("kept_sha256", T.StringType()),
])


def _one(raw: bytes) -> Words:
    return Words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))


def removed_words(spark: SparkSession, docs: DataFrame, window: int = WINDOW, gram: int = GRAM, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every row."""
    rows = _text_rows(docs, key, text)
    cuts = sized(spark, repeated_spans(spark, rows, window, gram), "cuts", lists="cuts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 500, text=1):
                n_words, n_removed, sha = [], [], []
                for raw, cut in zip(batch.column(1).cast(pa.binary()).fill_null(b"").to_pylist(), batch.column(2).to_pylist(), strict=True):
                    words = raw.split()
                    keep = cut_words(_one(raw), cut)
                    left = words if keep is None else [words[i] for i in np.flatnonzero(keep)]
                    n_words.append(len(words))
                    n_removed.append(len(words) - len(left))
                    sha.append(hashlib.sha256(b" ".join(left)).hexdigest())
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())], names=_REMOVED.names)

    return rows.join(cuts, "doc_id", "left").select("doc_id", "text", "cuts").mapInArrow(run, _REMOVED)


def without_repeats(spark: SparkSession, docs: DataFrame, window: int = WINDOW, gram: int = GRAM, key: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` without the repeated words: each removed stretch goes with the
    white space after it, the rest of the text stays as it is, and ``n_chars``
    is counted anew. Untouched rows stay as they are, nulls included."""
    cuts = sized(spark, repeated_spans(spark, _text_rows(docs, key, text), window, gram), "cuts", lists="cuts")
    names, at, schema = docs.columns, docs.columns.index(text), docs.schema
    count_at = docs.columns.index(n_chars) if n_chars in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 500, text=at):
                texts, cols = batch.column(at).to_pylist(), list(batch.columns[:-1])
                counts = cols[count_at].to_pylist() if count_at is not None else []
                for i, cut in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                    if not cut or not texts[i]:
                        continue
                    raw = texts[i].encode()
                    w = _one(raw)
                    keep = cut_words(w, cut)
                    if keep is None or keep.all():
                        continue
                    edge = np.append(w.start, len(raw))
                    pieces = [raw[: edge[0]]] + [raw[edge[k] : edge[k + 1]] for k in np.flatnonzero(keep)]
                    texts[i] = b"".join(pieces).decode().rstrip()
                    if counts:
                        counts[i] = len(texts[i])
                cols[at] = pa.array(texts, cols[at].type)
                if count_at is not None:
                    cols[count_at] = pa.array(counts, cols[count_at].type)
                yield pa.RecordBatch.from_arrays(cols, names=names)

    own, found = unused("_cut_key", docs.columns), unused("_cuts", docs.columns)
    joined = docs.withColumn(own, F.col(key).cast("long")).join(cuts.select(F.col("doc_id").alias(own), F.col("cuts").alias(found)), own, "left")
    return joined.select(*docs.columns, found).mapInArrow(run, schema)
