"""Skip-gram pair generation with a dynamic window.

The band self-join ``|gpos_c - gpos_x| <= r`` is not run as a theta join
(which plans as a hash join per document with a residual: quadratic in the
document length). The dense stream is cut into chunks of ``chunk`` positions;
the ``window`` rows on each side of a chunk border are copied into the
neighbouring chunk as a halo, and a task that reads its chunks in ``gpos`` order
sees every neighbour within the window. Work is linear in N * W and no group
exceeds ``chunk + 2 * window`` rows, whatever the document lengths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import task_uniforms, uniform
from ..session import ship_package

# positions per chunk: the halo costs 2W/CHUNK extra rows; the number of
# tasks is set by the shuffle partitions, not by the chunk count
CHUNK = 1 << 14


def with_radius(kept: DataFrame, window: int = 5, seed: int = 42, epoch: int | None = None) -> DataFrame:
    """G1: radius ``r = 1 + floor(u * W)`` per center, keyed by its position."""
    keys = ["doc_id", "pos"] if epoch is None else [F.lit(epoch), "doc_id", "pos"]
    return kept.withColumn("r", (F.lit(1) + F.floor(uniform("window", seed, *keys) * window)).cast("int"))


def window_pairs(
    dense: DataFrame,
    window: int = 5,
    seed: int = 42,
    sentence: bool = False,
    chunk: int = CHUNK,
    epoch: int | None = None,
    columns: tuple[str, ...] | None = None,
) -> DataFrame:
    """G2 (``sentence=False``: the window crosses document borders, one flat
    stream) or G3 (``sentence=True``: pairs stay inside a document/sentence).

    ``dense`` needs ``doc_id, pos, idx, gpos`` (``gpos`` dense over the kept
    stream). Output: ``doc_id, center_pos, ctx_doc, context_pos, center,
    context, gpos, off`` where ``(gpos, off)`` is the logical pair id and
    ``off`` the signed offset of the context. The pair relation is one-sided:
    (a, b) does not imply (b, a) because each center has its own radius.
    ``columns``: only these of them, made and handed on in the order above.
    """
    if chunk <= 2 * window:
        raise ValueError("chunk must exceed twice the window")
    ship_package(dense.sparkSession)  # the tasks draw radii with it
    n = int(dense.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    base = dense.select("doc_id", "pos", "idx", "gpos")
    ch = (F.col("gpos") / F.lit(chunk)).cast("long")
    inner = F.col("gpos") - ch * F.lit(chunk)
    copies = F.array(
        ch,
        F.when(inner < window, ch - 1),
        F.when(inner >= chunk - window, ch + 1),
    )
    rows = base.select("*", F.explode(copies).alias("_chunk")).filter(F.col("_chunk") >= 0)
    rows = rows.repartition(n, "_chunk").sortWithinPartitions("_chunk", "gpos")
    # the radius (G1) is drawn behind the shuffle, in the tasks
    return rows.mapInArrow(_neighbours(window, seed, epoch, sentence, chunk, columns), pair_fields(columns))


PAIRS = "doc_id bigint, center_pos int, ctx_doc bigint, context_pos int, center int, context int, gpos bigint, off int"


def pair_fields(columns: tuple[str, ...] | None = None) -> str:
    return ", ".join(f for f in PAIRS.split(", ") if columns is None or f.split()[0] in columns)


# pairs handed on at a time
PAIRS_AT_ONCE = 1 << 16


def _radius(batch, window: int, seed: int, epoch: int | None):
    """``with_radius`` of an Arrow batch, hashed many at a time."""
    import numpy as np

    u = task_uniforms("window", seed, () if epoch is None else (epoch,), [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "pos")])
    return (1 + np.floor(u[:, 0] * window)).astype(np.int32)


def _neighbours(window: int, seed: int, epoch: int | None, sentence: bool, chunk: int, columns: tuple[str, ...] | None = None):
    """Pairs of rows sorted by (chunk, gpos). The last ``window`` rows of a batch
    wait for the next one, which also meets the ``window`` rows before them."""
    import numpy as np
    import pyarrow as pa

    names = [f.split()[0] for f in pair_fields(columns).split(", ")]
    sources = {"doc_id": ("doc_id", 0), "center_pos": ("pos", 0), "ctx_doc": ("doc_id", 1), "context_pos": ("pos", 1), "center": ("idx", 0), "context": ("idx", 1), "gpos": ("gpos", 0)}
    types = {"doc_id": pa.int64(), "pos": pa.int32(), "idx": pa.int32(), "gpos": pa.int64(), "r": pa.int32(), "_chunk": pa.int64()}

    def pairs_of(t, begin: int, end: int):
        gpos, chunks, r = (t.column(c).to_numpy() for c in ("gpos", "_chunk", "r"))
        doc = t.column("doc_id")
        docs, known = doc.fill_null(0).to_numpy(), doc.is_valid().to_numpy(zero_copy_only=False)
        at = np.arange(begin, end)
        at = at[gpos[at] // chunk == chunks[at]]
        offs = np.array([o for d in range(1, window + 1) for o in (-d, d)])
        other = at[:, None] + offs
        inside = (other >= 0) & (other < len(gpos)) & (np.abs(offs) <= r[at][:, None])
        row, col = np.nonzero(inside)
        a, b = at[row], other[row, col]
        same = chunks[a] == chunks[b]
        if sentence:
            same &= (docs[a] == docs[b]) & known[a] & known[b]
        a, b, off = a[same], b[same], offs[col[same]]
        for i in range(0, len(a), PAIRS_AT_ONCE):
            ends = pa.array(a[i : i + PAIRS_AT_ONCE]), pa.array(b[i : i + PAIRS_AT_ONCE])
            made = {c: t.column(source).take(ends[end]) for c, (source, end) in sources.items() if c in names}
            yield pa.RecordBatch.from_arrays([made[c] if c in made else pa.array(off[i : i + PAIRS_AT_ONCE].astype(np.int32)) for c in names], names=names)

    def run(batches):
        held, begin = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            r = pa.array(_radius(batch, window, seed, epoch))
            got = pa.RecordBatch.from_arrays([r if c == "r" else batch.column(batch.schema.get_field_index(c)).cast(t) for c, t in types.items()], names=list(types))
            held = got if held is None else pa.RecordBatch.from_arrays([pa.concat_arrays([held.column(c), got.column(c)]) for c in types], names=list(types))
            end = max(begin, held.num_rows - window)
            yield from pairs_of(held, begin, end)
            cut = max(0, end - window)
            held, begin = held.slice(cut), end - cut
        if held is not None:
            yield from pairs_of(held, begin, held.num_rows)

    return run


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Occurrences of each (center, context); partial aggregation first, under
    one packed key (two non-negative ints), a third less to shuffle."""
    key = F.shiftleft(F.col("center").cast("long"), 32) + F.col("context")
    n = pairs.groupBy(key.alias("_key")).agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.shiftright("_key", 32).cast("int").alias("center"), F.col("_key").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("context"), "n")
