"""Encode tokens to vocabulary indices, subsample, and re-densify positions.

E1 (token -> index, OOV dropped), E3 (keep probability carried by the same
join), T6 (Bernoulli keep with hashed uniforms), R3 (dense positions after the
drop), V6 (subsampling report).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import uniform
from ..plans.ordering import global_index
from ..session import written

# broadcast a lookup side only below this many rows (the count is checked)
BROADCAST_MAX_ROWS = 2_000_000
# a word with more tokens than this is split over several join tasks
HOT_WORD_ROWS = 4_000_000
# raw positions per block when numbering the kept stream
POS_BLOCK = 1 << 16


def join_lookup(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    how: str = "inner",
) -> DataFrame:
    """Equi-join with a lookup table; broadcast only after checking its size."""
    n = small.count()
    if n <= broadcast_max_rows:
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


def encode(
    tokens: DataFrame,
    vocab: DataFrame,
    carry: tuple[str, ...] = (),
    broadcast_max_rows: int = BROADCAST_MAX_ROWS,
    hot_word_rows: int = HOT_WORD_ROWS,
) -> DataFrame:
    """E1 (+ E3): ``tokens(doc_id, pos, word)`` joined with the vocabulary;
    out-of-vocabulary tokens fall out of the inner join.

    Small vocabularies are broadcast. Otherwise the join is a shuffle join in
    which hot words (more than ``hot_word_rows`` tokens, known exactly from
    ``cnt``) are salted over ``ceil(cnt / hot_word_rows)`` buckets: token rows
    pick a bucket by a hash of their position, vocabulary rows are copied once
    per bucket, so no join task receives more than about ``hot_word_rows``
    rows of one word.
    """
    cols = ["word", "idx", *carry]
    lookup = vocab.select(*cols, "cnt")
    n = lookup.count()
    if n <= broadcast_max_rows:
        out = tokens.join(F.broadcast(lookup.drop("cnt")), "word")
        return out.select("doc_id", "pos", "idx", *carry)
    hot = lookup.filter(F.col("cnt") > hot_word_rows).select(
        "word", F.ceil(F.col("cnt") / F.lit(hot_word_rows)).cast("int").alias("_buckets")
    )
    # at most total_tokens / hot_word_rows rows: a bounded broadcast
    t_salted = tokens.join(F.broadcast(hot), "word", "left").withColumn(
        "_salt",
        F.when(F.col("_buckets").isNull(), F.lit(0)).otherwise(
            F.pmod(F.xxhash64("doc_id", "pos"), F.col("_buckets")).cast("int")
        ),
    )
    v_salted = lookup.join(F.broadcast(hot), "word", "left").select(
        *cols, F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_buckets"), F.lit(1)) - 1)).alias("_salt")
    )
    out = t_salted.join(v_salted, ["word", "_salt"])
    return out.select("doc_id", "pos", "idx", *carry)


def subsample(encoded: DataFrame, seed: int = 42, salt: str = "subsample", epoch: int | None = None) -> DataFrame:
    """Keep a token iff ``u(doc_id, pos) < keep_prob`` (strict).
    With ``epoch`` set the draw is fresh per epoch (D3)."""
    keys = ["doc_id", "pos"] if epoch is None else [F.lit(epoch), "doc_id", "pos"]
    return encoded.filter(uniform(salt, seed, *keys) < F.col("keep_prob"))


def subsample_report(encoded: DataFrame, seed: int = 42) -> DataFrame:
    """V6: kept, total and removed tokens in one aggregate."""
    kept = F.when(uniform("subsample", seed, "doc_id", "pos") < F.col("keep_prob"), 1).otherwise(0)
    return encoded.agg(
        F.sum(kept).cast("long").alias("kept"),
        F.count(F.lit(1)).alias("total"),
    ).withColumn("removed", F.col("total") - F.col("kept"))


def dense_positions(df: DataFrame, with_doc_pos: bool = False, block: int = POS_BLOCK) -> DataFrame:
    """Number the rows of the stream densely in ``(doc_id, pos)`` order.

    Adds ``gpos`` (position in the whole filtered stream) and, optionally,
    ``dpos`` (position inside its document). Rows are grouped in blocks of
    ``block`` raw positions, so no window group is larger than a block even
    for a single huge document; block offsets are a distributed running sum
    over the (much smaller) per-block counts. The numbered rows are written once
    and the counts are taken from them, so the stream is evaluated once.
    """
    blk = (F.col("pos") / F.lit(block)).cast("long")
    with_blk = df.withColumn("_blk", blk)
    w = Window.partitionBy("doc_id", "_blk").orderBy("pos")
    numbered = written(with_blk.withColumn("_rn", F.row_number().over(w) - 1), "numbered")
    counts = numbered.groupBy("doc_id", "_blk").agg(F.count(F.lit(1)).alias("_n"))
    offs = global_index(counts, ["doc_id", "_blk"], idx_col="_bi", sums=[("_n", "_cum")])
    offs = offs.select("doc_id", "_blk", (F.col("_cum") - F.col("_n")).alias("_off"))
    if with_doc_pos:
        starts = offs.groupBy("doc_id").agg(F.min("_off").alias("_doc_off"))
        offs = offs.join(starts, "doc_id")
    out = join_lookup(numbered, offs, ["doc_id", "_blk"])
    out = out.withColumn("gpos", (F.col("_off") + F.col("_rn")).cast("long"))
    if with_doc_pos:
        out = out.withColumn("dpos", (F.col("gpos") - F.col("_doc_off")).cast("int")).drop("_doc_off")
    return out.drop("_blk", "_rn", "_off")
