"""Vocabulary: counts, frequency rank, subsampling and noise probabilities.

All per-word quantities are computed on the vocabulary (V rows) before any
join with the token stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.ordering import global_index

# first appearance (doc_id, pos) packed into one decimal so the count and the
# tie-breaker both stay in a hash aggregate (min over a struct would not)
_POS_SPAN = 10_000_000_000
_KEY_TYPE = "decimal(38,0)"
# ids below this make a key of one long
_LONG_DOCS = (1 << 63) // _POS_SPAN

# fixed values: default noise exponent and integer weight resolution
NOISE_POWER = 0.75
WEIGHT_SCALE = 1_000_000


def word_counts(tokens: DataFrame, min_count: int = 1) -> DataFrame:
    """V1 + T4: ``word, cnt, first_doc, first_pos`` with ``cnt >= min_count``.

    Partial (map-side) aggregation collapses hot words before the shuffle.
    """
    wide = F.col("doc_id").cast("decimal(20,0)") * F.lit(_POS_SPAN).cast("decimal(11,0)") + F.col("pos").cast(
        "decimal(11,0)"
    )
    # nearly all ids fit one long; the decimal is built for the others alone
    fits = F.col("doc_id").between(0, _LONG_DOCS - 1)
    long_key = F.when(fits, F.col("doc_id") * F.lit(_POS_SPAN) + F.col("pos"))
    agg = tokens.groupBy("word").agg(
        F.count(F.lit(1)).alias("cnt"),
        F.min(long_key).alias("_near"),
        F.min(F.when(~fits, wide.cast(_KEY_TYPE))).alias("_far"),
    )
    agg = agg.filter(F.col("cnt") >= min_count)
    # negative ids come before those of one long, larger ones after them
    near = F.col("_near").cast(_KEY_TYPE)
    agg = agg.withColumn("_first", F.when(F.col("_far") < 0, F.col("_far")).otherwise(F.coalesce(near, F.col("_far"))))
    first_doc = F.floor(F.col("_first") / F.lit(_POS_SPAN)).cast("long")
    return agg.select(
        "word",
        "cnt",
        first_doc.alias("first_doc"),
        (F.col("_first") - first_doc.cast(_KEY_TYPE) * F.lit(_POS_SPAN)).cast("int").alias("first_pos"),
    )


def rank_words(counts: DataFrame, max_vocab_size: int | None = None) -> DataFrame:
    """R1 (+ R2): dense 0-based index by count descending, ties to the word
    that appears first in the stream; optional cap on the top N."""
    ranked = global_index(
        counts, [F.col("cnt").desc(), F.col("first_doc").asc(), F.col("first_pos").asc()], idx_col="idx"
    )
    ranked = ranked.withColumn("idx", F.col("idx").cast("int"))
    if max_vocab_size is not None:
        ranked = ranked.filter(F.col("idx") < max_vocab_size)
    return ranked.select("idx", "word", "cnt", "first_doc", "first_pos")


def build_vocab(tokens: DataFrame, min_count: int = 5, max_vocab_size: int | None = None) -> DataFrame:
    """V1 + T4 + R1 (+ R2): ``idx, word, cnt, first_doc, first_pos``."""
    return rank_words(word_counts(tokens, min_count), max_vocab_size)


def _scalar(df: DataFrame, expr, name: str) -> DataFrame:
    return df.agg(expr.alias(name))


def with_frequencies(vocab: DataFrame) -> DataFrame:
    """V2 + V3 (+ V5): total mass of the filtered vocabulary, ``freq = cnt/total``
    and ``vocab_size``; the scalars are one broadcast row."""
    tot = vocab.agg(F.sum("cnt").cast("long").alias("total"), F.count(F.lit(1)).cast("int").alias("vocab_size"))
    out = vocab.join(F.broadcast(tot), how="cross")
    return out.withColumn("freq", F.col("cnt") / F.col("total"))


def keep_probability(vocab: DataFrame, t: float = 1e-5, form: str = "plain", float32: bool | None = None) -> DataFrame:
    """Per-word keep probability.

    plain    : min(1, sqrt(t/f))              (flat-stream variant)
    additive : min(1, sqrt(t/f) + t/f)        (sentence variant, float32)
    """
    v = vocab if "freq" in vocab.columns else with_frequencies(vocab)
    r = F.lit(float(t)) / F.col("freq")
    if form == "plain":
        kp = F.least(F.lit(1.0), F.sqrt(r))
    elif form == "additive":
        kp = F.least(F.lit(1.0), F.sqrt(r) + r)
    else:
        raise ValueError(f"unknown keep-probability form {form!r}")
    if float32 is None:
        float32 = form == "additive"
    if float32:
        kp = kp.cast("float").cast("double")
    return v.withColumn("keep_prob", kp)


def noise_table(vocab: DataFrame, power: float = NOISE_POWER, scale: int = WEIGHT_SCALE) -> DataFrame:
    """N1 + V4 + R8: smoothed unigram weights as integers
    ``weight = round(cnt^power * scale)``, their exact running sum
    ``[cdf_lo, cdf_hi)`` in index order, the total and ``prob``."""
    w = vocab.withColumn("weight", F.round(F.pow(F.col("cnt").cast("double"), F.lit(float(power))) * F.lit(float(scale))).cast("long"))
    ranked = global_index(w, ["idx"], idx_col="_widx", sums=[("weight", "cdf_hi")]).drop("_widx")
    tot = w.agg(F.sum("weight").cast("long").alias("weight_total"))
    out = ranked.join(F.broadcast(tot), how="cross")
    return out.withColumn("cdf_lo", F.col("cdf_hi") - F.col("weight")).withColumn(
        "prob", F.col("weight") / F.col("weight_total")
    )
