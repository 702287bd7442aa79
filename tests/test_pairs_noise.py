import numpy as np
import pytest
from conftest import docs_df
from pyspark.sql import functions as F

from wordspace.operators import encode as E
from wordspace.operators import noise as N
from wordspace.operators import pairs as P
from wordspace.operators import vocab as V
from wordspace.sources import corpus as C


def brute_pairs(rows, sentence):
    """rows: (doc_id, pos, idx, gpos, r) sorted by gpos."""
    out = set()
    n = len(rows)
    for i, (d, p, x, g, r) in enumerate(rows):
        for j in range(max(0, i - r), min(n, i + r + 1)):
            if j == i:
                continue
            if sentence and rows[j][0] != d:
                continue
            out.add((d, p, rows[j][0], rows[j][1], x, rows[j][2]))
    return out


def dense_stream(spark, texts, seed=42):
    toks = C.tokenize(docs_df(spark, texts))
    vocab = V.build_vocab(toks, 1)
    enc = E.encode(toks, vocab)
    return E.dense_positions(enc)


@pytest.mark.parametrize("sentence", [False, True])
@pytest.mark.parametrize("chunk", [11, 1 << 14])
def test_pairs_match_brute_force(spark, sentence, chunk):
    texts = ["a b c d e f g", "h", "i j k l m n o p q r s t u v w x y z a b c", "d e f"]
    dense = dense_stream(spark, texts)
    pairs = P.window_pairs(dense, window=3, seed=7, sentence=sentence, chunk=chunk)
    got = {(r.doc_id, r.center_pos, r.ctx_doc, r.context_pos, r.center, r.context) for r in pairs.collect()}
    rad = P.with_radius(dense, 3, 7).orderBy("gpos").collect()
    rows = [(r.doc_id, r.pos, r.idx, r.gpos, r.r) for r in rad]
    assert got == brute_pairs(rows, sentence)
    assert all(1 <= r[4] <= 3 for r in rows)


def test_no_self_pairs_but_repeats_allowed(spark):
    dense = dense_stream(spark, ["x x x"])
    pairs = P.window_pairs(dense, window=5, seed=1).collect()
    assert all(r.center_pos != r.context_pos for r in pairs)
    assert all(r.center == r.context for r in pairs)
    assert len(pairs) > 0


def test_single_token_documents_give_no_sentence_pairs(spark):
    dense = dense_stream(spark, ["a", "b", "c"])
    assert P.window_pairs(dense, window=5, seed=1, sentence=True).count() == 0
    assert P.window_pairs(dense, window=5, seed=1, sentence=False).count() > 0


def test_dense_positions_huge_block_split(spark):
    toks = C.tokenize(docs_df(spark, [" ".join(["w"] * 50), "v v"]))
    enc = E.encode(toks, V.build_vocab(toks, 1))
    d = E.dense_positions(enc, with_doc_pos=True, block=7).orderBy("doc_id", "pos").collect()
    assert [r.gpos for r in d] == list(range(52))
    assert [r.dpos for r in d][-2:] == [0, 1]


def test_offset_weights_property(spark, demo_tokens):
    vocab = V.build_vocab(demo_tokens, 1)
    dense = E.dense_positions(E.encode(demo_tokens, vocab))
    pairs = P.window_pairs(dense, window=5, seed=3)
    counts = {r.off: r["count"] for r in pairs.groupBy("off").count().collect()}
    n0 = (counts[1] + counts[-1]) / 2
    for o in range(1, 6):
        ratio = (counts[o] + counts[-o]) / 2 / n0
        assert abs(ratio - (5 - o + 1) / 5) < 0.03


def test_partitioning_invariance(spark, demo_tokens):
    vocab = V.keep_probability(V.build_vocab(demo_tokens, 5), 1e-4, "additive")
    a = E.subsample(E.encode(demo_tokens, vocab, carry=("keep_prob",)), 42)
    b = E.subsample(E.encode(demo_tokens.repartition(7), vocab, carry=("keep_prob",)), 42)
    pa = P.window_pairs(E.dense_positions(a), 5, 42)
    pb = P.window_pairs(E.dense_positions(b), 5, 42)
    assert pa.count() == pb.count()
    assert pa.exceptAll(pb).count() == 0


def noise_for(spark, texts):
    toks = C.tokenize(docs_df(spark, texts))
    return V.noise_table(V.build_vocab(toks, 1))


def test_slot_table_equals_left_search(spark):
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(300)]
    text = " ".join(np.repeat(words, rng.integers(1, 40, size=300)))
    noise = noise_for(spark, [text])
    M = 5000
    table = {r.slot: r.idx for r in N.slot_table(noise, M).collect()}
    rows = sorted(noise.collect(), key=lambda r: r.idx)
    cum = np.cumsum([r.weight for r in rows]) / rows[0].weight_total
    expect = np.searchsorted(cum, np.arange(M, dtype=np.float64) / M)
    assert sorted(table) == list(range(M))
    assert [table[s] for s in range(M)] == expect.tolist()


def test_exact_draws_follow_probabilities(spark):
    noise = noise_for(spark, ["a " * 50 + "b " * 20 + "c " * 5 + "d"])
    pairs = spark.range(0, 20000).select(F.col("id").alias("gpos"), F.lit(1).alias("off"))
    negs = N.draw_exact(pairs, noise, 5, seed=9)
    assert negs.count() == 100000
    got = {r.neg: r["count"] for r in negs.groupBy("neg").count().collect()}
    probs = {r.idx: r.prob for r in noise.collect()}
    chi2 = sum((got.get(i, 0) - 100000 * p) ** 2 / (100000 * p) for i, p in probs.items())
    assert chi2 < 16.3  # 3 dof, p = 0.001


def test_exclusion_never_draws_center_or_context(spark):
    noise = noise_for(spark, ["a " * 50 + "b " * 30 + "c " * 5 + "d e"])
    slots = N.slot_table(noise, 1000)
    pairs = spark.range(0, 3000).select(
        F.col("id").alias("gpos"), F.lit(1).alias("off"), F.lit(0).alias("center"), F.lit(1).alias("context")
    )
    negs = N.draw_excluding(pairs, slots, 5, seed=3, table_size=1000)
    assert negs.count() == 15000
    assert negs.filter("neg IN (0, 1)").count() == 0
    per = negs.groupBy("gpos").agg(F.countDistinct("k").alias("nk")).filter("nk <> 5").count()
    assert per == 0


def test_exclusion_fails_only_when_nothing_is_left(spark):
    noise = noise_for(spark, ["a a b"])
    slots = N.slot_table(noise, 100)
    pairs = spark.createDataFrame([(0, 1, 0, 1)], "gpos long, off int, center int, context int")
    with pytest.raises(Exception, match="no slot is left"):
        N.draw_excluding(pairs, slots, 2, seed=1, table_size=100).collect()
    same = spark.createDataFrame([(0, 1, 0, 0), (1, 1, 1, 1)], "gpos long, off int, center int, context int")
    got = N.draw_excluding(same, slots, 3, seed=1, table_size=100).collect()
    assert sorted((r.gpos, r.neg) for r in got) == [(0, 1)] * 3 + [(1, 0)] * 3


def test_exclusion_with_two_very_heavy_words(spark):
    weights = [1_000_000, 1_000_000, 5]
    w = [round(c**0.75 * 1e6) for c in weights]
    rows = [(i, w[i], sum(w[:i]), sum(w[: i + 1]), sum(w)) for i in range(3)]
    noise = spark.createDataFrame(rows, "idx int, weight long, cdf_lo long, cdf_hi long, weight_total long")
    slots = N.slot_table(noise)
    pairs = spark.createDataFrame([(0, 1, 0, 1), (1, 1, 1, 0), (2, 1, 2, 0)], "gpos long, off int, center int, context int")
    got = N.draw_excluding(pairs, slots, 5, seed=42).collect()
    assert sorted((r.gpos, r.neg) for r in got) == [(0, 2)] * 5 + [(1, 2)] * 5 + [(2, 1)] * 5


def test_lightest_word_is_reachable_under_a_very_large_mass(spark):
    # the words around it own 2**57 units: steps of 32-bit draws are ten times as wide as it
    w = [1 << 56, 3_343_702, 1 << 56]
    rows = [(i, w[i], sum(w[:i]), sum(w[: i + 1]), sum(w)) for i in range(3)]
    total, lo, hi = sum(w), w[0], w[0] + w[1]
    step = 2.0**-52 * total
    assert any(lo <= int(d * step) < hi for d in range(int(lo / step) - 2, int(hi / step) + 3))
    assert total / 2**32 > 10 * w[1]
    noise = spark.createDataFrame(rows, "idx int, weight long, cdf_lo long, cdf_hi long, weight_total long")
    pairs = spark.range(2000).selectExpr("id AS gpos", "1 AS off", "0 AS center", "2 AS context")
    assert N.draw_exact(pairs, noise, 2, seed=1).count() == 4000


def test_salted_encode_equals_broadcast(spark, demo_tokens):
    vocab = V.keep_probability(V.build_vocab(demo_tokens, 5), 1e-5, "plain")
    a = E.encode(demo_tokens, vocab, carry=("keep_prob",))
    # force the shuffle path and split every word with more than 300 tokens
    b = E.encode(demo_tokens, vocab, carry=("keep_prob",), broadcast_max_rows=0, hot_word_rows=300)
    assert a.count() == b.count() == 42_800
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_dense_positions_evaluates_the_stream_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    rows = spark.createDataFrame([(d, p, p % 5) for d in range(6) for p in range(50)], "doc_id long, pos int, idx int")
    out = E.dense_positions(rows.mapInPandas(count, rows.schema), with_doc_pos=True, block=16).orderBy("gpos").collect()
    assert [(r.doc_id, r.pos, r.gpos, r.dpos) for r in out] == [(d, p, 50 * d + p, p) for d in range(6) for p in range(50)]
    assert seen.value == 300
