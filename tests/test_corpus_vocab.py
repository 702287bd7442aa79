import math

from conftest import docs_df
from pyspark.sql import functions as F

from wordspace.operators import vocab as V
from wordspace.sources import corpus as C


def test_tokenizer_edges(spark):
    df = spark.createDataFrame(
        [(0, ""), (1, None), (2, "123 456"), (3, "Héllo WORLD-x2y"), (4, "a")], "doc_id long, text string"
    )
    rows = C.tokenize(df).orderBy("doc_id", "pos").collect()
    got = [(r.doc_id, r.pos, r.word) for r in rows]
    assert got == [(3, 0, "h"), (3, 1, "llo"), (3, 2, "world"), (3, 3, "x"), (3, 4, "y"), (4, 0, "a")]
    stats = C.corpus_stats(df).first()
    assert (stats.n_docs, stats.n_tokens, stats.n_nonempty_docs) == (5, 6, 2)


def test_demo_corpus_golden(demo_tokens):
    assert demo_tokens.count() == 42_800
    assert demo_tokens.select("word").distinct().count() == 84


def test_demo_vocab_order(demo_tokens):
    v = V.build_vocab(demo_tokens, 5).orderBy("idx").limit(13).collect()
    got = [(r.idx, r.word, r.cnt) for r in v]
    assert got == [
        (0, "the", 7800), (1, "a", 5800), (2, "is", 2600), (3, "king", 1200), (4, "queen", 1200),
        (5, "man", 1000), (6, "woman", 1000), (7, "young", 800), (8, "and", 800), (9, "in", 800),
        (10, "prince", 600), (11, "princess", 600), (12, "cat", 600),
    ]


def test_rank_ties_first_appearance(spark):
    toks = C.tokenize(docs_df(spark, ["b a b a c c c d"]))
    v = V.build_vocab(toks, 1).orderBy("idx").collect()
    assert [r.word for r in v] == ["c", "b", "a", "d"]


def test_ties_across_documents_and_partitions(spark):
    texts = ["z y", "x y z", "w", "x w"]
    toks = C.tokenize(docs_df(spark, texts)).repartition(3)
    v = V.build_vocab(toks, 1).orderBy("idx").collect()
    # counts: y2 z2 x2 w2 -> order by first appearance: z(0,0) y(0,1) x(1,0) w(2,0)
    assert [r.word for r in v] == ["z", "y", "x", "w"]


def test_min_count_inclusive(spark):
    toks = C.tokenize(docs_df(spark, ["a a a b b"]))
    assert {r.word for r in V.build_vocab(toks, 3).collect()} == {"a"}
    assert {r.word for r in V.build_vocab(toks, 2).collect()} == {"a", "b"}


def test_vocab_cap(demo_tokens):
    v = V.build_vocab(demo_tokens, 5, max_vocab_size=5)
    assert [r.word for r in v.orderBy("idx").collect()] == ["the", "a", "is", "king", "queen"]


def test_keep_probabilities_golden(demo_tokens):
    v = V.build_vocab(demo_tokens, 5)
    a = V.keep_probability(v, 1e-5, "plain").filter("word = 'the'").first().keep_prob
    b = V.keep_probability(v, 1e-4, "additive").filter("word = 'the'").first().keep_prob
    assert abs(a - 0.0074075) < 1e-6
    assert abs(b - 0.0239734) < 1e-6
    # expected kept tokens (sum of cnt * keep) from the golden facts
    kept_a = V.keep_probability(v, 1e-5, "plain").agg(F.sum(F.col("cnt") * F.col("keep_prob"))).first()[0]
    assert abs(kept_a - 1061.0) < 1.0


def test_noise_distribution(demo_tokens):
    n = V.noise_table(V.build_vocab(demo_tokens, 5))
    rows = {r.word: r for r in n.collect()}
    assert abs(rows["the"].prob - 0.105035) < 1e-6
    assert abs(rows["king"].prob - 0.0258016) < 1e-6
    assert abs(min(r.prob for r in rows.values()) - 0.00673029) < 1e-6
    assert abs(sum(r.prob for r in rows.values()) - 1.0) < 1e-12
    # cdf is an exact running sum in index order
    ordered = sorted(rows.values(), key=lambda r: r.idx)
    acc = 0
    for r in ordered:
        assert r.cdf_lo == acc
        acc += r.weight
        assert r.cdf_hi == acc
    assert acc == ordered[0].weight_total


def test_token_prefix(spark):
    toks = C.tokenize(docs_df(spark, ["a b c", "", "d e", "f g h i"]))
    got = [(r.doc_id, r.pos, r.gpos, r.word) for r in C.token_prefix(toks, 6).orderBy("gpos").collect()]
    assert got == [(0, 0, 0, "a"), (0, 1, 1, "b"), (0, 2, 2, "c"), (2, 0, 3, "d"), (2, 1, 4, "e"), (3, 0, 5, "f")]


def test_document_prefix_equals_token_prefix(spark):
    docs = docs_df(spark, ["a b c", "", "d e", "f g h i", "j"])
    for n in (0, 1, 3, 4, 6, 100):
        want = sorted(map(tuple, C.token_prefix(C.tokenize(docs), n).collect()))
        assert sorted(map(tuple, C.document_prefix(docs, n).collect())) == want


def test_global_index_matches_sort(spark):
    from wordspace.plans.ordering import global_index

    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5003).alias("k"), (F.col("id") % 7).alias("v"))
    out = global_index(df.repartition(5), ["k"], idx_col="i", sums=[("v", "cum")], num_partitions=4)
    rows = out.orderBy("i").collect()
    ks = sorted(r.k for r in rows)
    assert [r.k for r in rows] == ks
    assert [r.i for r in rows] == list(range(5000))
    acc = 0
    for r in rows:
        acc += r.v
        assert r.cum == acc


def test_sentence_ids_follow_conv_turn_order(spark):
    conv = spark.createDataFrame(
        [(2, 0, "user", "b"), (1, 1, "assistant", "c d"), (1, 0, "user", "a")], "conv_id long, turn long, role string, text string"
    )
    s = C.conversation_sentences(conv).orderBy("sent_id").collect()
    assert [(r.sent_id, r.conv_id, r.turn, list(r.tokens)) for r in s] == [
        (0, 1, 0, ["a"]), (1, 1, 1, ["c", "d"]), (2, 2, 0, ["b"])
    ]
    assert math.isclose(1.0, 1.0)
