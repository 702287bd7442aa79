"""Steps that must not store or move more than their rows need."""

import numpy as np
import pytest
from conftest import docs_df
from pyspark.sql import functions as F

from wordspace.operators import batches as B
from wordspace.operators import noise as N
from wordspace.operators import step as ST
from wordspace.operators import vocab as V
from wordspace.plans import catalog as Q
from wordspace.plans import trainer as TR
from wordspace.sources.corpus import tokenize


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Documents on disk, their stream pairs, noise and hashed parameters."""
    rng = np.random.default_rng(11)
    words = [f"w{chr(97 + i)}" for i in range(20)]
    docs = docs_df(spark, [" ".join(rng.choice(words, 60)) for _ in range(8)])
    at = str(tmp_path_factory.mktemp("large_steps"))
    docs.write.parquet(f"{at}/documents.parquet")
    vocab = V.build_vocab(tokenize(docs), 1)
    noise = V.noise_table(vocab)
    return at, Q.E.dense_positions(Q.E.encode(tokenize(docs), vocab)), noise, ST.init_params(noise, 4, 42, context="hashed")


def test_stored_pairs_are_columns_in_files(spark, small):
    """Rows were checkpointed, uncompressed."""
    at, dense, _, _ = small
    assert Q.stream_pairs(spark, at).inputFiles()
    assert Q.E.dense_positions(dense.select("doc_id", "pos", "idx")).inputFiles()


def test_permutation_moves_ids_without_hashes(spark, small):
    """the pair id moves as one long, its hash does not move."""
    pairs = Q.P.window_pairs(small[1], 5, 42)
    ranked = B.shuffle_order(pairs, 42, 1, buckets=5)
    got = [(r.gpos, r.off) for r in ranked.orderBy("rank").collect()]
    u = B.uniform("shuffle", 42, F.lit(1), "gpos", "off")
    assert got == [(r.gpos, r.off) for r in pairs.select("gpos", "off", u.alias("u")).orderBy("u", "gpos", "off").collect()]
    assert dict(ranked.dtypes)["gpos"] == "bigint" and dict(ranked.dtypes)["off"] == "int"
    assert "_id" in plan(ranked)


@pytest.mark.parametrize("form", ["clip", "branch"])
def test_loss_and_gradients_without_a_shuffle_of_draws(spark, small, form, monkeypatch):
    """What the joined draws give, pair by pair."""
    _, dense, noise, params = small
    pairs = Q.P.window_pairs(dense, 5, 42).localCheckpoint()
    negs = N.draw_exact(pairs, noise, 6, 42, 2, carry=("center",))
    pos, neg = ST.scored(pairs, negs, params, form)
    want = {(r.gpos, r.off): r.loss for r in ST.pair_loss(pos, neg).collect()}
    loss = ST.drawn_loss(pairs, noise, params, 6, 42, 2, 4, form)
    assert "Exchange" not in plan(loss)
    got = {(r.gpos, r.off): r.loss for r in loss.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k], abs=1e-12) for k in want)
    sums = {(r.matrix, r.idx): r.g for r in ST.gradients(pos, neg, 4).collect()}
    summed = {(r.matrix, r.idx): r.g for r in ST.drawn_gradients(pairs, noise, params, 6, 42, 2, 4, form).collect()}
    assert summed.keys() == sums.keys() and all(np.allclose(summed[k], sums[k], atol=1e-10) for k in sums)
    monkeypatch.setattr(ST, "PARAM_BROADCAST_BYTES", 0)  # too large to send: joined
    joined = {(r.gpos, r.off): r.loss for r in ST.drawn_loss(pairs, noise, params, 6, 42, 2, 4, form).collect()}
    assert joined == pytest.approx(want)


def test_first_appearance_beyond_one_long(spark):
    """The packed key of most ids is a long; ids outside still order."""
    rows = [(-5, 3, "a"), (7, 1, "a"), (7, 0, "b"), (10**17, 2, "b"), (10**17, 4, "c"), (10**17 + 1, 1, "c"), (922337202, 9, "d"), (922337203, 0, "d")]
    got = V.word_counts(spark.createDataFrame(rows, "doc_id long, pos int, word string")).collect()
    assert {r.word: (r.cnt, r.first_doc, r.first_pos) for r in got} == {"a": (2, -5, 3), "b": (2, 7, 0), "c": (2, 10**17, 4), "d": (2, 922337202, 9)}


def test_a_target_is_cut_into_one_cell():
    """A sub-round was sent every pair; now its own targets."""
    import pyarrow as pa

    cfg, n, blocks = TR.variant_stream(negatives=3, batch_size=4), 50, 4
    rng = np.random.default_rng(0)
    center, context, negs = rng.integers(0, 5, n) * blocks + 1, rng.integers(0, 20, n), rng.integers(0, 20, (n, 3))
    ev = pa.table({"part": pa.array([9] * n, pa.int32()), "gpos": range(n), "off": [1] * n, "u": rng.random(n), "center": center, "context": context, "negs": negs.tolist()})
    out = TR.make_cells(cfg, blocks, 13, {9: 1}, None, None)(ev)
    hits = {s: np.concatenate([np.frombuffer(h, TR.HIT) for x, h in zip(out["shift"].to_pylist(), out["hits"].to_pylist(), strict=True) if x == s]) for s in range(blocks)}
    assert sum(len(h) for h in hits.values()) == 4 * n
    assert all((h["target"] % blocks == (1 + s) % blocks).all() and (np.diff(h["batch"]) >= 0).all() for s, h in hits.items())
