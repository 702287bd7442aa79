"""Draws, losses and permutations that stay where their pair lies."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordspace.functions.hashing import task_uniforms, uniform
from wordspace.operators import batches as B
from wordspace.operators import noise as N
from wordspace.operators import step as ST
from wordspace.plans import catalog as Q


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def some_pairs(spark, n=400, words=30):
    c, o = F.pmod(F.xxhash64("id"), F.lit(words)), F.pmod(F.xxhash64(F.col("id") + 7), F.lit(words))
    return spark.range(n).select((F.col("id") * 37 % 1009).alias("gpos"), (F.col("id") / 100).cast("int").alias("off"), c.cast("int").alias("center"), o.cast("int").alias("context"))


def some_noise(spark, words=30):
    w = [(words - i) * 1_000_003 for i in range(words)]
    rows = [(i, w[i], sum(w[:i]), sum(w[: i + 1]), sum(w)) for i in range(words)]
    return spark.createDataFrame(rows, "idx int, weight long, cdf_lo long, cdf_hi long, weight_total long")


def test_task_uniforms_are_those_of_the_jvm(spark):
    """one md5 for each draw in the JVM took most of the time."""
    keys = [(g, o) for g in (0, 9, 10, 99, 4294967295, 4294967296, 10**12, 2**63 - 1, -(2**63), -5, None) for o in (-11, -1, 0, 5, 10)]
    rows = spark.createDataFrame(keys, "gpos long, off int")
    want = rows.select("gpos", "off", *[uniform("neg", 42, F.lit(3), "gpos", "off", F.lit(k)).alias(f"u{k}") for k in (0, 9, 10)], uniform("shuffle", 42, F.lit(3), "gpos", "off").alias("s")).toArrow()
    columns = [want.column(c).combine_chunks() for c in ("gpos", "off")]
    assert np.array_equal(task_uniforms("neg", 42, (3,), columns, [0, 9, 10]), np.stack([want.column(f"u{k}").to_numpy() for k in (0, 9, 10)], axis=1))
    assert np.array_equal(task_uniforms("shuffle", 42, (3,), columns)[:, 0], want.column("s").to_numpy())


def test_exact_draws_are_not_joined(spark, monkeypatch):
    """above 2 million bins every draw was shuffled to its bin."""
    from wordspace.operators import encode as E

    monkeypatch.setattr(E, "BROADCAST_MAX_ROWS", 0)
    pairs, noise = some_pairs(spark).localCheckpoint(), some_noise(spark)
    got = N.draw_exact(pairs, noise, 3, 42, 2, carry=("center",), spread_input=False)
    assert "Exchange" not in plan(got) and "Join" not in plan(got)
    joined = N.draw_exact(pairs, noise, 3, 42, 2, bins=64, carry=("center",))
    assert got.dtypes == joined.dtypes
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, joined.collect()))


@pytest.mark.parametrize("form", ["clip", "branch"])
def test_loss_with_excluding_draws_in_one_pass(spark, form):
    """draws, rows and losses were joined and shuffled one after the other."""
    pairs, noise = some_pairs(spark).withColumn("rank", F.col("gpos") * 2).localCheckpoint(), some_noise(spark)
    slots, params = N.slot_table(noise, 500), ST.init_params(noise, 4, 42, context="hashed")
    negs = N.draw_excluding(pairs, slots, 3, 42, 2, 500, carry=("center",))
    want = {(r.gpos, r.off): r.loss for r in ST.pair_loss(*ST.scored(pairs, negs, params, form)).collect()}
    loss = ST.drawn_loss(pairs, noise, params, 3, 42, 2, 4, form, slots, 500, carry=("rank",))
    assert "Exchange" not in plan(loss)
    got = {(r.gpos, r.off): r for r in loss.collect()}
    assert got.keys() == want.keys() and all(got[k].loss == pytest.approx(want[k], abs=1e-12) and got[k].rank == 2 * k[0] for k in want)


def test_permutation_moves_two_longs(spark):
    """id, both words and the bucket moved in a field each; the sort hash
    was also taken in a filter that Spark inferred."""
    pairs = some_pairs(spark).withColumn("context", F.when(F.col("gpos") % 5 > 0, F.col("context") - 3))
    ranked = B.shuffle_order(pairs, 42, 2)
    want = sorted(map(tuple, pairs.select("gpos", "off", "center", "context").collect()))
    assert sorted(tuple(r)[:4] for r in ranked.collect()) == want
    moved = plan(ranked)
    assert "_words" in moved and "isnotnull(cast(FLOOR" not in moved


def test_one_epoch_is_shuffled_at_a_time(spark):
    """all epochs were shuffled in one job."""
    pairs, seen = some_pairs(spark), []

    def one(e):
        seen.append(e)
        return B.shuffle_order(pairs, 42, e)

    out = Q.by_epoch("ranks", one, 2)
    assert seen == [1, 2] and len(out.inputFiles()) >= 2 and out.count() == 800


def test_permutation_hashes_in_the_tasks(spark, monkeypatch):
    """Three md5 a pair in the JVM; now stretches of a bounded size are
    hashed, sorted and numbered in the tasks."""
    monkeypatch.setattr(B, "STRETCH_ROWS", 30)
    pairs = some_pairs(spark).unionByName(some_pairs(spark, 5))  # some ids twice
    ranked = B.shuffle_order(pairs, 42, 2)
    assert "md5" not in plan(ranked) and ranked.rdd.getNumPartitions() > 4
    u = uniform("shuffle", 42, F.lit(2), "gpos", "off")
    want = [(r.gpos, r.off) for r in pairs.select("gpos", "off", u.alias("u")).orderBy("u", "gpos", "off").collect()]
    rows = ranked.orderBy("rank").collect()
    assert [(r.gpos, r.off) for r in rows] == want and [r["rank"] for r in rows] == list(range(405))
    named = pairs.select(F.concat(F.lit("p"), "gpos").alias("name"), "off", "center", "context")  # a key of other types
    got = B.shuffle_order(named, 42, 2, key=("name", "off")).orderBy("rank").collect()
    u = uniform("shuffle", 42, F.lit(2), "name", "off")
    assert [(r.name, r.off) for r in got] == [(r.name, r.off) for r in named.select("name", "off", u.alias("u")).orderBy("u", "name", "off").collect()]


def test_draws_are_added_up_where_they_are_made(spark):
    """F16: a row a draw left the tasks and was counted in the JVM."""
    pairs, noise = some_pairs(spark).localCheckpoint(), some_noise(spark)
    want = sorted(map(tuple, Q.per_neg(N.draw_exact(pairs, noise, 3, 42, 2)).collect()))
    for bins in (None, 64):
        sums = N.draw_exact(pairs, noise, 3, 42, 2, bins=bins, spread_input=False, summed="gpos")
        assert sums.columns == ["neg", "n_draws", "sum_gpos"] and sums.count() <= 30 * pairs.rdd.getNumPartitions()
        assert sorted(map(tuple, sums.groupBy("neg").agg(F.sum("n_draws"), F.sum("sum_gpos")).collect())) == want


@pytest.mark.parametrize("weights", [[5], [1, 10**12, 1], [10**15] + [1] * 3000, [1] * 3000 + [10**9], list(range(1, 2000))])
def test_places_in_the_mass_without_a_search(weights):
    """Each draw was a binary search of the whole mass."""
    mass = np.cumsum(np.array(weights, np.int64))
    rng = np.random.default_rng(1)
    x = np.concatenate([[0, mass[-1] - 1, mass[-1]], mass[:-1], mass - 1, rng.integers(0, mass[-1], 5000)])
    assert np.array_equal(N.mass_places(N.mass_guide(mass), x), np.searchsorted(mass, x, side="right"))


@pytest.mark.parametrize("words", [7, 5000])
def test_rows_are_added_up_for_few_and_many_words(words):
    """every batch of pairs passed over all words, dimension by dimension."""
    rng = np.random.default_rng(2)
    rows, values = rng.integers(0, words, 900), rng.random((900, 3))
    sums, want = np.zeros((words, 3)), np.zeros((words, 3))
    ST._add_up(sums, rows, (values[:, i] for i in range(3)))
    np.add.at(want, rows, values)
    assert np.allclose(sums, want, atol=1e-12)


def test_pairs_are_scored_where_they_lie(spark, monkeypatch):
    """two joins gave every pair its vectors, shuffled where words are many."""
    pairs, noise = some_pairs(spark).localCheckpoint(), some_noise(spark)
    negs, params = N.draw_exact(pairs, noise, 3, 42, 2, carry=("center",)), ST.init_params(noise, 4, 42, context="hashed")
    got, _ = ST.scored(pairs, negs, params, dim=4)
    want = ST.scored(pairs, negs, params)[0].select(*got.columns)
    assert "Join" not in plan(got) and "Exchange" not in plan(got)
    assert got.dtypes == want.dtypes and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    monkeypatch.setattr(ST, "PARAM_BROADCAST_BYTES", 0)
    assert "Join" in plan(ST.scored(pairs, negs, params, dim=4)[0])


def test_only_the_columns_that_are_needed_are_made(spark):
    """Eight columns of every pair left the tasks."""
    from wordspace.operators import pairs as P

    dense = spark.range(300).selectExpr("id div 20 AS doc_id", "CAST(id % 20 AS INT) AS pos", "CAST(id % 7 AS INT) AS idx", "id AS gpos")
    whole = P.window_pairs(dense, 3, 42, chunk=64)
    for columns in (("center", "context", "gpos", "off"), ("gpos", "off"), ("context", "center"), ("ctx_doc", "off")):
        some = P.window_pairs(dense, 3, 42, chunk=64, columns=columns)
        assert set(some.columns) == set(columns) and len(some.columns) == len(columns)
        assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.select(*some.columns).collect()))


def test_radius_is_drawn_in_the_tasks(spark):
    """An md5 a token in the JVM."""
    from wordspace.operators import pairs as P

    rows = spark.createDataFrame([(d, p) for d in (None, 0, -7, 10**12) for p in range(40)], "doc_id long, pos int")
    dense = rows.selectExpr("doc_id", "pos", "1 AS idx", "CAST(row_number() OVER (ORDER BY doc_id, pos) - 1 AS LONG) AS gpos").localCheckpoint()
    for epoch in (None, 3):
        pairs = P.window_pairs(dense, 5, 42, chunk=64, epoch=epoch)
        assert "md5" not in plan(pairs)
        got = {(r.gpos, r.n) for r in pairs.groupBy("gpos").agg(F.count(F.lit(1)).alias("n")).collect()}
        want = {(r.gpos, sum(0 <= r.gpos + o < 160 for o in range(-r.r, r.r + 1) if o)) for r in P.with_radius(dense, 5, 42, epoch).collect()}
        assert got == want
