"""Grid schedule, layered one-pair steps, history and shipping of the trainer."""

import math
import os
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from wordspace.functions.hashing import uniform
from wordspace.operators import step as ST
from wordspace.plans import trainer as TR


def collect(params):
    rows = {(r.matrix, r.idx): np.array(r.vec) for r in params.collect()}
    n = 1 + max(i for _, i in rows)
    return [np.array([rows[m, i] for i in range(n)]) for m in ("center", "context")]


def sigmoid(x):
    return 1 / (1 + math.exp(-max(-20.0, min(20.0, x))))


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_layers_equal_the_chain_of_single_pairs(seed, monkeypatch):
    """One pair a step: layered steps give the sequential chain to 1e-9."""
    monkeypatch.setattr(TR, "CHAIN_BLOCK", 37)
    rng = np.random.default_rng(seed)
    V, d, K, P = 40, 7, 5, 300
    hot = rng.random(P) < 0.3  # a word in a third of the pairs
    center = np.where(hot, 0, rng.integers(0, V, P))
    targets = rng.integers(0, V, (P, K + 1))
    targets[:, 0] = np.where(rng.random(P) < 0.2, center, targets[:, 0])
    wc, wx = rng.uniform(-0.5, 0.5, (V, d)), rng.uniform(-0.5, 0.5, (V, d))
    order = rng.permutation(P)
    cfg = TR.variant_sentence(dim=d, negatives=K, epochs=2, lr=0.1, dtype="float64")
    clock = {"per_pair": True, "epochs_before": 1, "steps": P, "start": 0, "logged": P}
    centers, contexts = TR.LocalRows(np.arange(V), wc, "float64"), TR.LocalRows(np.arange(V), wx, "float64")
    history = TR.PartTrainer(cfg, 1, clock).train(order, center, targets, centers, contexts)
    ec, ex, losses = wc.copy(), wx.copy(), []
    for step, p in enumerate(order):
        lr = max(0.1 * (1 - (P + step) / (2 * P)), 1e-4)
        v, gc, gx, loss = ec[center[p]].copy(), np.zeros(d), {}, 0.0
        for k, x in enumerate(targets[p]):
            s = sigmoid(float(v @ ex[x]))
            g = s - (k == 0)
            gc += g * ex[x]
            gx[x] = gx.get(x, 0) + g * v
            loss -= math.log((s if k == 0 else 1 - s) + 1e-10)
        ec[center[p]] -= lr * gc
        for x, g in gx.items():
            ex[x] = ex[x] - lr * g
        losses.append(loss)
    assert np.allclose(centers.now, ec, atol=1e-9) and np.allclose(contexts.now, ex, atol=1e-9)
    assert np.allclose(history[:, 2], losses, atol=1e-9) and history[:, 0].tolist() == list(range(P, 2 * P))


def test_layers_share_no_row():
    rng = np.random.default_rng(7)
    center, targets = rng.integers(0, 15, 200), rng.integers(0, 15, (200, 4))
    layers = TR.conflict_layers(center, targets)
    for a in range(200):
        for b in range(a):
            if center[a] == center[b] or set(targets[a]) & set(targets[b]):
                assert layers[a] > layers[b]
    assert layers.max() < 200


def grid_by_hand(cfg, vocab, pairs, start):
    """All cells one after another, target by target."""
    B, R, K = cfg.parts, cfg.rounds_per_epoch, cfg.negatives
    words = sorted(((r.idx % B, r.idx, r.weight) for r in vocab.collect()))
    ends = np.cumsum([w for _, _, w in words])
    wc, wx = collect(start)
    total = pairs.count()
    steps, history = math.ceil(total / cfg.batch_size), {}
    for epoch in range(1, cfg.epochs + 1):
        draws = [F.floor(uniform("neg", cfg.seed, F.lit(epoch), "gpos", "off", F.lit(k)) * float(ends[-1])).cast("long").alias(f"x{k}") for k in range(K)]
        rows = pairs.select("center", "context", "gpos", "off", uniform("shuffle", cfg.seed, F.lit(epoch), "gpos", "off").alias("u"), *draws).orderBy("u", "gpos", "off").collect()
        for r in range(R):
            mine = [x for x in rows if r / R <= x.u < (r + 1) / R]
            for s in range(B):
                for i in range(B):
                    cell = [x for x in mine if x.center % B == i]
                    for a in range(0, len(cell), cfg.batch_size):
                        batch = cell[a : a + cfg.batch_size]
                        now = math.floor(batch[0].u * steps)
                        lr = max(cfg.lr * (1 - (epoch - 1 + now / steps) / cfg.epochs), cfg.lr * 1e-4)
                        gc, gx = np.zeros_like(wc), np.zeros_like(wx)
                        for x in batch:
                            negs = [words[int(np.searchsorted(ends, x[f"x{k}"], side="right"))][1] for k in range(K)]
                            for k, t in enumerate([x.context, *negs]):
                                if t % B != (i + s) % B:
                                    continue
                                p = sigmoid(float(wc[x.center] @ wx[t]))
                                gc[x.center] += (p - (k == 0)) * wx[t]
                                gx[t] += (p - (k == 0)) * wc[x.center]
                                w = ((epoch - 1) * steps + now) // cfg.log_every
                                n, loss = history.get((epoch, w), (0, 0.0))
                                history[epoch, w] = (n + (k == 0), loss - math.log((p if k == 0 else 1 - p) + 1e-10))
                        wc -= lr * gc
                        wx -= lr * gx
    return wc, wx, history


@pytest.fixture(scope="module")
def toy(spark):
    from conftest import docs_df

    from wordspace.sources.corpus import tokenize

    def make(n):
        rng = np.random.default_rng(3)
        return tokenize(docs_df(spark, [" ".join(f"w{chr(97 + int(x))}" for x in rng.zipf(1.6, 12) % 23) for _ in range(n)]))

    return make


@pytest.mark.parametrize("partitions,size", [(2, 16), (16, 16), (4, 1)])
def test_grid_equals_the_cells_one_by_one(spark, toy, partitions, size):
    cfg = TR.variant_stream(dim=5, negatives=3, epochs=2, batch_size=size, log_every=7, parts=3, rounds_per_epoch=2, schedule="grid", min_count=1, subsample_t=1.0)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    try:
        vocab, pairs = TR.prepare(toy(40), cfg)
        start = ST.init_params(vocab, cfg.dim, cfg.seed, context="hashed")
        params, history = TR.train_rounds(pairs, vocab, start, cfg)
        got, rows = collect(params), history.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    wc, wx, want = grid_by_hand(cfg, vocab, pairs, start)
    assert np.allclose(got[0], wc, atol=1e-9) and np.allclose(got[1], wx, atol=1e-9)
    assert {(r.epoch, r.window_no): r.n_pairs for r in rows} == {k: n for k, (n, _) in want.items()}
    for r in rows:
        if r.n_pairs:
            assert r.avg_loss == pytest.approx(want[r.epoch, r.window_no][1] / r.n_pairs, abs=1e-9)
    means = {r.epoch: r for r in TR.epoch_means(history).collect()}
    assert all(means[e].n_pairs == pairs.count() for e in (1, 2))


def test_a_cell_holds_two_blocks_whatever_the_pairs(spark, toy):
    """Parameter bytes of a task at two corpus sizes: bounded by the vocabulary."""
    dim, blocks, seen = 16, 4, []
    for n in (20, 200):
        cfg = TR.variant_stream(dim=dim, epochs=1, parts=blocks, schedule="grid", min_count=1, subsample_t=1.0)
        vocab, pairs = TR.prepare(toy(n), cfg)
        params = ST.init_params(vocab, dim)
        limit = 2 * math.ceil(vocab.count() / blocks) * dim * 8
        for shift in range(blocks):
            held = params.groupBy(TR.home_block(shift, blocks).alias("block")).agg((F.count(F.lit(1)) * dim * 8).alias("bytes"), F.countDistinct(F.when(F.col("matrix") == "context", F.col("idx") % blocks)).alias("visitors"))
            rows = held.collect()
            assert max(r.bytes for r in rows) <= limit and all(r.visitors == 1 for r in rows)
        seen.append((pairs.count(), limit))
    assert seen[1][0] > 5 * seen[0][0] and seen[1][1] <= 1.3 * seen[0][1]


def test_grid_learns_with_slot_table(spark, demo_tokens):
    cfg = TR.variant_sentence(dim=12, batch_size=32, table_size=5000, parts=2, schedule="grid", log_every=20, epochs=2, lr=0.05)
    model = TR.fit(demo_tokens, cfg)
    means = [r.avg_loss for r in TR.epoch_means(model.history).orderBy("epoch").collect()]
    assert means[1] < means[0] and model.params.count() == 2 * model.meta["vocab_size"]


def test_fit_from_a_foreign_folder(tmp_path):
    """Executors get the package from the driver: no PYTHONPATH, another folder."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from wordspace.plans.trainer import fit, variant_stream
from wordspace.session import build_session
from wordspace.sources.corpus import tokenize
spark = build_session("local[2]", driver_memory="2g", shuffle_partitions=2)
docs = spark.createDataFrame([(i, "the cat sat on the mat") for i in range(20)], "doc_id long, text string")
for schedule in ("parts", "grid"):
    model = fit(tokenize(docs), variant_stream(dim=4, epochs=1, min_count=1, subsample_t=1.0, parts=2, schedule=schedule))
    print("rows", model.params.count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.count("rows 10") == 2, done.stderr[-2000:]
