"""Headline timings: prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Stages run in pipeline order on the ``documents`` table; each stage is timed
to a materialised result (checkpoint or count), so later stages reuse the
pinned outputs of earlier ones, as the trainer does.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from wordspace.operators import encode as E  # noqa: E402
from wordspace.operators import noise as N  # noqa: E402
from wordspace.operators import pairs as P  # noqa: E402
from wordspace.operators import similarity as S  # noqa: E402
from wordspace.operators import step as ST  # noqa: E402
from wordspace.operators import vocab as V  # noqa: E402
from wordspace.plans import catalog  # noqa: E402
from wordspace.plans.trainer import train_rounds, variant_stream  # noqa: E402
from wordspace.session import build_session, materialize  # noqa: E402
from wordspace.sources import corpus as C  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=cpus)
    times: dict[str, float] = {}
    extra: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        return out

    cfg = variant_stream()  # reference defaults: 5 epochs
    docs = catalog.documents(spark, sf_dir)
    tokens = C.tokenize(docs)

    def vocab_stage():
        v = V.build_vocab(tokens, cfg.min_count)
        v = V.keep_probability(v, cfg.subsample_t, cfg.keep_form)
        return materialize(V.noise_table(v, cfg.power))

    vocab = timed("vocab", vocab_stage)
    n_tokens = tokens.count()

    def pairs_stage():
        enc = E.encode(tokens, vocab, carry=("keep_prob",))
        dense = E.dense_positions(E.subsample(enc, cfg.seed))
        return materialize(P.window_pairs(dense, cfg.window, cfg.seed, sentence=False))

    pairs = timed("pairs", pairs_stage)
    n_pairs = pairs.count()

    timed("negatives", lambda: N.draw_exact(pairs, vocab, cfg.negatives, cfg.seed, 1).count())

    params = materialize(ST.init_params(vocab, cfg.dim, cfg.seed))
    params, history = timed("train_5_epochs", lambda: train_rounds(pairs, vocab, params, cfg))

    def neighbours_stage():
        words = vocab.select(F.col("idx").cast("long").alias("id"), "word")
        vecs = params.filter("matrix = 'center'").select(F.col("idx").cast("long").alias("id"), "vec")
        probes = spark.createDataFrame([(w,) for w in catalog.PROBES], "query string")
        lines, _ = S.neighbour_lines(vecs, words, probes, 8, dim=cfg.dim)
        return lines.collect()

    timed("neighbours", neighbours_stage)
    timed("most_similar", lambda: catalog.q_most_similar(spark, sf_dir).collect())

    extra["tokens"] = n_tokens
    extra["pairs"] = n_pairs
    extra["pairs_per_sec_train"] = round(cfg.epochs * n_pairs / max(times["train_5_epochs"], 1e-9), 1)
    extra["tokens_per_sec_vocab"] = round(n_tokens / max(times["vocab"], 1e-9), 1)
    if history is not None:
        h = history.orderBy("window_no").collect()
        extra["final_window_loss"] = round(h[-1]["avg_loss"], 4) if h else None
    print(
        json.dumps(
            {
                "metric": "pipeline_wall",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).replace("sf", ""),
                "extra": extra,
            }
        )
    )


if __name__ == "__main__":
    main()
