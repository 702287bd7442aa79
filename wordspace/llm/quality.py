"""Quality classifier with hierarchical empirical Bayes over sites.

Method. A logistic model on ten surface features, which are JVM expressions over
the whole text, gives each document its own evidence. It is fitted on labelled
rows: at most ``FIT_ROWS`` of them, those with the smallest hash of their id,
which bounds what reaches the driver. Everything after that covers all rows.

The expected share of good documents is summed by path (``source`` and ``lang``
here) and by host (``source``) in one grouped aggregation. Empirical Bayes then
shrinks: a host's posterior mean lies between its own share and the global one,
a path's between its own share and its host's. How strongly a level pulls is
estimated from the spread of its groups (method of moments), so a sparse site
stays near its prior and a large one speaks for itself. A document's posterior
odds are its classifier's likelihood ratio times the odds of its path; the means
of its host and path leave the document itself out, so its evidence counts once.

Texts are read once: their evidence is written, summed and joined from there.
Sums are integers (millionths), so that results do not depend on the order of
rows. The table of paths is written and read again: its size on disk decides
whether the join broadcasts it; a hot path is split by adaptive execution.

Defined results: a null text counts as empty; null sources and langs are a site
of their own (the empty name); repeated rows are scored each; labels that are
null or name no document are left out; of several labels of one id the good one
counts; without labels of both kinds every
document has the evidence 0 and the global share 0.5, so all are kept; extra
columns stay in ``classify``, but for those named as one of ``COLUMNS``, which
are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import unused

FIT_ROWS = 20_000
RIDGE = 1.0
KEEP_FROM = 0.5
MICRO = 1_000_000
COLUMNS = ["_qc_logit", "_qc_host_mean", "_qc_path_mean", "_qc_posterior"]
SYMBOLS = "#$%&*@^~=+<>{}[]\\_"
N_FEATURES = 10


def features(text: Column) -> list[Column]:
    """Surface features of a text as double columns."""
    t = F.coalesce(text.cast("string"), F.lit(""))
    n = F.greatest(F.length(t), F.lit(1)).cast("double")
    words = F.split(F.btrim(t), r"\s+")
    n_words = F.size(words).cast("double")
    share = lambda chars: (F.length(t) - F.length(F.translate(t, chars, ""))) / n
    upper = F.length(F.regexp_replace(t, r"[^\p{Lu}]+", ""))
    return [
        share(SYMBOLS), share("|"), share("!"), upper / n, share("0123456789"),
        F.log1p(n_words), F.size(F.array_distinct(words)) / n_words,
        (F.length(t) - F.length(F.translate(t, "\n", ""))) / n_words,
        (F.length(t) - F.length(F.translate(t, ".,;:", ""))) / n_words, n / n_words,
    ]


@dataclass(frozen=True)
class Model:
    """Weights on standardised features; ``share`` is that of good fitted rows."""

    weights: tuple[float, ...]
    means: tuple[float, ...]
    scales: tuple[float, ...]
    share: float

    def logit(self, text: Column) -> Column:
        terms = [F.lit(self.weights[0])]
        for f, w, m, s in zip(features(text), self.weights[1:], self.means, self.scales, strict=True):
            terms.append((f - F.lit(m)) / F.lit(s) * F.lit(w))
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        return F.greatest(F.least(total, F.lit(30.0)), F.lit(-30.0))


NO_MODEL = Model((0.0,) * (N_FEATURES + 1), (0.0,) * N_FEATURES, (1.0,) * N_FEATURES, 0.5)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = RIDGE, steps: int = 40) -> Model:
    """Ridge logistic regression by Newton steps."""
    if len(y) == 0 or y.min() == y.max():
        return NO_MODEL
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - mean) / scale]
    w, pull = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    pull[0] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(pull), z.T @ (y - p) - pull * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return Model(tuple(map(float, w)), tuple(map(float, mean)), tuple(map(float, scale)), float(y.mean()))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, key: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """Fit on at most ``rows`` labelled documents."""
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.max(label).alias("_y"))
    known = known.orderBy(F.xxhash64("_k"), "_k").limit(rows)
    rows_of = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")).join(F.broadcast(known), "_k")
    got = rows_of.select(F.col("_k"), F.col("_y").cast("double").alias("y"), *[f.alias(f"f{i}") for i, f in enumerate(features(F.col("_t")))]).orderBy("_k", *[f"f{i}" for i in range(N_FEATURES)]).limit(rows).collect()
    if not got:
        return NO_MODEL
    table = np.array([tuple(r)[1:] for r in got], float)
    return fit_logistic(table[:, 1:], table[:, 0])


def _pull(groups: DataFrame, prior: Column) -> float:
    """Pseudo-count of a level: method of moments over its groups (n, share)."""
    r = groups.select("n", "share", prior.alias("m")).agg(
        F.count(F.lit(1)).alias("g"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n").cast("double")).alias("nn"),
        F.sum(F.col("n") * (F.col("share") - F.col("m")) * (F.col("share") - F.col("m"))).alias("ss"), F.sum(F.col("n") * F.col("m")).alias("nm"),
    ).first()
    if not r["n"] or r["g"] < 2:
        return 1.0
    mean = min(max(r["nm"] / r["n"], 1e-6), 1 - 1e-6)
    room = r["n"] - r["nn"] / r["n"]
    spread = (r["ss"] - (r["g"] - 1) * mean * (1 - mean)) / room if room > 0 else 0.0
    return min(max(mean * (1 - mean) / spread - 1, 1.0), 1e6) if spread > 0 else 1e6


def _odds(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(1 - 1e-6)), F.lit(1e-6))
    return F.log(p / (1 - p))


def classify(spark: SparkSession, docs: DataFrame, model: Model, text: str = "text", host: str = "source", path: str = "lang", carry: list[str] | None = None) -> DataFrame:
    """The columns ``carry`` of ``docs`` (all, if None) with ``COLUMNS``: own
    evidence, site means without the document itself, and posterior."""
    carry = [c for c in (docs.columns if carry is None else carry) if c not in COLUMNS]
    site, place, good = (unused(c, docs.columns) for c in ("_qc_host", "_qc_path", "_qc_good"))
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    # the one pass over the texts: their evidence is written and read again
    scored = docs.withColumns({"_qc_logit": model.logit(F.col(text)), site: name(host), place: name(path)}).select(*carry, "_qc_logit", site, place)
    scored = scored.withColumn(good, F.round(MICRO / (1 + F.exp(-F.col("_qc_logit")))).cast("long"))
    evidence = scratch_path(spark, "evidence")
    scored.write.parquet(evidence)
    scored = spark.read.schema(scored.schema).parquet(evidence)

    sums = scored.groupBy(F.col(site).alias("host"), F.col(place).alias("path")).agg(F.count(F.lit(1)).alias("n"), F.sum(good).alias("good"))
    written = scratch_path(spark, "paths")
    sums.write.parquet(written)
    share = F.col("good") / F.col("n") / MICRO
    paths = spark.read.schema(sums.schema).parquet(written).withColumn("share", share)
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).withColumn("share", share)
    total = paths.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    overall = total["good"] / total["n"] / MICRO if total["n"] else 0.5
    k_host = _pull(hosts, F.lit(overall))
    whole = F.col("share") * F.col("n")
    hosts = hosts.select("host", F.col("n").alias("host_n"), F.col("good").alias("host_good"), ((whole + k_host * overall) / (F.col("n") + k_host)).alias("mean"))
    paths = paths.join(hosts, "host")
    k_path = _pull(paths, F.col("mean"))
    table = scratch_path(spark, "path-sums")
    sums = paths.select(F.col("host").alias(site), F.col("path").alias(place), F.struct("n", "good", "host_n", "host_good").alias("_qc_posterior"))
    sums.write.parquet(table)
    joined = scored.join(spark.read.schema(sums.schema).parquet(table), [site, place])
    # what the rest of the host and of the path say: the document's own evidence counts once
    own, site_of = F.col(good), F.col("_qc_posterior")
    host_mean = ((site_of["host_good"] - own) / MICRO + k_host * overall) / (site_of["host_n"] - 1 + k_host)
    joined = joined.withColumn("_qc_host_mean", host_mean)
    path_mean = ((site_of["good"] - own) / MICRO + k_path * F.col("_qc_host_mean")) / (site_of["n"] - 1 + k_path)
    joined = joined.withColumn("_qc_path_mean", path_mean)
    prior = float(np.log(max(model.share, 1e-6) / max(1 - model.share, 1e-6)))
    posterior = 1 / (1 + F.exp(-(F.col("_qc_logit") - prior + _odds(F.col("_qc_path_mean")))))
    return joined.withColumn("_qc_posterior", posterior).select(*carry, *COLUMNS)


def keep(classified: DataFrame, threshold: float = KEEP_FROM) -> DataFrame:
    """The documents that are not rejected, with their own columns."""
    return classified.filter(F.col("_qc_posterior") >= threshold).drop(*COLUMNS)
